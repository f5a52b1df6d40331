import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.common import staged
from tidemark.llm.packing import best_fit_decreasing, lower_bound, pack_documents, pack_pieces, plan_packing, reduce_by_dominance, token_pieces
from tidemark.llm.pieces import ChunkEncoder, encode_pieces, piece_digests
from tidemark.llm.queries import queries
from tidemark.llm.tokens import encoder

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ATOMS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "▁", "é", "世界", "😀", ".", "<s>", "</s>", "<unk>", "<0x0A>", "　", "x" * 30, "\r\n", "\0", "ing", "123", "﻿", "​", "é", "ﬁ", "A", "'s", "<|endoftext|>", "\u0085"]
MIXED = st.lists(st.one_of(st.sampled_from(ATOMS), st.text(max_size=5)), max_size=20).map("".join).filter(lambda t: not any(0xD800 <= ord(c) <= 0xDFFF for c in t))


@settings(max_examples=400, deadline=None)
@given(MIXED)
def test_byte_level_ids_equal_the_library(text):
    assert encoder(BPE)(text) == _library().encode(text, add_special_tokens=False).ids


def _library(cache={}):  # noqa: B006
    if not cache:
        cache["t"], cache["s"], cache["c"] = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES), ChunkEncoder(PIECES, 50)
    return cache["t"]


@settings(max_examples=400, deadline=None)
@given(MIXED)
def test_chunk_table_equals_the_library(text):
    _library()
    library, chunks = _library.__defaults__[0]["s"], _library.__defaults__[0]["c"]
    ((ids, joined),) = chunks.encode([text])
    assert ids == library.encode(text) and joined == ",".join(map(str, ids)) and chunks.decode(ids) == library.decode(ids)


def test_long_chunks():
    _library()
    library, chunks = _library.__defaults__[0]["s"], _library.__defaults__[0]["c"]
    for text in ("a" * 20_000, " " * 5_000, "\n" * 3_000, "word " * 9_000):
        assert chunks.encode([text])[0][0] == library.encode(text)
        assert encoder(BPE)(text) == _library().encode(text, add_special_tokens=False).ids


def test_pieces_of_edge_rows(crowded, no_rows):
    rows = encode_pieces(crowded, PIECES).collect()
    texts = Counter((r.doc_id, r.text or "") for r in crowded.collect())
    assert Counter((r.doc_id, r.decoded) for r in rows) == texts
    digests = piece_digests(crowded, PIECES)
    assert sorted(map(str, digests.collect())) == sorted(map(str, encode_pieces(crowded, PIECES).drop("ids", "decoded").collect()))
    assert piece_digests(no_rows, PIECES).count() == 0


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[k] <= capacity and bins[b] not in bins[:b]:
                bins[b] += items[k]
                place(k + 1, bins)
                bins[b] -= items[k]
        bins.append(items[k])
        place(k + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    r = random.Random(4)
    for _ in range(150):
        capacity = r.choice([7, 10, 20, 37])
        items = [r.randint(1, capacity) for _ in range(r.randint(0, 10))]
        hist = Counter(items)
        fixed, rest = reduce_by_dominance(hist, capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(t for _, t in fixed) + (optimum(left, capacity) if left else 0) == (optimum(items, capacity) if items else 0)


def test_plans_hold_every_piece():
    r = random.Random(5)
    for make in (plan_packing, best_fit_decreasing):
        for _ in range(30):
            hist = Counter(r.choice([r.randint(1, 1024), r.randint(1, 90), 700]) for _ in range(r.randint(0, 3000)))
            plan = make(hist, 1024)
            held = Counter()
            for pattern, times in plan:
                assert times > 0 and sum(s * n for s, n in pattern) <= 1024
                for s, n in pattern:
                    held[s] += n * times
            assert held == hist
            used = sum(t for _, t in plan)
            assert lower_bound(hist, 1024) <= used <= 1.03 * lower_bound(hist, 1024) + 2


def check_packing(rows, texts, capacity):
    """Every id once, pieces cut as they must be, sequences without gaps or overlaps."""
    encode, found = encoder(BPE), defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    wanted = {k: [*(encode(t) if t else []), 2] for k, t in texts.items()}
    assert set(found) == set(wanted)
    for k, ids in wanted.items():
        pieces, at = sorted(found[k], key=lambda r: r.piece), 0
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // capacity)))
        for p in pieces:
            assert p.start == at and (p.length == capacity or p.piece == 0)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_the_sample(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries()["op3_best_fit_packing"](spark, small).collect()
    used = check_packing(rows, texts, 1024)
    assert used <= lower_bound(Counter(r.length for r in rows), 1024) + 1


def test_packing_edges(spark, docs, crowded, no_rows):
    texts = ["", None, "one", "a b c " * 400, "same"] + ["same"] * 300
    check_packing(pack_documents(docs(*texts), BPE, capacity=16).collect(), dict(enumerate(texts)), 16)
    rows = pack_documents(crowded, BPE, with_ids=True).collect()
    assert sum(r.piece == 0 for r in rows) == crowded.count() and all(len(r.ids) == r.length for r in rows)
    assert pack_documents(no_rows, BPE).count() == 0


def test_a_million_of_each_white_space_character():
    for c in " \n\t\r\x0b\x0c\x85\xa0\u2003\u3000":
        text = "a" + c * 1_000_000 + "b"
        assert encoder(BPE)(text) == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_a_very_long_text_is_packed_whole(docs):
    text = "word " * 60_000 + " " * 1_000_000 + "end"
    rows = pack_documents(docs(text, "x"), BPE, with_ids=True).collect()
    check_packing(rows, {0: text, 1: "x"}, 1024)
    by = {(r.doc_id, r.piece): r.ids for r in rows}
    assert [i for k in sorted(by) if k[0] == 0 for i in by[k]] == [*Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids, 2]


def test_rows_of_one_id_are_dealt(spark):
    """Null and repeated ids: ranks come from groups that no id gathers."""
    table = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'one text' as text")
    rows = pack_documents(table, BPE).collect()
    at = Counter((r.sequence_id, r.offset) for r in rows)
    assert len(rows) == 3000 and set(at.values()) == {1}
    pieces = token_pieces(table, BPE)
    assert pieces.select("deal").distinct().count() == 3000
    placed = pack_pieces(staged(pieces, "test-pieces"), 1024, group=100)
    assert len({(r.sequence_id, r.offset) for r in placed.collect()}) == 3000
