from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_dedup import brute
from tests.llm.test_pii import base
from tests.llm.test_tokens import BPE, check_packing
from tidemark.llm.common import read_table
from tidemark.llm.packing import lower_bound
from tidemark.llm.quality import quality_scores


def test_run_equals_brute_force(spark, small):
    docs, labels = (read_table(spark, small, t) for t in ("documents", "labels"))
    good = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    firsts: dict[str, int] = {}
    for i in sorted(texts):
        firsts.setdefault(" ".join(texts[i].replace("\t", " ").replace("\n", " ").split(" ")), i)
    left = sorted(set(firsts.values()))
    kept = [i for i, (k, (_, c)) in zip(left, enumerate(brute([texts[i] for i in left])), strict=True) if c == k]
    clean = {}
    for i in kept:
        text, spans = texts[i], base(texts[i])
        for a, _, kind, b in reversed(spans):
            text = f"{text[:a]}<{kind.upper()}>{text[b:]}"
        clean[i] = text
    rows = corpus_pipeline.run(spark, small).collect()
    used = check_packing(rows, clean, 1024)
    pieces = {(r.doc_id, r.piece): r.ids for r in rows}
    library = Tokenizer.from_file(BPE)
    for i, text in clean.items():
        assert [x for k in range(sum(d == i for d, _ in pieces)) for x in pieces[i, k]] == [*library.encode(text, add_special_tokens=False).ids, 2]
    from collections import Counter

    assert used <= lower_bound(Counter(r.length for r in rows), 1024) + 1


def test_stages_keep_the_columns(spark, small):
    docs = read_table(spark, small, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), small)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema] and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), small).count() == 0


def test_crowded_table(spark, small, crowded):
    """Nulls, repeats, a long text and clashing names through all stages; the sample's labels know only ids 1 to 7."""
    kept = {r.doc_id: r.text for r in corpus_pipeline.quality(spark, crowded, small).collect()}
    rows = corpus_pipeline.run_on(spark, crowded, small).collect()
    assert {r.doc_id for r in rows} <= set(kept) and not {3, 4, 6} & {r.doc_id for r in rows}
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert corpus_pipeline.run_on(spark, crowded.limit(0), small).count() == 0
