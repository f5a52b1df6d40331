"""SentencePiece encoding and decoding through a table of distinct chunks.

A normalised text is a sequence of chunks that each begin with white space markers.  When no piece of the model holds
a marker after another character, no merge crosses from one chunk into the next, so each distinct chunk is segmented
once and the ids are joined back by position.  The same holds around a newline when no piece of two or more characters
has one.  The table lives in the Python worker: a global one would grow with the corpus and would have to be shuffled
word by word.  It is emptied when it reaches `table_limit` entries, which bounds memory and changes no result.

Models for which this does not hold (other normalisers, markers as suffixes, user-defined symbols) are encoded text by
text by the library.

Cases.  Null texts count as empty; empty texts have no ids and decode to the empty text.  Ids may be null and may
repeat: one output row for each input row.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

MARK = "▁"


class ChunkEncoder:
    """Ids of texts, equal to the library's encode(); `table` maps each chunk seen to its ids."""

    def __init__(self, model: str | bytes, table_limit: int = 300_000) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        content = model if isinstance(model, bytes) else open(model, "rb").read()  # noqa: SIM115
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(content)
        normal, pieces = spec.normalizer_spec, [p.piece for p in spec.pieces]
        self.by_chunks = (
            not normal.precompiled_charsmap
            and normal.add_dummy_prefix
            and normal.escape_whitespaces
            and not normal.remove_extra_whitespaces
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == spec.pieces[0].USER_DEFINED for p in spec.pieces)
            and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
            and MARK in pieces
        )
        newline = not any("\n" in p and len(p) > 1 for p in pieces)
        self.chunk = re.compile("\n[^ \n]*| +[^ \n]*" if newline else " +[^ ]*")
        self.mark = self.library.piece_to_id(MARK)
        self.decimals = [str(k) for k in range(len(pieces))]
        # ids with which a chunk of one leading space, or a newline chunk, begins, and no other place does
        self.begins = np.array([p.startswith(MARK) for p in pieces])
        if newline:
            self.begins[self.library.encode("\n")[1:2]] = True
        self.table: dict[str, tuple[int, ...]] = {}
        self.table_limit = table_limit

    def _learn(self, chunks: set[str]) -> None:
        """Segment the chunks that are new, all in one text where the ids show where each begins."""
        new = [c for c in chunks if c not in self.table]
        plain = [c for c in new if not c.startswith("  ") and len(c) > 1]
        if plain:
            # the library puts one marker before the text: it stands for the first chunk's space
            text = "".join(plain)
            ids = np.array(self.library.encode(text[1:]) if text[0] == " " else self.library.encode(text)[1:])
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(plain) and at[0] == 0:
                ids, ends = ids.tolist(), [*at.tolist()[1:], len(ids)]
                self.table.update(zip(plain, (tuple(ids[x:y]) for x, y in zip(at.tolist(), ends, strict=True)), strict=True))
                new = [c for c in new if c not in self.table]
        for c, own in zip(new, self.library.encode([c if c[0] == "\n" else c[1:] for c in new], num_threads=1), strict=True):
            self.table[c] = tuple(own[1:] if c[0] == "\n" else own or [self.mark])

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """For each text its ids, and the ids in decimal, joined by commas."""
        if self.by_chunks:
            split = [self.chunk.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
            if len(self.table) > self.table_limit:
                self.table.clear()
            self._learn(set().union(*split))
            found = [list(chain.from_iterable(map(self.table.__getitem__, chunks))) for chunks in split]
        else:
            found = self.library.encode(texts, num_threads=1)
        return [(ids, ",".join(map(self.decimals.__getitem__, ids))) for ids in found]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids, ids_sha256, decoded, decoded_sha256."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string"
    return _encoded(docs, model_path, id_col, text_col, schema)


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same without ids and texts, which then need not leave the Python workers."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _encoded(docs, model_path, id_col, text_col, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs: DataFrame, model_path: str, id_col: str, text_col: str, schema: str) -> DataFrame:
    def each() -> Callable:
        encoder = ChunkEncoder(model_path)

        def digest(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")}
            for ids, joined in encoder.encode([t or "" for t in batch["text"].to_pylist()]):
                decoded = encoder.decode(ids)
                for c, x in zip(out, (len(ids), ids, digest(joined), decoded, digest(decoded)), strict=True):
                    out[c].append(x)
            return out | {id_col: batch["id"]}

        return work

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), each, schema, 64)
