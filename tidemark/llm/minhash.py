"""Near-duplicate detection with HyperMinHash.

Sketch.  The hashes of a document's distinct word shingles are dealt into `registers` buckets; of each bucket's
smallest hash a register keeps the count of leading zeros (6 bits) and the next 10 bits, the mantissa.  Empty buckets
borrow the register of another bucket, chosen by a fixed random order (optimal densification), so that short documents
band as well as long ones.

Search.
1. Documents with equal shingle sets are one class from the start; only its smallest id goes on.
2. Bands of five registers are hashed to band buckets.  In each, every member is paired with the smallest member, the
   pivot: as many pairs as members, never all pairs.
3. Pairs whose collision-corrected Jaccard estimate is far below the threshold (five standard deviations) go; the
   others are confirmed on the full shingle sets, cut again from the texts.
4. Components are formed.  What can still be missing are links between members of a bucket that lie in different
   components and neither of which is the pivot.  Buckets with such members are compared block by block on the
   registers; the estimate joins components into clusters.  Inside a cluster, again block by block, the members with a
   likely partner in another component are found on the registers; the texts of these alone, and only where they have
   one, are brought in, and the pairs confirmed on the full sets until none is left that would connect.  A group of any
   size is dealt over many tasks, and only links that connect are handed on.  Then components are formed anew.
So every pair that shares a bucket is compared or already connected; there is no cap on buckets or partners.  With 51
bands of five, a pair at the threshold of 0.75 shares no bucket with a probability of 1e-6.

Sets are kept as 64-bit hashes of their shingles: two shingles of one pair of documents fall together with a probability
of about n * m / 2^64, below 1e-11 for texts of ten thousand words.

Cases.  Null and empty texts, and texts without words, have an empty set, are linked with nothing, and are kept.  Texts
of fewer than five words have one shingle, the whole sequence.  Rows with a null id are linked with nothing.  Rows that
repeat an id are one document, whose links are those of each of its texts.  An empty table gives an empty result.
Texts of any length are cut whole.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import dropped, map_arrow, staged
from .components import connected_components

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LZ_BITS, _MANTISSA_BITS = 6, 10

#: Members of a bucket or cluster that are compared with as many others in one task.
BLOCK = 1024


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z count as a-z, words are parted by ASCII white space."""
    words = text.encode().lower().split() if text else []  # on bytes, both touch ASCII alone
    if not words:
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        out = mix(out * _ODD + codes[k : len(codes) - width + 1 + k])
    return np.unique(out)


class Sketcher:
    """HyperMinHash registers of a shingle set."""

    def __init__(self, registers: int) -> None:
        self.registers = registers
        #: For each bucket, the order in which it borrows from others.
        self.donors = np.stack([np.random.default_rng([7, k]).permutation(registers) for k in range(registers)])

    def sketch(self, hashes: np.ndarray) -> np.ndarray:
        """uint16 registers; hashes must not be empty."""
        spread = mix(hashes + _ODD)
        bucket = ((spread >> np.uint64(32)) * np.uint64(self.registers)) >> np.uint64(32)
        low = np.full(self.registers, np.iinfo(np.uint64).max)
        np.minimum.at(low, bucket.astype(np.intp), mix(spread))
        filled = np.zeros(self.registers, bool)
        filled[bucket.astype(np.intp)] = True
        top = np.where(low == 0, 64, 63 - np.floor(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)))).clip(0, (1 << _LZ_BITS) - 1).astype(np.uint64)
        rest = (low << np.minimum(top + np.uint64(1), np.uint64(63))) >> np.uint64(64 - _MANTISSA_BITS)
        out = ((top << np.uint64(_MANTISSA_BITS)) | rest).astype(np.uint16)
        if not filled.all():
            empty = np.flatnonzero(~filled)
            out[empty] = out[self.donors[empty, np.argmax(filled[self.donors[empty]], axis=1)]]
        return out


def chance_match(sizes_a: np.ndarray, sizes_b: np.ndarray, registers: int) -> np.ndarray:
    """The probability that registers of two disjoint sets of these sizes agree."""

    def levels(sizes: np.ndarray) -> np.ndarray:
        load = np.maximum(np.asarray(sizes, float) / registers, 1e-3)[:, None]
        ends = np.exp(-load * 2.0 ** -np.arange(0, 1 << _LZ_BITS))
        share = np.diff(ends, axis=1, append=1.0)
        return share / share.sum(axis=1, keepdims=True)

    return (levels(sizes_a) * levels(sizes_b)).sum(axis=1) * 2.0**-_MANTISSA_BITS


def estimate(matches: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, registers: int) -> np.ndarray:
    """Collision-corrected Jaccard estimates from shares of equal registers."""
    chance = chance_match(sizes_a, sizes_b, registers)
    return (matches - chance) / (1 - chance)


def least_estimate(threshold: float, registers: int) -> float:
    """Five standard deviations below the threshold; borrowed registers widen the deviation by less than a fifth."""
    return threshold - 5 * 1.2 * (threshold * (1 - threshold) / registers) ** 0.5


def _sketches(docs: DataFrame, width: int, registers: int, rows: int) -> DataFrame:
    """id, n_shingles, class (16 bytes of the whole set, null if empty), sketch, bands."""

    def each() -> Callable:
        sketcher, bands = Sketcher(registers), registers // rows
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("id", "n_shingles", "class", "sketch", "bands")}
            out["id"] = batch["id"]
            for text in batch["text"].to_pylist():
                hashes = shingles(text, width)
                out["n_shingles"].append(len(hashes))
                if not len(hashes):
                    for c in ("class", "sketch", "bands"):
                        out[c].append(None)
                    continue
                registers_ = sketcher.sketch(hashes)
                key = salt.copy()
                for column in registers_[: bands * rows].reshape(bands, rows).T.astype(np.uint64):
                    key = mix(key * _ODD + column)
                out["class"].append(xxhash.xxh3_128_digest(hashes.tobytes()))
                out["sketch"].append(registers_.tobytes())
                out["bands"].append(key.view(np.int64))
            return out

        return work

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs, each, f"id {kind}, n_shingles long, class binary, sketch binary, bands array<long>")


def _likely(pairs: DataFrame, sketches: DataFrame, threshold: float, registers: int) -> DataFrame:
    """Of the pairs (a, b), those that the estimate does not rule out."""
    of = lambda x: sketches.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "sa", "sb")

    def each() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            na, nb = (batch[c].to_numpy() for c in ("na", "nb"))
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, registers) for c in ("sa", "sb"))
            guess = estimate((left == right).mean(axis=1), na, nb, registers)
            keep = pa.array(guess >= least_estimate(threshold, registers))
            return {c: batch[c].filter(keep) for c in ("a", "b")}

        return work

    kind = pairs.schema["a"].dataType.simpleString()
    return map_arrow(joined, each, f"a {kind}, b {kind}")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Of the pairs, those whose full shingle sets reach the threshold, given as a fraction of whole numbers."""
    of = lambda x: docs.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ta", "tb")

    def each() -> Callable:
        last: list = [None, None]

        def cut(text: str | None) -> np.ndarray:
            if text != last[0]:
                last[:] = [text, shingles(text, width)]
            return last[1]

        def work(batch: pa.RecordBatch) -> dict:
            keep = []
            for ta, tb in zip(batch["ta"].to_pylist(), batch["tb"].to_pylist(), strict=True):
                b = cut(tb)
                a = shingles(ta, width)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(bool(both) and threshold[1] * both >= threshold[0] * (len(a) + len(b) - both))
            return {c: batch[c].filter(pa.array(keep, pa.bool_())) for c in ("a", "b")}

        return work

    kind = pairs.schema["a"].dataType.simpleString()
    return map_arrow(joined, each, f"a {kind}, b {kind}", 256)


def _blocks(members: DataFrame, key: str, block: int) -> DataFrame:
    """Deal the members of each key into blocks, and copy each member to the pairs of blocks that it is part of."""
    sizes = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = members.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other")


class _Block:
    """The members of one pair of blocks, with the likely partners of each among those of other components."""

    def __init__(self, table: pa.Table, registers: int, threshold: float) -> None:
        self.registers, self.threshold, self.least = registers, threshold, least_estimate(threshold, registers)
        self.own, i, j = (table[c].to_numpy() for c in ("own", "i", "j"))
        self.ids, self.root, self.n = table["id"].to_numpy(), table["component"].to_numpy().copy(), table["n_shingles"].to_numpy()
        self.sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, registers)
        self.one, self.columns, self.rows = i[0] == j[0], np.flatnonzero(self.own == j[0]), np.flatnonzero(self.own == i[0])

    def likely(self, r: int) -> np.ndarray:
        """Members of the second block whose estimate with r does not rule them out and which r is not yet connected with."""
        columns, n = self.columns, self.n
        fit = (self.root[columns] != self.root[r]) & (np.minimum(n[columns], n[r]) >= self.threshold * np.maximum(n[columns], n[r]))
        if self.one:
            fit &= self.ids[columns] > self.ids[r]
        near = columns[fit]
        if not len(near):
            return near
        guess = estimate((self.sketch[near] == self.sketch[r]).mean(axis=1), np.full(len(near), n[r]), n[near], self.registers)
        return near[guess >= self.least]

    def spanning(self, accept: Callable[[int, int], bool] | None = None) -> tuple[list, list]:
        """Links between components: no pair is tried that is already connected."""
        a, b, root = [], [], self.root
        for r in self.rows:
            for c in self.likely(r):
                if root[c] != root[r] and (accept is None or accept(int(r), int(c))):
                    a.append(self.ids[r])
                    b.append(self.ids[c])
                    root[root == root[c]] = root[r]
        return a, b

    def with_partners(self) -> np.ndarray:
        """Which members have a likely partner here."""
        out = np.zeros(len(self.ids), bool)
        for r in self.rows:
            near = self.likely(r)
            out[near] = True
            out[r] |= bool(len(near))
        return out


def _across(members: DataFrame, threshold: float, registers: int, block: int = BLOCK) -> DataFrame:
    """Links by estimate that connect members (bucket, id, component, n_shingles, sketch) of one bucket."""
    kind = to_arrow_type(members.schema["id"].dataType)

    def compare(table: pa.Table) -> pa.Table:
        a, b = _Block(table, registers, threshold).spanning()
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    name = members.schema["id"].dataType.simpleString()
    return _blocks(members, "bucket", block).groupBy("bucket", "i", "j").applyInArrow(compare, f"a {name}, b {name}")


def _partnered(clusters: DataFrame, threshold: float, registers: int, block: int = BLOCK) -> DataFrame:
    """Of each pair of blocks of a cluster (cluster, id, component, n_shingles, sketch), the members with a likely partner in it."""
    dealt = _blocks(clusters, "cluster", block).select("cluster", "i", "j", "own", "id", "component", "n_shingles", "sketch")
    return dealt.groupBy("cluster", "i", "j").applyInArrow(lambda table: table.filter(pa.array(_Block(table, registers, threshold).with_partners())), dealt.schema)


def _settled(partnered: DataFrame, width: int, fraction: tuple[int, int], registers: int) -> DataFrame:
    """Confirmed links between the components of each cluster, from partnered members with their texts."""
    kind = to_arrow_type(partnered.schema["id"].dataType)

    def compare(table: pa.Table) -> pa.Table:
        texts, sets = table["text"], {}

        def cut(k: int) -> frozenset:
            if k not in sets:
                sets[k] = frozenset(shingles(texts[k].as_py(), width).tolist())
            return sets[k]

        def accept(r: int, c: int) -> bool:
            x, y = cut(r), cut(c)
            both = len(x & y)
            return fraction[1] * both >= fraction[0] * (len(x) + len(y) - both)

        a, b = _Block(table, registers, fraction[0] / fraction[1]).spanning(accept)
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    name = partnered.schema["id"].dataType.simpleString()
    return partnered.groupBy("cluster", "i", "j").applyInArrow(compare, f"a {name}, b {name}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (75, 100), registers: int = 255, rows: int = 5) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    ratio = threshold[0] / threshold[1]
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = staged(_sketches(docs, width, registers, rows), "minhash-sketches")
    classes = sketched.where("class is not null and id is not null").groupBy("class").agg(F.min("id").alias("rep"))
    n = sketched.count()
    classes = staged(classes, "minhash-classes", n)
    first = staged(
        sketched.join(classes.withColumn("id", F.col("rep")), ["class", "id"]).select("id", "n_shingles", "sketch", "bands"),
        "minhash-representatives",
        n,
    )
    banded = first.select(F.explode("bands").alias("bucket"), "id")
    shared = banded.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = staged(shared, "minhash-buckets", n * (registers // rows) // 2)
    m = shared.agg(F.coalesce(F.sum(F.col("members") - 1), F.lit(0))).first()[0]
    members = staged(banded.join(shared, "bucket").where("id <> pivot"), "minhash-members", m)

    dropped(shared)
    pairs = members.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    likely = staged(_likely(pairs, first, ratio, registers), "minhash-likely", m)
    links = staged(_confirmed(likely, docs, width, threshold), "minhash-links", m)
    dropped(likely)
    found = links.count()
    labels = connected_components(links, 2 * found)

    open_ = members.where("members > 2").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = staged(open_.select("bucket", "id", "component"), "minhash-open", m)
    mixed = open_.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    mixed = staged(mixed, "minhash-mixed", m)
    if not mixed.isEmpty():
        inside = open_.join(mixed, "bucket").join(first.select("id", "n_shingles", "sketch"), "id")
        across = staged(_across(staged(inside, "minhash-inside", m), ratio, registers), "minhash-across")
        clusters = connected_components(links.union(across), 2 * (found + across.count())).withColumnRenamed("component", "cluster")
        clusters = staged(clusters.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "minhash-clusters", n)
        several = clusters.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("cluster")
        several = clusters.join(several, "cluster").join(first.select("id", "n_shingles", "sketch"), "id")
        partnered = staged(_partnered(several, ratio, registers), "minhash-partnered")
        more = staged(_settled(partnered.join(docs, "id"), width, threshold, registers), "minhash-more-links")
        dropped(across, partnered)
        if not more.isEmpty():
            labels = connected_components(links.union(more), 2 * (found + more.count()))

    by_class = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("class", F.coalesce("component", "rep").alias("component"))
    by_class = staged(by_class, "minhash-class-labels", n)
    dropped(first, members, links, open_, mixed, classes)
    out = sketched.select("id", "n_shingles", "class").join(by_class, "class", "left")
    out = out.withColumn("component_id", F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The documents that stay, one for each component, with their own columns.

    Documents with a null id are linked with nothing and all stay.
    """
    kept = near_duplicates(docs, id_col, text_col, **search).where("kept").select(F.col(id_col).alias("kept_id")).where("kept_id is not null")
    columns = [docs[c] for c in docs.columns]
    rows = docs.select(docs[id_col].alias("id"), F.struct(*columns).alias("row"))
    named = rows.join(staged(kept, "minhash-kept"), F.col("id") == F.col("kept_id"), "left_semi")
    return named.unionByName(rows.where("id is null")).select("row.*")
