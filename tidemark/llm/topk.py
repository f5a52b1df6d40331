"""Exact top-k inner-product search with Fagin's threshold algorithm.

Plan.  Candidates are dealt by a hash of their id into blocks of about `block` rows; each block's lists, one for every
dimension with the candidates sorted by that component, are made once and written.  Queries are dealt into blocks of
their own, and each pair of blocks is one group.  A query reads its lists from the side that raises its score, always
those on which the threshold falls fastest, scores each candidate on first sight in any list, and stops when the bound that it has to beat is above the
threshold, the best score that an unseen candidate could still have.  That bound is the kth score found so far in this
block or in the query's home block, which is searched before all others, whichever is higher; so it holds for the whole
table, and a block hands on only rows that can reach it.  Work and memory of a group are bounded by the block sizes.

What is read.  How deep the lists are read depends on the data: where a few components decide, a small part; for vectors
without any direction of their own in 64 dimensions the threshold falls below the kth score only after about a quarter
of every list, by when nearly every candidate has been seen in one of them.  `reading` measures it.

Cases.  Vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows without an id.
Vectors are compared with those of their own dimension.  A query is not compared with rows of its own id; other ids
that repeat count as often as they occur.  Query rows that repeat id and vector are one query; rows that repeat the id
with another vector are queries of their own, each with ranks from 1.  Equal scores go to the smaller id.  Empty tables
give an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ship, staged

STEP = 16


def sorted_lists(vectors: np.ndarray) -> np.ndarray:
    """For each dimension the candidates by ascending component."""
    return np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32))


def threshold_search(
    vectors: np.ndarray,
    ids: np.ndarray,
    lists: np.ndarray,
    query: np.ndarray,
    own: int,
    k: int,
    floor: float | None = None,
    step: int = STEP,
    reading: dict[str, int] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of one query, or those of them that reach floor.

    reading: adds up `read`, the entries of lists that were read, and `scored`, the candidates that were scored.
    """
    n = len(ids)
    seen, scores = np.zeros(n, bool), np.zeros(n, vectors.dtype)
    used = np.flatnonzero(query)
    weights, rising = query[used], query[used] > 0
    depth = np.zeros(len(used), np.int64)
    bound, best = floor, np.empty(0, vectors.dtype)

    def value(at: np.ndarray) -> np.ndarray:
        """The component that each list has at a depth, from the side that raises the score."""
        at = np.minimum(at, n - 1)
        return vectors[lists[used, np.where(rising, n - 1 - at, at)], used]

    end = weights * value(depth) if n else weights
    while n and len(used):
        if bound is not None and bound > end.sum():
            break
        after = weights * value(depth + step)
        gain = end - after
        going = np.flatnonzero(2 * gain >= gain.max())
        at = np.minimum(depth[going, None] + np.arange(step), n - 1)
        met = lists[used[going, None], np.where(rising[going, None], n - 1 - at, at)].ravel()
        fresh = np.zeros(n, bool)
        fresh[met] = True
        new = np.flatnonzero(fresh & ~seen)
        scores[new] = vectors.take(new, axis=0) @ query
        seen[new] = True
        if reading is not None:
            reading["read"] = reading.get("read", 0) + len(met)
            reading["scored"] = reading.get("scored", 0) + len(new)
        best = np.concatenate([best, scores[new[ids[new] != own]]])
        if len(best) >= k:
            best = best[np.argpartition(best, len(best) - k)[len(best) - k :]]
            bound = best.min() if bound is None else max(bound, best.min())
        depth[going] += step
        end[going] = after[going]
        step = step * 3 // 2  # fewer rounds; the search goes at most half deeper than it must
        if depth.max() >= n:  # one list has been read to its end: every candidate has been seen
            break
    if not len(used):
        seen[:] = True  # every score is zero
    at = np.flatnonzero(seen & (ids != own))
    if bound is not None:
        at = at[scores[at] >= bound]
    at = at[np.lexsort((ids[at], -scores[at]))][:k]
    return ids[at], scores[at]


def _matrix(values: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(values.combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)


def exact_top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    block: int = 4096,
    query_block: int = 4096,
) -> DataFrame:
    """For each row that is_query holds for: query_id, rank, id, score against all other rows.

    Components count as floor(scale * x).
    """
    ship(table.sparkSession)
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x * scale))
    rows = table.select(F.col(id_col).alias("id"), whole.alias("v"), F.size(vector_col).alias("dim"), is_query.alias("asks"), sound.alias("sound"))
    rows = rows.where("id is not null and sound and dim > 0").drop("sound")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))
    home = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    kind, kind_of = table.schema[id_col].dataType.simpleString(), to_arrow_type(table.schema[id_col].dataType)

    def listed(group: pa.Table) -> pa.Table:
        dim = group["dim"][0].as_py()
        lists = sorted_lists(_matrix(group["v"], dim))
        values = group["v"].combine_chunks().flatten()
        return pa.table(
            {
                "dim": group["dim"][:1],
                "b": group["b"][:1],
                "ids": pa.array([group["id"].to_pylist()], pa.list_(kind_of)),
                "vectors": pa.array([values.to_pylist()], pa.list_(pa.int64())),
                "lists": pa.array([lists.tobytes()], pa.binary()),
            }
        )

    of_block = f"dim int, b int, ids array<{kind}>, vectors array<bigint>, lists binary"
    candidates = staged(rows.select("id", "v", "dim", home.alias("b")).groupBy("dim", "b").applyInArrow(listed, of_block), "topk-lists")
    queries = rows.where("asks").select("id", "v", "dim", home.alias("b")).dropDuplicates(["id", "v"])
    queries = queries.withColumn("query", F.sha2(F.concat_ws(",", F.col("id").cast("string"), F.array_join(F.col("v").cast("array<string>"), ",")), 256))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("query", "query_id", "id", "score")}
        if left.num_rows and right.num_rows:
            dim = left["dim"][0].as_py()
            values = [np.asarray(left["vectors"].combine_chunks().flatten().to_numpy()).reshape(-1, dim), _matrix(right["v"], dim)]
            top = [max(abs(int(v.max())), abs(int(v.min()))) for v in values]
            size = top[0] * top[1] * dim
            exact = np.float64 if size < 2**53 else np.int64 if size < 2**63 else object
            vectors, asking = (v.astype(exact) for v in values)
            ids = left["ids"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            lists = np.frombuffer(left["lists"][0].as_buffer(), np.int32).reshape(dim, -1)
            floors = right["floor"].to_pylist()
            for key, own, query, floor in zip(right["query"].to_pylist(), right["id"].to_pylist(), asking, floors, strict=True):
                best, scores = threshold_search(vectors, ids, lists, query, own, k, floor)
                out["query"] += [key] * len(best)
                out["query_id"] += [own] * len(best)
                out["id"] += best.tolist()
                out["score"] += [int(s) for s in scores]
        kinds = {"query": pa.string(), "query_id": kind_of, "id": kind_of, "score": pa.int64()}
        return pa.table({c: pa.array(out[c], t) for c, t in kinds.items()})

    found_kind = f"query string, query_id {kind}, id {kind}, score long"

    def searched(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, found_kind)

    dealt = F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    pairs = candidates.withColumn("q", spread)
    at_home = queries.select("*", F.lit(None).cast("long").alias("floor"), dealt.alias("q"))
    first = staged(searched(pairs, at_home, "dim", "b", "q"), "topk-home")
    if blocks == 1:
        found = first
    else:
        floors = first.groupBy("query").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("floor"))
        floors = floors.select("query", F.when(F.col("found") >= k, F.col("floor")).alias("floor"))
        others = queries.join(floors, "query", "left").withColumnRenamed("b", "home").withColumn("q", dealt)
        others = others.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where("b <> home").drop("home")
        found = first.unionByName(searched(pairs, others, "dim", "b", "q"))
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
