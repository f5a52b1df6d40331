"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside the groups.

Plan.  One hash aggregation has the hash and the text itself as its key: rows of one hash are told apart by their
bytes, which excludes collisions, and copies collapse on the map side, so that a group of any size never meets in one
task.  Each distinct text crosses the network once.  The groups, without their texts, are then joined back to the rows
on the hash, both sides plain exchanges, so that adaptive execution can split a hot hash.  Only if some hash has more
than one text do the groups carry the texts of such hashes.

Cases.  A null text counts as empty, and all empty texts are one group.  Texts of any length are compared whole.  Rows
with a null id take part; a group keeps its smallest non-null id, or null if it has none.  Rows that repeat an id and a
text share their flags here; `drop_exact_duplicates` returns one of them.  An empty table gives an empty result.  Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, hex_sha256, staged


def normalise(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def _hashed(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), normalise(F.col(text_col)).alias("norm"))
    return rows.withColumn("h", hash_of(F.col("norm")))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> tuple[DataFrame, bool]:
    """One row per distinct text: h, norm (null but for collisions), keep_id, group_size; and whether hashes collide."""
    texts = _hashed(docs, id_col, text_col, hash_of).groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = staged(texts.select("h", "keep_id", "group_size"), "dedup-groups")
    crowded = groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h")
    if crowded.isEmpty():
        return groups.select("h", F.lit(None).cast("string").alias("norm"), "keep_id", "group_size"), False
    crowded = staged(crowded, "dedup-crowded")
    split = _hashed(docs, id_col, text_col, hash_of).join(crowded, "h", "left_semi").groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    whole = groups.join(crowded, "h", "left_anti").select("h", F.lit(None).cast("string").alias("norm"), "keep_id", "group_size")
    return staged(whole.unionByName(split), "dedup-split"), True


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    groups, collide = duplicate_groups(docs, id_col, text_col, hash_of)
    rows = _hashed(docs, id_col, text_col, hash_of).withColumn("text_sha256", hex_sha256(F.col("norm")))
    if not collide:
        rows = rows.drop("norm").join(groups.drop("norm"), "h")
    else:
        texts = groups.withColumnRenamed("norm", "group_norm")
        rows = rows.join(texts, "h").where("group_norm is null or group_norm = norm")
    return rows.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows that stay, with their own columns; rows that repeat both id and text come out once."""
    groups, collide = duplicate_groups(docs, id_col, text_col, hash_of)
    columns = [F.struct(*[docs[c] for c in docs.columns]).alias("row")]
    rows = docs.select(*columns).select("row", F.col(f"row.`{id_col}`").alias("id"), normalise(F.col(f"row.`{text_col}`")).alias("norm"))
    rows = rows.withColumn("h", hash_of(F.col("norm")))
    keep = groups.select(F.col("h").alias("gh"), F.col("norm").alias("group_norm"), "keep_id")
    same = (F.col("h") == F.col("gh")) & F.col("id").eqNullSafe(F.col("keep_id"))
    if collide:
        return rows.join(keep, same & (F.col("group_norm").isNull() | (F.col("group_norm") == F.col("norm"))), "left_semi").dropDuplicates(["h", "id", "norm"]).select("row.*")
    return rows.drop("norm").join(keep, same, "left_semi").dropDuplicates(["h", "id"]).select("row.*")
