"""Proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled within their source by a seeded hash and ranked; a row's place is its fractional rank,
(rank + 1/2) / rows of the source.  In the order of these places every source is spread evenly, so equal cuts of the
order have the mixture of the whole.  The cuts are by row counts: shards differ by one row at the most.

Plan.  Exact ranks come from two levels: rows are dealt into buckets of the hash (for ranks within a source) and of
the place (for the global order), counted, and the counts of earlier buckets are added to the rank inside the bucket.
The number of buckets follows the number of rows, so that neither a source with a third of all rows nor the whole
table ever meets in one task.  A bucket that is too full all the same (many rows of one id, or of many sources with
equal places) is split by a number that every row gets when the table is first written; its rows come in the order
of these parts.

Cases.  A null text has size 1 and the check sum of the empty text.  A null source is a source of its own; null ids
are shuffled by their text's check sum.  Rows that repeat id, source and text are interchangeable.  An empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def _first_bits(digest: Column, bits: int) -> Column:
    """The first bits of a hexadecimal digest, as a number."""
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits)


def _dealt(rows: DataFrame, keys: list[str], limit: int, largest: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """Split buckets of far more than `limit` rows: rows with `slot_`, the bucket and its part as one number that sorts
    like the bucket; and the number of rows n of each slot_.  The last of keys is the bucket, a number."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    full = counts.where(F.col("n") > 4 * limit).select(*keys, F.least(F.ceil(F.col("n") / limit), F.lit(largest)).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("deal"), F.coalesce("parts", F.lit(1)))
    rows = rows.join(staged(full, "sharding-full"), keys, "left").withColumn("slot_", F.col(keys[-1]).cast("long") * largest + part).drop("parts")
    return rows, staged(rows.groupBy(*keys[:-1], "slot_").agg(F.count(F.lit(1)).alias("n")), "sharding-counts")


def _earlier(counts: DataFrame, by: list[str], coarse: int = 1024 << 24) -> DataFrame:
    """Add `before`, the sum of n over smaller slot_ (within by), in two levels so that no window is long."""
    counts = counts.withColumn("part", F.floor(F.col("slot_") / coarse))
    inside = Window.partitionBy(*by, "part").orderBy("slot_").rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy(*by, "part").agg(F.sum("n").alias("n")).select(*by, "part", F.coalesce(F.sum("n").over(outside), F.lit(0)).alias("base"))
    counts = counts.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counts.join(parts, [*by, "part"]).select(*by, "slot_", (F.col("base") + F.col("within")).alias("before"))


def stratified_shards(docs: DataFrame, shards: int = 16, seed: str = "tidemark", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", rows_a_bucket: int = 10_000) -> DataFrame:
    """One row per row: id, size, text_crc32, law, shard, slot, grown_shard, source, position."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
    )
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.col("crc").cast("string"))).cast("binary"))
    stratum = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = staged(rows.select("*", digest.alias("key"), stratum.alias("stratum"), F.monotonically_increasing_id().alias("deal")), "sharding-rows")
    total = rows.count()
    bits = max(8, (total // rows_a_bucket).bit_length())

    rows, counts = _dealt(rows.withColumn("hashed", _first_bits(F.col("key"), bits)), ["stratum", "hashed"], rows_a_bucket)
    strata = counts.groupBy("stratum").agg(F.sum("n").alias("of"))
    earlier = _earlier(counts, ["stratum"]).join(strata, "stratum")
    inside = Window.partitionBy("stratum", "slot_").orderBy("key", "id", "crc", "size", "deal")
    ranked = rows.withColumn("nth", F.row_number().over(inside) - 1).join(earlier, ["stratum", "slot_"])
    ranked = ranked.withColumn("place", (F.col("before") + F.col("nth") + F.lit(0.5)) / F.col("of")).withColumn("cell", F.floor(F.col("place") * (1 << bits)))
    ranked = staged(ranked.select("id", "source", "stratum", "size", "crc", "key", "deal", "place", "cell"), "sharding-places")

    placed, counts = _dealt(ranked, ["cell"], rows_a_bucket)
    inside = Window.partitionBy("slot_").orderBy("place", "stratum", "key", "id", "crc", "size", "deal")
    placed = placed.withColumn("nth", F.row_number().over(inside) - 1).join(_earlier(counts, []), "slot_").withColumn("position", F.col("before") + F.col("nth"))
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    return placed.withColumn("cut", shard).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("cut").cast("int").alias("shard"),
        F.expr(f"position - (cut * {total} + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
        "position",
    )
