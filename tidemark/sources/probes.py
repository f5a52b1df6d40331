"""Questions about a source before it is relied on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_overlap(first: DataFrame, second: DataFrame, key: str = "unique_key") -> DataFrame:
    """Keys that two pages share: none, if the order of the pages is total."""
    return first.select(key).intersect(second.select(key))


def stamp_frequencies(rows: DataFrame, stamp: str) -> DataFrame:
    """How many rows share each stamp: large groups are batches, which a window's end must not split."""
    return rows.groupBy(stamp).agg(F.count(F.lit(1)).alias("n"))


def lags(rows: DataFrame, start: str, end: str, by: str) -> DataFrame:
    """Seconds from start to end for each value of a column: least, median and greatest."""
    seconds = F.unix_seconds(F.col(end).cast("timestamp")) - F.unix_seconds(F.col(start).cast("timestamp"))
    return rows.groupBy(by).agg(F.min(seconds).alias("least"), F.median(seconds).alias("median"), F.max(seconds).alias("greatest"))
