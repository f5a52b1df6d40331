"""The scorecard's history: one snapshot a day, replaced on a second run, kept for a number of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scorecard import COLUMNS
from ..sources.files import Store, coerced, read_csv_text, write_csv_file

KEYS = ("check_name", "grain", "run_date")


def merged(history: DataFrame, today: DataFrame, run_date: dt.date, days: int = 180) -> DataFrame:
    """History without today's keys, and today's rows, from `days` before the run on."""
    earlier = history.join(today.select(*KEYS), list(KEYS), "left_anti")  # keys are never null
    return earlier.unionByName(today).where(F.col("run_date") >= F.date_sub(F.lit(run_date), days))


def append_snapshot(spark: SparkSession, today: DataFrame, folder: str, name: str = "scorecard_history.csv", days: int = 180) -> dict[str, object]:
    """Merge a snapshot into the history file, which is replaced in one step; a second run writes the same bytes."""
    today = coerced(today.select(*[F.col(c).cast("string").alias(c) for c in COLUMNS]), COLUMNS).cache()
    try:
        dates = [r[0] for r in today.select("run_date").distinct().collect()]
        if len(dates) != 1 or dates[0] is None:
            raise ValueError(f"a snapshot must have rows of one run date; found {dates}")
        before = coerced(read_csv_text(spark, f"{folder}/{name}"), COLUMNS) if Store(spark, folder).exists(name) else today.limit(0)
        whole = merged(before, today, dates[0], days).orderBy("run_date", "category", "check_name", "grain").select(*COLUMNS)
        held = before.agg(F.count(F.lit(1)), F.count_if(F.col("run_date") == F.lit(dates[0])), F.count_if(F.col("run_date") < F.date_sub(F.lit(dates[0]), days))).first()
        write_csv_file(whole, folder, name)
        after = read_csv_text(spark, f"{folder}/{name}").agg(F.count(F.lit(1)), F.count_distinct("run_date"), F.min("run_date"), F.max("run_date")).first()
        return {
            "run_date": dates[0], "rows_before": held[0], "rows_replaced": held[1], "rows_expired": held[2], "rows": after[0], "run_dates": after[1], "first": after[2], "last": after[3],
        }
    finally:
        today.unpersist()
