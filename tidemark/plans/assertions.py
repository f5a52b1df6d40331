"""Assertions over the models: how many rows break each, and whether that is an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import count_where
from . import contracts
from .detectors import union_all
from .models import Warehouse

CATEGORIES = ("contract", "unit", "distributional", "detector")
STATUSES = ("pass", "warn", "fail", "acknowledged", "info")

#: Columns of the fact that are never null.
REQUIRED = ("unique_key", "date_key", "created_date", "is_closed", "is_censored", "is_settled", "is_undated_closure", "has_valid_coordinates")


def counted(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """assertion, failures: all conditions of a table in one pass."""
    one = df.agg(*[count_where(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("assertion"), F.col(n).alias("failures")) for n in conditions])).alias("a")).select("a.*")


def repeated(df: DataFrame, name: str, keys: Iterable[str]) -> DataFrame:
    """The number of keys that occur more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("assertion"), "failures")


def unmatched(df: DataFrame, name: str, key: str, dimension: DataFrame) -> DataFrame:
    """Keys of the fact, not null, without a member of the dimension."""
    lost = df.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("assertion"), "failures")


def outside(name: str, column: str, values: tuple[str, ...]) -> dict[str, Column]:
    return {name: ~F.col(column).isin(*values)}


def judged(rows: DataFrame, warn_only: dict[str, int]) -> DataFrame:
    """Any failure is an error; those of warn_only are a warning up to their number."""
    allowed = F.create_map(*[F.lit(x) for pair in warn_only.items() for x in pair])
    limit = F.try_element_at(allowed, F.col("assertion"))
    status = F.when(F.col("failures") == 0, "pass").when(F.col("failures") <= limit, "warn").otherwise("error")
    return rows.withColumn("status", status)


def model_assertions(house: Warehouse, closed_before_created: int = 3500) -> DataFrame:
    """The fact's and the dimensions' assertions."""
    fact = house.fact
    rows = counted(
        fact,
        {
            "closed_before_created": F.col("closed_date") < F.col("created_date"),
            "hours_of_censored_requests": F.col("is_censored") & F.col("resolution_hours").isNotNull(),
            **{f"null_{c}": F.col(c).isNull() for c in REQUIRED},
        },
    )
    counts = house.staged.agg(F.count(F.lit(1)).alias("s")).crossJoin(house.bronze.agg(F.count(F.lit(1)).alias("b")))  # one row each
    lost = counts.select(F.lit("rows_lost_in_staging").alias("assertion"), F.abs(F.col("s") - F.col("b")).alias("failures"))
    keys = {"agency_key": house.agencies, "complaint_type_key": house.types, "location_key": house.locations, "date_key": house.dates}
    parts = [rows, lost, repeated(fact, "repeated_unique_key", ["unique_key"])]
    parts += [unmatched(fact, f"unmatched_{k}", k, d) for k, d in keys.items()]
    parts += [repeated(d, f"repeated_{k}", [k]) for k, d in keys.items()]
    return judged(union_all(parts), {"closed_before_created": closed_before_created})


def scorecard_assertions(card: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check, grain and run; known categories and statuses; column counts as the tables have them."""
    actual = F.create_map(*[F.lit(x) for n, t in tables.items() if n in contracts.ALL for x in (n, float(len(t.columns)))])
    wrong = (F.col("check_name") == "contract_enforced") & (F.col("measured_value") != F.try_element_at(actual, F.col("grain")))
    rows = counted(card, {"wrong_column_counts": wrong} | outside("unknown_categories", "category", CATEGORIES) | outside("unknown_statuses", "status", STATUSES))
    return judged(union_all([rows, repeated(card, "repeated_checks", ["check_name", "grain", "run_date"])]), {"none": 0})
