"""Five anomaly detectors, each over the whole history.

Months are local and come out as naive timestamps; hours are UTC.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.numbers import count_where, percent, rounded
from ..functions.time import month_of, trunc_naive
from .models import Warehouse


def top_values(rows: DataFrame, column: str, n: int, weight: str | None = None) -> DataFrame:
    """The n most frequent values; equal counts go by the value.  weight: a column that says how often a row counts."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return rows.groupBy(column).agg(size.alias("size")).orderBy(F.desc("size"), column).limit(n).select(column)


def described(house: Warehouse) -> DataFrame:
    """The monthly cells of requests that have an agency and a complaint type."""
    return house.cells.where("agency is not null and complaint_type is not null")


def monthly_shares(cells: DataFrame, column: str, of_all: DataFrame | None = None) -> DataFrame:
    """month, column, n, total, pct_share: the share of each value in its month, from monthly cells.

    The total is that of all cells given, or of other cells if they are passed.
    """
    counts = cells.groupBy("month", column).agg(F.sum("n").alias("n"))
    if of_all is None:
        shares = counts.withColumn("total", F.sum("n").over(Window.partitionBy("month")))
    else:
        shares = counts.join(of_all.groupBy("month").agg(F.sum("n").alias("total")), "month")
    return shares.withColumn("pct_share", percent(F.col("n"), F.col("total")))


def _judged_rates(evaluated: DataFrame, config: Config) -> DataFrame:
    rate = F.when(F.col("closed_rows") > 0, percent(F.col("undated_closure_rows"), F.col("closed_rows")))
    month = Window.partitionBy("scan_month")  # as many rows as there are agencies
    ordinary = ~F.col("agency").isin(*config.rate_excluded_agencies)
    known = F.when(ordinary, F.col("rate_pct"))
    limit = F.avg(known).over(month) + F.lit(config.rate_sigmas) * F.stddev_pop(known).over(month)
    judged = evaluated.withColumn("rate_pct", rate).withColumns({"threshold": limit, "ordinary": count_where(ordinary).over(month)}).where("ordinary > 0")
    return judged.select(
        "scan_month",
        "agency",
        "closed_rows",
        "undated_closure_rows",
        rounded(F.col("rate_pct"), 4).alias("undated_closure_rate_pct"),
        rounded(F.col("threshold"), 6).alias("threshold_pct"),
        F.coalesce(F.col("rate_pct") > F.col("threshold"), F.lit(False)).alias("fired"),
    )


def _scan_months(rows: DataFrame, config: Config) -> DataFrame:
    """Month starts after the first month of data, up to the one after today's."""
    first = rows.agg(F.min("month").alias("first"))
    last = f"timestamp_ntz'{config.today.replace(day=1)} 00:00:00' + interval 1 month"
    return first.select(F.explode(F.expr(f"sequence(first + interval 1 month, {last}, interval 1 month)")).alias("scan_month"))


def undated_closure_rate(house: Warehouse) -> DataFrame:
    """Each agency's share of closures without a date, over all requests created before each month's start.

    Cut-offs are month starts, so the counts before a cut-off are running sums of monthly counts: each request is
    counted once, not once for each later month.
    """
    config = house.config
    monthly = described(house).groupBy("agency", "month").agg(F.sum("closed").alias("closed"), F.sum("undated").alias("undated"))
    grid = _scan_months(monthly, config).crossJoin(monthly.select("agency").distinct())  # months * agencies
    at = monthly.withColumn("scan_month", (F.col("month") + F.expr("interval 1 month")).cast("timestamp_ntz")).drop("month")
    before = Window.partitionBy("agency").orderBy("scan_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = grid.join(at, ["scan_month", "agency"], "left").select(
        "scan_month",
        "agency",
        F.sum(F.coalesce("closed", F.lit(0))).over(before).alias("closed_rows"),
        F.sum(F.coalesce("undated", F.lit(0))).over(before).alias("undated_closure_rows"),
    )
    return _judged_rates(summed, config)


def undated_closure_rate_by_join(house: Warehouse) -> DataFrame:
    """The same by the inequality join that defines it; for comparison."""
    config = house.config
    rows = house.described.select("agency", "status", "closed_date", month_of(F.col("created_date"), config.timezone).alias("month"))
    grid = _scan_months(rows, config).crossJoin(rows.select("agency").distinct())
    base = rows.withColumnRenamed("agency", "own")
    joined = grid.join(base, (F.col("own") == F.col("agency")) & (F.col("month") < F.col("scan_month")), "left")
    closed = F.col("status") == "Closed"
    evaluated = joined.groupBy("scan_month", "agency").agg(
        count_where(closed).alias("closed_rows"), count_where(closed & F.col("closed_date").isNull()).alias("undated_closure_rows")
    )
    return _judged_rates(evaluated, config)


def composition_drift(house: Warehouse) -> DataFrame:
    """Shares of the largest complaint types against the same month a year before."""
    config = house.config
    base = described(house)
    largest = base.join(top_values(base, "complaint_type", config.drift_types, "n"), "complaint_type", "left_semi")
    shares = monthly_shares(largest, "complaint_type", base)
    # the row of exactly twelve months before, if there is one
    year_ago = Window.partitionBy("complaint_type").orderBy(F.year("month") * 12 + F.month("month")).rangeBetween(-12, -12)
    delta = F.col("pct_share") - F.col("before")
    return shares.withColumn("before", F.max("pct_share").over(year_ago)).where("before is not null").select(
        "month",
        "complaint_type",
        F.col("n").alias("volume"),
        rounded(F.col("pct_share"), 4).alias("pct_share"),
        rounded(F.col("before"), 4).alias("pct_share_prior_year"),
        rounded(delta, 4).alias("yoy_delta_pp"),
        (F.abs(delta) > config.drift_points).alias("fired"),
    )


def vocabulary_drift(house: Warehouse) -> DataFrame:
    """Members of three dimensions that first appeared after the first month."""
    names = ("agency", "complaint_type", "descriptor")
    rows = described(house)
    members = F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("value")) for n in names])).alias("m")
    seen = rows.select(members, "month", "n").where("m.value is not null")
    seen = seen.groupBy("m.dimension", "m.value").agg(F.min("month").alias("first_seen_month"), F.sum("n").alias("volume_to_date"))
    start = rows.agg((F.min("month") + F.expr("interval 1 month")).cast("timestamp_ntz").alias("start"))  # one row
    return seen.crossJoin(F.broadcast(start)).where("first_seen_month >= start").drop("start")


def settlement_completeness(house: Warehouse) -> DataFrame:
    """The share of each month's closed requests that were last touched within the settlement days."""
    config = house.config
    closed = house.cells.where("closed > 0").groupBy(F.col("month").alias("cohort_month"))
    cohorts = closed.agg(F.sum("closed").alias("closed_rows"), F.sum("observable").alias("observable_by_45d"))
    day = F.to_date("cohort_month")
    newest = F.trunc(F.date_sub(F.lit(config.today), config.completeness_age_days), "month")
    eligible = cohorts.where((day >= F.lit(config.completeness_first)) & ~day.isin(*config.completeness_excluded) & (day <= newest))
    share = F.col("completeness_pct_45d")
    return eligible.withColumn("completeness_pct_45d", rounded(percent(F.col("observable_by_45d"), F.col("closed_rows")), 2)).withColumns(
        {
            "warn_threshold_pct": F.lit(config.completeness_warn),
            "fail_threshold_pct": F.lit(config.completeness_fail),
            "status": F.when(share < config.completeness_fail, "fail").when(share < config.completeness_warn, "warn").otherwise("pass"),
        }
    )


def mass_touch(house: Warehouse) -> DataFrame:
    """Hours in which many agencies' rows were touched at once, and far more of them than on ordinary nights."""
    config = house.config
    hours = house.touches.groupBy("hour_bucket").agg(F.count_distinct("agency").alias("distinct_agencies"), F.sum("n").alias("total_rows"))
    eligible = hours.where(F.col("distinct_agencies") >= config.touch_agencies)
    ordinary = eligible.where(F.col("total_rows") < config.touch_ordinary_below)
    limit = ordinary.agg((F.avg("total_rows") + F.lit(config.touch_sigmas) * F.stddev_pop("total_rows")).alias("limit"))  # one row
    return eligible.crossJoin(F.broadcast(limit)).select(
        "hour_bucket", "distinct_agencies", "total_rows", F.round("limit", 0).alias("threshold_rows"), (F.col("total_rows") > F.col("limit")).alias("fired")
    )


def latest(rows: DataFrame, column: str) -> DataFrame:
    """The rows of the newest value of a column, of a detector's few rows: in one pass over what makes them."""
    newest = F.max(column).over(Window.partitionBy())
    return rows.withColumn("newest_", newest).where(F.col(column) == F.col("newest_")).drop("newest_")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def month_start(config: Config, months: int = 0) -> Column:
    """The first of today's month, some months later, as a naive timestamp."""
    return F.expr(f"timestamp_ntz'{config.today.replace(day=1)} 00:00:00' + interval {months} months")


__all__ = [
    "composition_drift", "described", "latest", "mass_touch", "month_start", "monthly_shares", "settlement_completeness", "top_values", "trunc_naive", "undated_closure_rate",
    "undated_closure_rate_by_join", "union_all", "vocabulary_drift",
]
