"""Pre-aggregated tables for dashboards, the queries of the pages, and the recurring analytical questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import count_where, percent, rounded
from ..functions.time import hours_crossed, local, month_of
from . import detectors
from .models import LATITUDES, LONGITUDES, Warehouse


def _counted() -> Column:
    """Hours of requests that count for resolution: settled, closed, dated."""
    return F.when(F.col("is_settled") & F.col("is_closed") & ~F.col("is_undated_closure"), F.col("resolution_hours"))


def _share(condition: Column, whole: Column, places: int = 4) -> Column:
    return rounded(percent(count_where(condition), whole), places)


def overview(house: Warehouse) -> DataFrame:
    day = lambda c: F.date_format(local(c, house.config.timezone), "yyyy-MM-dd")
    everything = F.count(F.lit(1))
    return house.fact.agg(
        everything.alias("request_count"),
        F.count_distinct("agency_key").alias("agency_count"),
        day(F.min("created_date")).alias("date_min"),
        day(F.max("created_date")).alias("date_max"),
        _share(F.col("is_closed"), everything).alias("closure_rate_pct"),
        _share(F.col("is_settled"), everything).alias("settlement_rate_pct"),
        F.median(_counted()).alias("median_resolution_hours"),
        F.percentile(_counted(), F.lit(0.9)).alias("p90_resolution_hours"),
    )


def agency_performance(house: Warehouse) -> DataFrame:
    everything, settled = F.count(F.lit(1)), F.col("is_settled")
    both = F.col("is_closed") & settled
    measured = house.fact.groupBy("agency_key").agg(
        everything.alias("request_count"),
        F.median(_counted()).alias("median_resolution_hours"),
        F.percentile(_counted(), F.lit(0.9)).alias("p90_resolution_hours"),
        _share(F.col("is_closed"), everything).alias("closure_rate_pct"),
        _share(settled, everything).alias("settlement_rate_pct"),
        _share(both, count_where(settled)).alias("naive_closure_rate_pct"),
        _share(both, count_where(settled & ~F.col("is_undated_closure"))).alias("closure_rate_excl_backlog_pct"),
    )
    # aggregated by key first: the join then meets one row per agency
    return house.agencies.join(measured, "agency_key").drop("agency_key")


def geo_equity(house: Warehouse, types: int = 10) -> DataFrame:
    rows = house.fact.join(house.types.select("complaint_type_key", "complaint_type"), "complaint_type_key")
    largest = detectors.top_values(rows, "complaint_type", types)
    rows = rows.where("borough is not null and borough <> '' and has_valid_coordinates").join(largest, "complaint_type", "left_semi")
    return rows.groupBy("complaint_type", "borough").agg(F.count(F.lit(1)).alias("request_count"), F.median(_counted()).alias("median_resolution_hours"))


def missing_coordinates(house: Warehouse) -> DataFrame:
    return house.fact.agg(_share(~F.col("has_valid_coordinates"), F.count(F.lit(1)), 2).alias("missing_coord_pct"))


def seasonality(house: Warehouse, types: int = 10) -> DataFrame:
    """Shares of the largest types in each whole month: the first and the last month of data are partial and go."""
    rows = house.cells.where("complaint_type is not null")
    largest = rows.join(detectors.top_values(rows, "complaint_type", types, "n"), "complaint_type", "left_semi")
    shares = detectors.monthly_shares(largest, "complaint_type", house.cells)
    ends = house.cells.agg(F.min("month").alias("first"), F.max("month").alias("last"))  # one row
    return (
        shares.crossJoin(F.broadcast(ends))
        .where("month > first and month < last")
        .select(F.to_date("month").alias("month"), "complaint_type", F.col("n").alias("request_count"), rounded(F.col("pct_share"), 4).alias("pct_share_of_month"), F.col("total").alias("month_total_requests"))
    )


def naive_vs_correct(house: Warehouse) -> DataFrame:
    naive = hours_crossed(F.col("created_date"), F.col("closed_date"))
    return house.fact.agg(F.median(_counted()).alias("correct_median_resolution_hours"), F.median(naive).alias("naive_median_resolution_hours"))


def serving_tables(house: Warehouse, scorecard: DataFrame) -> dict[str, DataFrame]:
    """The ten tables of the serving database; none holds rows of the fact."""
    return {
        "overview": overview(house), "agency_performance": agency_performance(house), "geo_equity": geo_equity(house), "geo_equity_missing_coords": missing_coordinates(house),
        "seasonality": seasonality(house), "dq_scorecard": scorecard, "dq_settlement_completeness": detectors.settlement_completeness(house),
        "dq_vocabulary_drift": detectors.vocabulary_drift(house), "dq_mass_touch": detectors.mass_touch(house).where("fired"),
        "dq_resolution_hours_naive_vs_correct": naive_vs_correct(house),
    }


def write_serving(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")


def latest_scorecard(history: DataFrame) -> DataFrame:
    return detectors.latest(history, "run_date")


def scorecard_trend(history: DataFrame) -> DataFrame:
    fine, everything = F.col("status").isin("pass", "acknowledged", "info"), F.count(F.lit(1))
    return history.groupBy("run_date").agg(
        everything.alias("checks_run"), count_where(F.col("status").isin("fail", "warn")).alias("checks_not_passing"), rounded(percent(count_where(fine), everything), 1).alias("pass_rate_pct")
    )


def type_share(seasonal: DataFrame, complaint_type: str) -> DataFrame:
    return seasonal.where(F.col("complaint_type") == complaint_type).select("month", "pct_share_of_month")


def monthly_volume(seasonal: DataFrame) -> DataFrame:
    return seasonal.select("month", "month_total_requests").distinct()


def quality_baseline(bronze: DataFrame) -> DataFrame:
    """Six data-quality figures over raw rows: one row per metric with its count and percentage."""
    lat, lon, everything = F.col("latitude"), F.col("longitude"), F.count(F.lit(1))
    # zero counts as missing, as an empty value does
    absent = lat.isNull() | lon.isNull() | (lat == 0) | (lon == 0)
    outside = ~absent & ~(lat.between(*LATITUDES) & lon.between(*LONGITUDES))
    unspecified = F.coalesce(F.trim("borough"), F.lit("")).isin("", "Unspecified")
    one = bronze.agg(
        everything.alias("n"),
        count_where(F.col("closed_date") < F.col("created_date")).alias("closed_before_created"),
        count_where((F.col("status") == "Closed") & F.col("closed_date").isNull()).alias("closed_without_date"),
        count_where(absent).alias("missing_coordinates"),
        count_where(outside).alias("outside_bounds"),
        count_where(unspecified).alias("unspecified_borough"),
        F.count_distinct("complaint_type").alias("distinct_complaint_types"),
        F.count_distinct("agency").alias("distinct_agencies"),
    )
    shares = ("closed_before_created", "closed_without_date", "missing_coordinates", "outside_bounds", "unspecified_borough")
    counts = ("distinct_complaint_types", "distinct_agencies")
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"), (rounded(percent(F.col(c), F.col("n")), 4) if c in shares else F.lit(None).cast("double")).alias("pct")) for c in shares + counts]
    return one.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def agency_service_levels(house: Warehouse) -> DataFrame:
    """Settled requests of each agency: how many are closed, how many censored, and how long they took."""
    settled = house.fact.where("is_settled")
    measured = settled.groupBy("agency_key").agg(
        F.count(F.lit(1)).alias("settled"),
        count_where(F.col("is_closed")).alias("closed"),
        _share(F.col("is_closed"), F.count(F.lit(1)), 1).alias("closure_rate_pct"),
        count_where(F.col("is_censored")).alias("censored"),
        F.median("resolution_hours").alias("median_hours"),
        F.percentile("resolution_hours", F.lit(0.9)).alias("p90_hours"),
    )
    return house.agencies.select("agency_key", "agency").join(measured, "agency_key").drop("agency_key")


def equity_by_borough(house: Warehouse, types: int = 5) -> DataFrame:
    rows = house.fact.join(house.types.select("complaint_type_key", "complaint_type"), "complaint_type_key")
    rows = rows.join(detectors.top_values(rows, "complaint_type", types), "complaint_type", "left_semi").where("is_settled")
    return rows.groupBy("complaint_type", "borough").agg(F.count(F.lit(1)).alias("settled"), F.median("resolution_hours").alias("median_hours"), F.percentile("resolution_hours", F.lit(0.9)).alias("p90_hours"))


def share_by_calendar_month(house: Warehouse) -> DataFrame:
    """Each type's share of a calendar month's requests, all years together."""
    month = F.month(local(F.col("created_date"), house.config.timezone)).cast("bigint").alias("month")
    rows = house.fact.join(house.types.select("complaint_type_key", "complaint_type"), "complaint_type_key").select(month, "complaint_type")
    counts = rows.groupBy("month", "complaint_type").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("month").agg(F.sum("n").alias("total"))
    return counts.join(totals, "month").select("month", "complaint_type", "n", rounded(percent(F.col("n"), F.col("total")), 4).alias("pct_share"))


def undated_by_month(house: Warehouse) -> DataFrame:
    """Closures without a date by agency and month of creation."""
    rows = house.fact.where("is_undated_closure").join(house.agencies.select("agency_key", "agency"), "agency_key")
    return rows.groupBy("agency", month_of(F.col("created_date"), house.config.timezone).alias("month")).agg(F.count(F.lit(1)).alias("undated"))


def missing_by_month(house: Warehouse) -> DataFrame:
    month = month_of(F.col("created_date"), house.config.timezone).alias("month")
    missing = ~F.col("has_valid_coordinates")
    return house.fact.groupBy(month).agg(F.count(F.lit(1)).alias("total"), count_where(missing).alias("missing"), _share(missing, F.count(F.lit(1)), 2).alias("pct_missing"))
