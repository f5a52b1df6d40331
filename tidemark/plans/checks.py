"""Six distribution checks, as scorecard rows and as failed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.numbers import count_where, percent, rounded
from ..functions.time import local
from .detectors import described, month_start, monthly_shares, top_values, union_all
from .models import Warehouse


def _row(rows: DataFrame, name: str, grain: str, value: Column, bands: str, passes: Column) -> DataFrame:
    """One scorecard row from a one-row table; a null comparison fails."""
    status = F.when(passes, "pass").otherwise("fail")
    return rows.select(F.lit(name).alias("check_name"), F.lit(grain).alias("grain"), value.cast("double").alias("measured_value"), F.lit(bands).alias("threshold_description"), status.alias("status"))


def _number(x: float) -> str:
    return f"{x:g}"


def _measures(house: Warehouse) -> DataFrame:
    """All measures that are plain aggregates, in one pass: one row."""
    config = house.config
    day = F.to_date(local(F.col("created_date"), config.timezone))
    recent = F.col("created_date") >= config.midnight(-30)
    cohort = F.col("is_settled") & (F.col("created_date") >= config.midnight(-75)) & (F.col("created_date") < config.midnight(-45))
    hours = F.when(cohort & F.col("is_closed"), F.col("resolution_hours"))
    percentile = lambda q: F.percentile(hours, F.lit(q))  # noqa: E731  exact
    return house.fact.where("agency_key is not null and complaint_type_key is not null").agg(
        count_where(day == F.date_sub(F.lit(config.today), 2)).alias("volume"),
        percent(F.sum(F.when(recent & ~F.col("has_valid_coordinates"), 1).when(recent, 0)), count_where(recent)).alias("missing"),
        percentile(0.5).alias("median"),
        percentile(0.9).alias("p90"),
        percent(F.sum(F.when(cohort & F.col("is_closed"), 1).when(cohort, 0)), count_where(cohort)).alias("closed"),
    )


def _deltas(shares: DataFrame, column: str, config: Config) -> DataFrame:
    """Change of each value's share since its previous month with rows, in the last two months and this one."""
    before = F.lag("pct_share").over(Window.partitionBy(column).orderBy("month"))
    return shares.withColumn("mom_delta", F.col("pct_share") - before).where(F.col("month") >= month_start(config, -2))


def _type_cells(house: Warehouse) -> DataFrame:
    cells = described(house)
    return cells.join(top_values(cells, "complaint_type", house.config.shift_types, "n"), "complaint_type", "left_semi")


def scorecard_checks(house: Warehouse) -> DataFrame:
    """Scorecard version: shares of the largest types are of these types' volume."""
    config, one = house.config, _measures(house)
    missing, closed = rounded(F.col("missing"), 2), rounded(F.col("closed"), 2)
    median, p90 = rounded(F.col("median"), 1), rounded(F.col("p90"), 1)
    within = lambda x, band: x.between(float(band[0]), float(band[1]))
    pair = lambda band, mark="": f"[{_number(band[0])}{mark}, {_number(band[1])}{mark}]"
    missing_text = f"[{config.missing_band[0]:.1f}%, {config.missing_band[1]:.1f}%]"
    medians = f"median in [{_number(config.median_band[0])},{_number(config.median_band[1])}], p90 in [{_number(config.p90_band[0])},{_number(config.p90_band[1])}]"

    def shift(shares: DataFrame, column: str, name: str, grain: str) -> DataFrame:
        largest = _deltas(shares, column, config).agg(F.coalesce(F.max(F.abs("mom_delta")), F.lit(0.0)).alias("delta"))
        return _row(largest, name, grain, F.col("delta"), f"fail if any |delta| > {_number(config.shift_points)}pp", ~(F.col("delta") > config.shift_points))

    return union_all(
        [
            _row(one, "row_count_volume", "recent_complete_day", F.col("volume"), pair(config.volume_band), within(F.col("volume"), config.volume_band)),
            _row(one, "missing_coordinate_rate", "trailing_30_days", missing, missing_text, within(missing, config.missing_band)),
            _row(one, "resolution_hours_p50_p90", "recently_settled_cohort", median, medians, within(median, config.median_band) & within(p90, config.p90_band)),
            _row(one, "closure_rate_at_settlement", "settlement_boundary_cohort", closed, pair(config.closure_band, "%"), within(closed, config.closure_band)),
            shift(monthly_shares(_type_cells(house), "complaint_type"), "complaint_type", "complaint_type_mom_share_shift", "top_10_types_trailing_2_months"),
            shift(monthly_shares(described(house), "agency"), "agency", "agency_mom_share_shift", "all_agencies_trailing_2_months"),
        ]
    )


def failed_rows(house: Warehouse) -> DataFrame:
    """Failed-rows version: check_name, item, month, value for whatever lies outside a band.

    Shares of the largest types are of all volume here, and an empty cohort gives no row.
    """
    config, one = house.config, _measures(house)

    def outside(name: str, value: Column, bad: Column) -> DataFrame:
        none = F.lit(None)
        return one.where(bad).select(F.lit(name).alias("check_name"), none.cast("string").alias("item"), none.cast("timestamp_ntz").alias("month"), value.cast("double").alias("value"))

    def shifted(name: str, shares: DataFrame, column: str) -> DataFrame:
        moved = _deltas(shares, column, config).where(F.abs("mom_delta") > config.shift_points)
        return moved.select(F.lit(name).alias("check_name"), F.col(column).alias("item"), "month", rounded(F.col("mom_delta"), 6).alias("value"))

    off = lambda x, band: (x < float(band[0])) | (x > float(band[1]))
    missing, closed = rounded(F.col("missing"), 2), rounded(F.col("closed"), 2)
    median, p90 = rounded(F.col("median"), 1), rounded(F.col("p90"), 1)
    return union_all(
        [
            outside("row_count_volume", F.col("volume"), off(F.col("volume"), config.volume_band)),
            outside("missing_coordinate_rate", missing, off(missing, config.missing_band)),
            outside("resolution_hours_p50_p90", median, off(median, config.median_band) | off(p90, config.p90_band)),
            outside("closure_rate_at_settlement", closed, off(closed, config.closure_band)),
            shifted("complaint_type_mom_share_shift", monthly_shares(_type_cells(house), "complaint_type", described(house)), "complaint_type"),
            shifted("agency_mom_share_shift", monthly_shares(described(house), "agency"), "agency"),
        ]
    )
