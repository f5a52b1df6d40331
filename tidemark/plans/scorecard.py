"""The scorecard: contracts, unit cases, distribution checks and detectors in one table, for one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.numbers import count_where, plain_text
from . import contracts, detectors
from .checks import scorecard_checks
from .models import Warehouse

COLUMNS = {
    "check_name": "string", "category": "string", "grain": "string", "measured_value": "double", "threshold_description": "string", "status": "string",
    "acknowledged_date": "date", "run_date": "date", "run_timestamp": "timestamp_ntz",
}

#: The unit cases of the resolution model; tests/test_models.py runs them.
UNIT_CASES = (
    "test_resolution_hours_normal_close", "test_resolution_hours_closed_before_created_defect", "test_is_censored_for_open_request",
    "test_closed_but_not_yet_settled_yields_null_resolution", "test_is_settled_at_exactly_45_day_boundary", "test_is_settled_one_day_short_of_boundary",
    "test_is_settled_one_day_past_boundary",
)

_ACKNOWLEDGED = "check_name string, grain string, acknowledged_date date, acknowledged_by string, reason string"


def acknowledgments(spark: SparkSession, path: str) -> DataFrame:
    """Accepted firings, from a CSV file with a header."""
    return spark.read.schema(_ACKNOWLEDGED).option("header", True).csv(path)


def no_acknowledgments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _ACKNOWLEDGED)


def _rows(df: DataFrame, name: str, grain: Column, value: Column, bands: Column, status: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), grain.alias("grain"), value.cast("double").alias("measured_value"), bands.alias("threshold_description"), status.alias("status"))


def detector_rows(house: Warehouse) -> DataFrame:
    """The current reading of each detector."""
    config = house.config
    failed = F.when(F.col("fired"), "fail").otherwise("pass")
    start = lambda days: F.expr(f"timestamp_ntz'{config.today} 00:00:00' - interval {days} days")
    rates = detectors.latest(detectors.undated_closure_rate(house), "scan_month")
    drift = detectors.latest(detectors.composition_drift(house), "month")
    words = detectors.vocabulary_drift(house).where(F.col("first_seen_month") >= start(90))
    settled = detectors.latest(detectors.settlement_completeness(house), "cohort_month")
    recent = F.col("hour_bucket") >= F.to_timestamp_ntz(F.lit(f"{config.instant(config.today, -30):%Y-%m-%d %H:%M:%S}"))
    touches = detectors.mass_touch(house).where(recent).agg(count_where(F.col("fired")).alias("fired"))
    return detectors.union_all(
        [
            _rows(rates, "undated_closure_rate_anomaly", F.col("agency"), F.col("undated_closure_rate_pct"), F.concat(F.lit("fired if rate > "), plain_text(F.col("threshold_pct")), F.lit("%")), failed),
            _rows(drift, "composition_drift_yoy", F.col("complaint_type"), F.col("yoy_delta_pp"), F.lit(f"fired if |YoY delta| > {config.drift_points:g}pp"), failed),
            _rows(words, "vocabulary_drift_new_member", F.concat_ws(":", "dimension", "value"), F.col("volume_to_date"), F.lit("notification only, not pass/fail"), F.lit("info")),
            _rows(settled, "settlement_completeness_45d", F.date_format("cohort_month", "yyyy-MM-dd"), F.col("completeness_pct_45d"), F.lit(f"warn <{config.completeness_warn:g}%, fail <{config.completeness_fail:g}%"), F.col("status")),
            _rows(touches, "mass_metadata_touch_trailing_30d", F.lit("dataset"), F.col("fired"), F.lit("informational: count of mass-touch nights in trailing 30 days"), F.when(F.col("fired") > 0, "info").otherwise("pass")),
        ]
    )


def contract_rows(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per model: its number of columns, and whether its contract holds."""
    rows = []
    for name, columns in contracts.ALL.items():
        try:
            contracts.enforce(tables[name], name)
            status = "pass"
        except (contracts.ContractError, KeyError):
            status = "fail"
        rows.append(("contract_enforced", name, float(len(columns)), f"{len(columns)} columns, all typed", status))
    return spark.createDataFrame(rows, "check_name string, grain string, measured_value double, threshold_description string, status string")


def unit_rows(spark: SparkSession, outcomes: dict[str, bool]) -> DataFrame:
    rows = [("unit_test_passed", name, None, None, "pass" if ok else "fail") for name, ok in outcomes.items()]
    return spark.createDataFrame(rows, "check_name string, grain string, measured_value double, threshold_description string, status string")


def tables_of(house: Warehouse) -> dict[str, DataFrame]:
    return {
        "stg_service_requests": house.staged, "int_request_resolution": house.resolution, "int_request_geography": house.geography, "dim_agency": house.agencies,
        "dim_complaint_type": house.types, "dim_location": house.locations, "dim_date": house.dates, "fct_service_requests": house.fact,
    }


def scorecard(house: Warehouse, accepted: DataFrame | None = None, units: dict[str, bool] | None = None) -> DataFrame:
    """All checks of this run.  A failing detector that is acknowledged for its grain keeps its value and says so."""
    spark, config = house.bronze.sparkSession, house.config
    accepted = no_acknowledgments(spark) if accepted is None else accepted
    units = dict.fromkeys(UNIT_CASES, True) if units is None else units
    known = accepted.select("check_name", "grain", "acknowledged_date", F.lit(True).alias("known"))
    judged = detector_rows(house).join(known, ["check_name", "grain"], "left")
    judged = judged.withColumn("status", F.when((F.col("status") == "fail") & F.col("known"), "acknowledged").otherwise(F.col("status"))).drop("known")
    parts = {"contract": contract_rows(spark, tables_of(house)), "unit": unit_rows(spark, units), "distributional": scorecard_checks(house), "detector": judged}
    whole = detectors.union_all([p.withColumn("category", F.lit(c)) if c == "detector" else p.withColumns({"category": F.lit(c), "acknowledged_date": F.lit(None).cast("date")}) for c, p in parts.items()])
    return run_columns(whole, config)


def run_columns(rows: DataFrame, config: Config) -> DataFrame:
    stamped = rows.withColumns({"run_date": F.lit(config.today), "run_timestamp": F.to_timestamp_ntz(F.lit(f"{config.run_timestamp:%Y-%m-%d %H:%M:%S}"))})
    return stamped.select(*COLUMNS)
