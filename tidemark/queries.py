"""The queries over the sample tables.  Each takes a session and a folder of parquet tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.numbers import rounded
from .functions.time import anchor_column, month_windows, naive_utc
from .operators.history import merged
from .operators.table import VersionedTable
from .operators.upsert import changes, newest_by_key, scoped_upsert
from .plans import assertions, checks, detectors, metrics, scorecard, serving
from .plans.detectors import union_all
from .plans.models import Warehouse, recent_slice
from .session import prepared, scratch_folder, written
from .sources import probes
from .sources.files import Store
from .sources.schema import decode_json
from .sources.sample import SAMPLE, SOURCES, sample_bronze

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def house(spark: SparkSession, folder: str, **changed: object) -> Warehouse:
    """The models as views over the bronze table."""
    return Warehouse(sample_bronze(prepared(spark), folder), dataclasses.replace(SAMPLE, **changed))


_BUILT: dict[tuple, Warehouse] = {}


def marts(spark: SparkSession, folder: str, **changed: object) -> Warehouse:
    """The models as tables, built once for a session, a folder and the files in it.

    Detectors, checks, metrics and serving tables read these: as views, each of them would build the fact again.
    """
    config = dataclasses.replace(SAMPLE, **changed)
    files = tuple(Store(spark, folder).stamps(f"{t}.parquet") for t in SOURCES)
    # of the parameters, only these go into the tables
    key = (spark.sparkContext.applicationId, folder, files, config.as_of, config.timezone, config.settlement_days, config.completeness_days)
    if key not in _BUILT:
        _BUILT[key] = house(spark, folder, **changed).materialise(scratch_folder(spark))
    made = Warehouse(_BUILT[key].bronze, config)
    made.use_tables(_BUILT[key])
    return made


def _query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        return f

    return add


def _of_house(name: str, plan: Callable[[Warehouse], DataFrame]) -> None:
    """A query over the models as views."""
    _QUERIES[name] = lambda spark, folder: _plain(plan(house(spark, folder)))


def _of_marts(name: str, plan: Callable[[Warehouse], DataFrame], **changed: object) -> None:
    """A query over the models as tables."""
    _QUERIES[name] = lambda spark, folder: _plain(plan(marts(spark, folder, **changed)))


def _plain(df: DataFrame) -> DataFrame:
    """Instants as naive UTC, so that a result does not depend on the reader's zone."""
    return df.select(*[naive_utc(F.col(f"`{c}`")).alias(c) if t == "timestamp" else F.col(f"`{c}`") for c, t in df.dtypes])


def _six(df: DataFrame, *columns: str) -> DataFrame:
    """Interpolated percentiles and ratios to six places, as engines differ in the last bit."""
    return df.select(*[rounded(F.col(c), 6).alias(c) if c in columns else F.col(c) for c in df.columns])


_STAGED = "unique_key created_date closed_date updated_at agency agency_name complaint_type descriptor incident_zip status community_board borough latitude longitude has_valid_coordinates".split()
_of_house("Q1_staging", lambda h: h.staged.select(*_STAGED))
_of_house("Q2_resolution", lambda h: h.resolution)
_of_house("Q3_geography", lambda h: h.geography)
_of_house("Q4_dim_agency", lambda h: h.agencies)
_of_house("Q5_dim_complaint_type", lambda h: h.types)
_of_house("Q6_dim_location", lambda h: h.locations)
_of_house("Q7_dim_date", lambda h: h.dates)
_of_house("Q8_fact", lambda h: h.fact)
_of_marts("Q9_undated_closure_rate", detectors.undated_closure_rate)
_of_marts("Q9_undated_closure_rate_one_sigma", detectors.undated_closure_rate, rate_sigmas=1.0)
_of_marts("Q10_composition_drift", detectors.composition_drift)
_of_marts("Q11_vocabulary_drift", detectors.vocabulary_drift)
_of_marts("Q12_settlement_completeness", detectors.settlement_completeness)
_of_marts("Q13_mass_touch", detectors.mass_touch)
_of_marts("Q14_distribution_checks", lambda h: _six(checks.scorecard_checks(h), "measured_value"))
_of_marts("Q15_distribution_failed_rows", checks.failed_rows)
_of_marts("Q18_overview", lambda h: _six(serving.overview(h), "p90_resolution_hours"))
_of_marts("Q19_agency_performance", lambda h: _six(serving.agency_performance(h), "p90_resolution_hours"))
_of_marts("Q20_geo_equity", serving.geo_equity)
_of_marts("Q20_missing_coordinates", serving.missing_coordinates)
_of_marts("Q21_seasonality", serving.seasonality)
_of_marts("Q22_naive_vs_correct", serving.naive_vs_correct)
_of_marts("Q23_mass_touch_fired", lambda h: detectors.mass_touch(h).where("fired"), touch_sigmas=1.0)  # three: no row in the sample
_of_marts("Q24_type_share", lambda h: serving.type_share(serving.seasonality(h), "1-URGENT"))
_of_marts("Q24_monthly_volume", lambda h: serving.monthly_volume(serving.seasonality(h)))
_of_house("Q27_quality_baseline", lambda h: serving.quality_baseline(h.bronze))
_of_marts("Q28_agency_service_levels", lambda h: _six(serving.agency_service_levels(h), "p90_hours"))
_of_marts("Q28_equity_by_borough", lambda h: _six(serving.equity_by_borough(h), "p90_hours"))
_of_marts("Q28_share_by_calendar_month", serving.share_by_calendar_month)
_of_marts("Q28_undated_by_month", serving.undated_by_month)
_of_marts("Q28_missing_by_month", serving.missing_by_month)
_of_house("SC15_recent_slice", lambda h: recent_slice(h.bronze, 90).select("unique_key", "created_date"))
_of_house("SC18_grouped_counts", lambda h: h.bronze.groupBy("status", F.hour("created_date").cast("bigint").alias("hour")).agg(F.count(F.lit(1)).alias("n")))
_of_house("A17_touch_frequencies", lambda h: probes.stamp_frequencies(h.bronze, "updated_at").where("n > 1"))
_of_house("A17_touch_lags", lambda h: probes.lags(h.bronze, "created_date", "updated_at", "status"))
_of_marts("J16_model_assertions", assertions.model_assertions)


def _accepted(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([("composition_drift_yoy", "1-URGENT", "2001-07-01", "review", "known")], "check_name string, grain string, day string, acknowledged_by string, reason string")
    return rows.select("check_name", "grain", F.to_date("day").alias("acknowledged_date"), "acknowledged_by", "reason")


def _scorecard(h: Warehouse) -> DataFrame:
    card = scorecard.scorecard(h, _accepted(h.bronze.sparkSession))
    shares = F.col("category") == "distributional"
    return card.withColumn("measured_value", F.when(shares, rounded(F.col("measured_value"), 6)).otherwise(F.col("measured_value")))


def _history(h: Warehouse) -> DataFrame:
    """39 weekly snapshots before today's, made of it, and merged with it."""
    today = written(_scorecard(h))
    weeks = h.bronze.sparkSession.range(1, 40).select(F.col("id").cast("int").alias("i"))
    earlier = today.crossJoin(F.broadcast(weeks)).withColumns(
        {
            "measured_value": F.col("measured_value") + F.col("i"),
            "status": F.when((F.col("i") % 3 == 1) & (F.col("status") == "pass"), "warn").otherwise(F.col("status")),
            "run_date": F.date_sub("run_date", F.col("i") * 7),
            "run_timestamp": (F.col("run_timestamp") - F.make_dt_interval(F.col("i") * 7)).cast("timestamp_ntz"),
        }
    )
    return merged(earlier.drop("i"), today, h.config.today, h.config.history_days)


_of_marts("Q16_scorecard", _scorecard)
_of_marts("J13_scorecard_assertions", lambda h: assertions.scorecard_assertions(_scorecard(h), scorecard.tables_of(h)))
_of_marts("Q17_history_merge", _history)
_of_marts("Q24_latest_scorecard", lambda h: serving.latest_scorecard(written(_history(h))))
_of_marts("Q24_scorecard_trend", lambda h: serving.scorecard_trend(_history(h)))

_RATIOS = [m for m in metrics.METRICS if m.endswith("_rate") or "closure_rate" in m]


def _metric(name: str, group_by: list[str], where: str | None = None) -> None:
    _of_marts(name, lambda h: _six(metrics.metric_query(h, metrics.METRICS, group_by, where), "p90_resolution_hours", *_RATIOS))


_metric("Q25_metrics_total", [])
_metric("Q25_metrics_by_agency", ["agency"])
_metric("Q25_metrics_by_month", ["metric_time__month"])
_metric("Q25_metrics_by_type_and_borough", ["complaint_type", "descriptor", "borough"])
_metric("Q25_metrics_by_calendar", ["season", "day_name", "is_weekend"])
_metric("Q25_metrics_by_status_where", ["status", "community_board"], "has_valid_coordinates")


def freshness(bronze: DataFrame, config, warn_days: int = 3, error_days: int = 10) -> DataFrame:
    """How old the newest change is, in days of UTC, and whether that is too old."""
    old = F.datediff(F.to_date(naive_utc(config.midnight())), F.to_date(naive_utc(F.col("newest")))).cast("bigint")
    status = F.when(F.col("days_old") > error_days, "error").when(F.col("days_old") > warn_days, "warn").otherwise("pass")
    return bronze.agg(F.max("updated_at").alias("newest")).withColumn("days_old", old).withColumn("status", status)


_of_house("SC16_freshness", lambda h: freshness(h.bronze, h.config))


@_query("ST1_watermark_window")
def _watermark(spark: SparkSession, folder: str) -> DataFrame:
    """A run's window: from the cursor less 48 hours, inclusive, up to the anchored boundary."""
    low, high = "timestamp_ntz'2001-06-01 00:00:00' - interval 48 hours", "timestamp_ntz'2001-08-01 03:00:00'"
    rows = house(spark, folder).bronze.select("unique_key", naive_utc(F.col("updated_at")).alias("updated_at"), "created_date")
    return rows.where(f"updated_at >= {low} and updated_at < {high} and created_date >= timestamp_ntz'2001-05-01 00:00:00'").drop("created_date")


@_query("F22_anchor")
def _anchor(spark: SparkSession, folder: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/events.parquet").select("event_id", anchor_column(F.col("ts")).alias("anchored"))


@_query("J16_missing_references")
def _references(spark: SparkSession, folder: str) -> DataFrame:
    keys = {"agency": "agency_key", "complaint_type": "complaint_type_key", "location": "location_key"}
    one = marts(spark, folder).fact.agg(*[F.count_if(F.col(k).isNull()).alias(d) for d, k in keys.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("missing")) for d in keys])).alias("m")).select("m.*")


@_query("U3_shared_parts")
def _shared(spark: SparkSession, folder: str) -> DataFrame:
    """Parts that occur both among returned and among open lines."""
    lines = prepared(spark).read.parquet(f"{folder}/lineitem.parquet")
    return probes.page_overlap(lines.where("l_returnflag = 'R'"), lines.where("l_linestatus = 'O'"), "l_partkey")


@_query("PF9_repeated_keys")
def _repeated(spark: SparkSession, folder: str) -> DataFrame:
    lines = prepared(spark).read.parquet(f"{folder}/lineitem.parquet")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@_query("Q26_upsert")
def _upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A table (lines that were returned or accepted) and a batch (lines still open, some restated): what becomes of each row."""
    lines = prepared(spark).read.parquet(f"{folder}/lineitem.parquet")
    lines = lines.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    keys = ["l_orderkey", "l_linenumber"]
    newest = newest_by_key(lines, keys, "l_shipdate").withColumnRenamed("l_shipdate", "created_date")
    columns = [*keys, "created_date", "l_quantity"]
    restated = F.when(F.col("l_discount") > 0.05, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    batch = newest.where("l_linestatus = 'O'").withColumn("l_quantity", restated).select(columns)
    return changes(newest.where("l_returnflag <> 'N'").select(columns), batch, keys).drop("old")


@_query("F19_decode")
def _decode(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as the source's JSON objects of strings, some of them empty, decoded to typed columns."""
    key = F.col("o_orderkey")
    text = lambda c, every: F.when(key % every == 0, "").otherwise(c)
    stamp = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    orders = prepared(spark).read.parquet(f"{folder}/orders.parquet")
    rows = orders.select(
        F.to_json(
            F.struct(
                key.cast("string").alias("unique_key"),
                stamp.alias("created_date"),
                text(stamp, 7).alias("closed_date"),
                F.concat(stamp, F.lit("Z")).alias(":updated_at"),
                text((key / 8).cast("string"), 5).alias("latitude"),
                F.when(key % 3 != 0, F.struct(F.array((key / 4).cast("double"), (key / 2).cast("double")).alias("coordinates"))).alias("location"),
            )
        ).alias("json")
    )
    decoded = decode_json(rows).select("unique_key", "created_date", "closed_date", "updated_at", "latitude", "location_lon", "location_lat", "agency")
    return _plain(decoded)


@_query("F23_month_windows")
def _windows(spark: SparkSession, folder: str) -> DataFrame:
    """The months of the orders, clipped to the first and the last one's time."""
    first, last = prepared(spark).read.parquet(f"{folder}/orders.parquet").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    naive = lambda x: dt.datetime(x.year, x.month, x.day)
    return spark.createDataFrame(list(month_windows(naive(first), naive(last))), "label string, start timestamp_ntz, end timestamp_ntz")


def _monthly_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their month as the day of the partition."""
    lines = prepared(spark).read.parquet(f"{folder}/lineitem.parquet")
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("created_date")
    rows = lines.select("l_orderkey", "l_linenumber", month, "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    return newest_by_key(rows, ["l_orderkey", "l_linenumber"], "l_shipdate").drop("l_shipdate")


def _lines_table(spark: SparkSession, rows: DataFrame) -> VersionedTable:
    table = VersionedTable.create(spark, scratch_folder(spark), rows.schema, "created_date")
    table.append(rows)
    return table


@_query("SK3_upsert_table")
def _upsert_table(spark: SparkSession, folder: str) -> DataFrame:
    """A written table after a scoped upsert, and the same batch again, which changes nothing."""
    lines = _monthly_lines(spark, folder)
    table = _lines_table(spark, lines.where("l_returnflag <> 'N'"))
    restated = F.when(F.col("l_discount") > 0.05, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    batch = lines.where("l_linestatus = 'O' or l_returnflag = 'R'").withColumn("l_quantity", restated)
    scoped_upsert(table, batch, ["l_orderkey", "l_linenumber"])
    scoped_upsert(table, batch, ["l_orderkey", "l_linenumber"])
    return table.read().select("l_orderkey", "l_linenumber", "created_date", "l_quantity", "l_returnflag")


@_query("SK5_table_versions")
def _table_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Append, overwrite by filter, delete by filter: the rows and sums of every version, read back in time."""
    lines = _monthly_lines(spark, folder)
    table = _lines_table(spark, lines.where("l_returnflag = 'A'"))
    table.append(lines.where("l_returnflag = 'R'"))
    table.overwrite_where(F.col("created_date") < dt.date(1994, 1, 1), lines.where("l_returnflag = 'N' and created_date < date'1996-01-01'"))
    table.delete_where(F.col("l_quantity") > 40)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.max("created_date").alias("newest")]
    return union_all([table.read(version=v).agg(*sums).select(F.lit(v).alias("version"), "*") for v in table.versions()[1:]])


@_query("SC6_table_months")
def _table_months(spark: SparkSession, folder: str) -> DataFrame:
    """Some months of a written table: only their folders are read."""
    table = _lines_table(spark, _monthly_lines(spark, folder))
    rows = table.read(between=(dt.date(1995, 1, 1), dt.date(1995, 12, 31)))
    return rows.groupBy("created_date").agg(F.count(F.lit(1)).alias("n"))


@_query("SC8_seed_file")
def _seed_file(spark: SparkSession, folder: str) -> DataFrame:
    """Nations written as a CSV file, read back as text and cast, with what is no number as null."""
    nations = prepared(spark).read.parquet(f"{folder}/nation.parquet")
    path = scratch_folder(spark)
    odd = F.when(F.col("n_nationkey") % 5 == 0, "none").otherwise(F.col("n_nationkey").cast("string"))
    nations.select(odd.alias("number"), "n_name").write.option("header", True).csv(path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select("n_name", F.expr("try_cast(number as bigint)").alias("number"))


@_query("SC17_arrow_relation")
def _arrow_relation(spark: SparkSession, folder: str) -> DataFrame:
    """A small Arrow table (the regions) as a relation, joined with a scan."""
    regions = prepared(spark).read.parquet(f"{folder}/region.parquet").select("r_regionkey", "r_name").toArrow()
    small = spark.createDataFrame(regions)
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    return nations.join(small, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
