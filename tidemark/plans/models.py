"""Staging, resolution, geography, dimensions and the fact: pure functions from tables to tables."""

from __future__ import annotations

import dataclasses
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.numbers import count_where
from ..functions.time import days_crossed, hour_of, hours_crossed, local, localize, month_of
from . import contracts

#: Degrees that enclose the city: fixed values.
LATITUDES, LONGITUDES = (40.4959, 40.9153), (-74.2557, -73.7002)

#: The tables that a warehouse writes, each made of those before it.
TABLES = ("agencies", "types", "locations", "dates", "fact", "cells", "touches")

_TRIMMED = ("descriptor_2", "status", "borough")
_UPPER = ("complaint_type", "descriptor", "city")
_LOCAL = ("created_date", "closed_date", "due_date", "resolution_action_updated_date")


def valid_coordinates() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return lat.isNotNull() & lon.isNotNull() & lat.between(*LATITUDES) & lon.between(*LONGITUDES) & ~((lat == 0) & (lon == 0))


def recent_slice(bronze: DataFrame, days: int) -> DataFrame:
    """The rows of the last days before the newest one (development only)."""
    newest = bronze.agg(F.max("created_date").alias("newest"))  # one row
    return bronze.crossJoin(F.broadcast(newest)).where(F.col("created_date") >= F.col("newest") - F.expr(f"interval {days} days")).drop("newest")


def staging(bronze: DataFrame, config: Config) -> DataFrame:
    """Shape, not meaning: instants, trimmed and upper-cased text, a coordinate flag."""
    if config.recent_days is not None:
        bronze = recent_slice(bronze, config.recent_days)

    def column(name: str) -> Column:
        if name == "has_valid_coordinates":
            return valid_coordinates().alias(name)
        c = F.col(name)
        c = localize(c, config.timezone) if name in _LOCAL else F.upper(F.trim(c)) if name in _UPPER else F.trim(c) if name in _TRIMMED else c
        return c.alias(name)

    return contracts.enforce(bronze.select(*[column(n) for n in contracts.STAGING]), "stg_service_requests")


def with_resolution(staged: DataFrame, config: Config) -> DataFrame:
    """Add the resolution flags and hours.

    Settlement is keyed on creation and counts from local midnight, inclusive.  Plain three-valued logic: a null status
    gives null flags.
    """
    closed = (F.col("status") == "Closed") & F.col("closed_date").isNotNull()
    flagged = staged.withColumns(
        {
            "is_closed": closed,
            "is_settled": F.col("created_date") <= config.midnight(-config.settlement_days),
            "is_undated_closure": (F.col("status") == "Closed") & F.col("closed_date").isNull(),
        }
    ).withColumn("is_censored", ~F.col("is_closed") | ~F.col("is_settled"))
    hours = F.when(F.col("is_censored"), F.lit(None).cast("bigint")).otherwise(hours_crossed(F.col("created_date"), F.col("closed_date")))
    return flagged.withColumn("resolution_hours", hours)


def resolution(staged: DataFrame, config: Config) -> DataFrame:
    return contracts.enforce(with_resolution(staged, config).select(*contracts.RESOLUTION), "int_request_resolution")


def geography(staged: DataFrame) -> DataFrame:
    return contracts.enforce(staged.select(*contracts.GEOGRAPHY), "int_request_geography")


def _numbered(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Surrogate keys: dimensions are small by nature, so one window over all members is fine."""
    return rows.withColumn(key, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def dim_agency(staged: DataFrame) -> DataFrame:
    members = staged.where("agency is not null").select("agency", "agency_name").distinct()
    keyed = _numbered(members, "agency_key", F.asc_nulls_last("agency"), F.asc_nulls_last("agency_name"))
    return contracts.enforce(keyed.select(*contracts.AGENCY), "dim_agency")


def dim_complaint_type(staged: DataFrame) -> DataFrame:
    """A null descriptor stays null; it sorts as the empty text."""
    members = staged.where("complaint_type is not null").select("complaint_type", "descriptor").distinct()
    keyed = _numbered(members, "complaint_type_key", F.asc_nulls_last("complaint_type"), F.coalesce("descriptor", F.lit("")).asc(), F.asc_nulls_last("descriptor"))
    return contracts.enforce(keyed.select(*contracts.COMPLAINT_TYPE), "dim_complaint_type")


def dim_location(located: DataFrame) -> DataFrame:
    members = located.where("community_board is not null").select("community_board", "borough").distinct()
    keyed = _numbered(members, "location_key", F.asc_nulls_last("borough"), F.asc_nulls_last("community_board"))
    return contracts.enforce(keyed.select(*contracts.LOCATION), "dim_location")


def dim_date(spark: SparkSession, config: Config) -> DataFrame:
    days = (config.calendar_end - config.calendar_start).days + 1
    day = F.col("calendar_date")
    spine = spark.range(days).select(F.date_add(F.lit(config.calendar_start), F.col("id").cast("int")).alias("calendar_date"))
    month = F.month(day)
    season = F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring").when(month.isin(6, 7, 8), "Summer").otherwise("Fall")
    weekday = F.dayofweek(day) - 1  # 0 is Sunday
    made = spine.select(
        day.alias("date_key"), day, F.year(day).cast("bigint").alias("year"), F.quarter(day).cast("bigint").alias("quarter"), month.cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.dayofmonth(day).cast("bigint").alias("day_of_month"), weekday.cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), weekday.isin(0, 6).alias("is_weekend"), season.alias("season"),
    )
    return contracts.enforce(made, "dim_date")


def fact(staged: DataFrame, agencies: DataFrame, types: DataFrame, locations: DataFrame, config: Config) -> DataFrame:
    """One row per request.

    Flags are computed on the staged rows, which spares two self-joins on the key.  Dimension joins carry no hint:
    adaptive execution broadcasts a dimension when its measured size allows, and joins by sorting when it doesn't.
    """
    rows = with_resolution(staged, config).withColumn("date_key", F.to_date(local(F.col("created_date"), config.timezone)))
    rows = rows.join(agencies.select("agency_key", "agency"), "agency", "left")
    named = types.select("complaint_type_key", F.col("complaint_type").alias("type"), F.coalesce("descriptor", F.lit("")).alias("detail"))
    rows = rows.join(named, (F.col("complaint_type") == F.col("type")) & (F.coalesce("descriptor", F.lit("")) == F.col("detail")), "left")
    rows = rows.join(locations, ["community_board", "borough"], "left")
    return contracts.enforce(rows.select(*contracts.FACT), "fct_service_requests")


def monthly_cells(fact: DataFrame, agencies: DataFrame, types: DataFrame, config: Config) -> DataFrame:
    """Counts of requests by local month of creation, agency and complaint type: what detectors, checks and shares read.

    The fact is counted by its keys first, so the dimensions are joined with the few cells and not with the requests.
    Cells of requests without an agency or a type are kept, with null names.
    """
    closed = F.col("status") == "Closed"
    in_time = days_crossed(F.col("created_date"), F.col("updated_at"), config.timezone) <= config.completeness_days
    counted = fact.groupBy(month_of(F.col("created_date"), config.timezone).alias("month"), "agency_key", "complaint_type_key").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(closed).alias("closed"),
        count_where(closed & F.col("closed_date").isNull()).alias("undated"),
        count_where(closed & in_time).alias("observable"),
    )
    named = counted.join(agencies.select("agency_key", "agency"), "agency_key", "left").join(types, "complaint_type_key", "left")
    return named.select("month", "agency", "complaint_type", "descriptor", "n", "closed", "undated", "observable")


def hourly_touches(fact: DataFrame, agencies: DataFrame) -> DataFrame:
    """Counts of requests by the hour of their last change and the agency; requests without an agency or type are left out."""
    counted = fact.where("complaint_type_key is not null").groupBy(hour_of(F.col("updated_at")).alias("hour_bucket"), "agency_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(agencies.select("agency_key", "agency"), "agency_key").select("hour_bucket", "agency", "n")


@dataclasses.dataclass
class Warehouse:
    """All models over one bronze table, built lazily; tables that several models read can be replaced by written ones."""

    bronze: DataFrame
    config: Config

    @cached_property
    def staged(self) -> DataFrame:
        return staging(self.bronze, self.config)

    @cached_property
    def resolution(self) -> DataFrame:
        return resolution(self.staged, self.config)

    @cached_property
    def geography(self) -> DataFrame:
        return geography(self.staged)

    @cached_property
    def agencies(self) -> DataFrame:
        return dim_agency(self.staged)

    @cached_property
    def types(self) -> DataFrame:
        return dim_complaint_type(self.staged)

    @cached_property
    def locations(self) -> DataFrame:
        return dim_location(self.geography)

    @cached_property
    def dates(self) -> DataFrame:
        return dim_date(self.bronze.sparkSession, self.config)

    @cached_property
    def fact(self) -> DataFrame:
        return fact(self.staged, self.agencies, self.types, self.locations, self.config)

    @cached_property
    def described(self) -> DataFrame:
        """The fact with its agency, complaint type and descriptor."""
        return self.fact.join(self.agencies.select("agency_key", "agency", "agency_name"), "agency_key").join(self.types, "complaint_type_key")

    @cached_property
    def cells(self) -> DataFrame:
        return monthly_cells(self.fact, self.agencies, self.types, self.config)

    @cached_property
    def touches(self) -> DataFrame:
        return hourly_touches(self.fact, self.agencies)

    def materialise(self, folder: str) -> Warehouse:
        """Write the tables below a folder, and read them from there on; refuses a folder in use."""
        spark = self.bronze.sparkSession
        for name in ("fact", "cells", "touches"):  # these are to be made of written tables
            self.__dict__.pop(name, None)
        for name in TABLES:
            table = getattr(self, name)
            table.write.mode("errorifexists").parquet(f"{folder}/{name}")
            self.__dict__[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
        self.__dict__.pop("described", None)
        return self

    def use_tables(self, other: Warehouse) -> None:
        """Read the tables that another warehouse over the same rows has written."""
        self.__dict__.update({name: other.__dict__[name] for name in TABLES})
