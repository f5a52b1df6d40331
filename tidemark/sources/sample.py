"""Service requests made of the order tables, so that every model has input at any scale.

Orders are requests: the customer's nation is the agency, its region the borough, the priority the complaint type, the
market segment the descriptor (with new members from 1997 on), and the first shipment the closure.  Times of day, coordinates and touch times follow
from the order key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from .schema import BRONZE

#: The moment at which the sample is looked at, and thresholds that its years can meet.
SAMPLE = Config(
    as_of=dt.datetime(2001, 8, 2),
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2001, 12, 31),
    rate_excluded_agencies=("CHINA",),
    completeness_first=dt.date(1995, 2, 1),
    completeness_excluded=(dt.date(1996, 1, 1),),
)


#: The tables that the sample is made of.
SOURCES = ("orders", "lineitem", "customer", "nation", "region")


def sample_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The bronze table: 50 columns, one row per order."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    shipped = read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = read("orders").join(people, F.col("o_custkey") == F.col("c_custkey"), "left").join(shipped, "o_orderkey", "left")
    key = F.col("o_orderkey")

    def coordinate(base: float, steps: int) -> Column:
        step = (key % steps).cast("double") / F.lit(1000.0)
        return F.when(key % 17 == 0, F.lit(None).cast("double")).when(key % 19 == 0, F.lit(0.0)).otherwise(F.lit(base) + step)

    nightly = F.date_trunc("month", "o_orderdate") + F.expr("interval 1 month") + F.expr("interval 93 minutes")
    own = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval((key % 60).cast("int"), F.lit(5))
    given = {
        "unique_key": key.cast("string"),
        "created_date": (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (key % 1440).cast("int"))).cast("timestamp_ntz"),
        "closed_date": (F.col("shipped") + F.make_dt_interval(F.lit(0), (key % 13).cast("int"))).cast("timestamp_ntz"),
        "agency": F.col("n_name"),
        "agency_name": F.concat(F.lit("Department of "), F.col("n_name")),
        "complaint_type": F.concat(F.lit(" "), F.lower("o_orderpriority")),
        "descriptor": F.when(key % 50 != 0, F.concat("c_mktsegment", F.when((key % 97 == 0) & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")), " NEW").otherwise(""))),
        "incident_zip": F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0"),
        "status": F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Open").otherwise("In Progress"),
        "community_board": F.concat_ws(" ", F.lpad((F.col("n_nationkey") % 12).cast("string"), 2, "0"), F.col("r_name")),
        "borough": F.concat(F.col("r_name"), F.lit(" ")),
        "latitude": coordinate(40.45, 500),
        "longitude": coordinate(-74.28, 600),
        "updated_at": F.when(key % 3 == 0, nightly).otherwise(own).cast("timestamp"),
    }
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE])
