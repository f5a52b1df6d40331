import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numbers import percent, plain_text, ratio, rounded
from tidemark.functions.time import anchor, anchor_column, days_crossed, hours_crossed, localize, month_windows, naive_utc, trunc_naive
from tidemark.plans import contracts, models
from tidemark.sources.schema import BRONZE, decode_json, source_projection

TZ = "America/New_York"
AS_OF = dt.datetime(2026, 3, 20)
CONFIG = Config(as_of=AS_OF)


def bronze(spark, *rows):
    """Bronze rows from dictionaries of the columns that matter."""
    kinds = {f.name: f.dataType for f in BRONZE}
    given = spark.createDataFrame([tuple(r.get(c) for c in kinds) for r in rows], ", ".join(f"{c} {t.simpleString()}" for c, t in kinds.items()))
    return given


def resolved(spark, created, closed, status):
    row = {"unique_key": "1", "created_date": created, "closed_date": closed, "status": status, "agency": "A"}
    return models.resolution(models.staging(bronze(spark, row), CONFIG), CONFIG).first()


DAY = dt.timedelta(days=1)
MIDNIGHT = dt.datetime(2026, 3, 20)


@pytest.mark.parametrize(
    ("created", "closed", "status", "wanted"),
    [
        (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 3), "Closed", (True, True, False, 48)),
        (dt.datetime(2026, 1, 3), dt.datetime(2026, 1, 1), "Closed", (True, True, False, -48)),
        (dt.datetime(2020, 1, 1), None, "Open", (False, True, True, None)),
        (MIDNIGHT - DAY, MIDNIGHT, "Closed", (True, False, True, None)),
        (MIDNIGHT - 45 * DAY, None, "Open", (False, True, True, None)),
        (MIDNIGHT - 44 * DAY, None, "Open", (False, False, True, None)),
        (MIDNIGHT - 46 * DAY, None, "Open", (False, True, True, None)),
        (MIDNIGHT - 45 * DAY + dt.timedelta(hours=12), None, "Open", (False, False, True, None)),
    ],
)
def test_resolution(spark, created, closed, status, wanted):
    r = resolved(spark, created, closed, status)
    assert (r.is_closed, r.is_settled, r.is_censored, r.resolution_hours) == wanted


def test_undated_closure_and_null_status(spark):
    r = resolved(spark, dt.datetime(2026, 1, 1), None, "Closed")
    assert r.is_undated_closure and not r.is_closed and r.is_censored and r.resolution_hours is None
    r = resolved(spark, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2), None)
    assert r.is_closed is None and r.is_undated_closure is False


def test_localize_at_the_clock_changes(spark):
    cases = {"2026-08-21 23:59:59": "2026-08-22 03:59:59", "2026-11-01 01:30:00": "2026-11-01 06:30:00", "2026-03-08 02:30:00": "2026-03-08 07:30:00", "2026-11-01 00:30:00": "2026-11-01 04:30:00", "2026-11-01 02:30:00": "2026-11-01 07:30:00"}
    rows = spark.createDataFrame(list(cases), "string").select(F.col("value"), naive_utc(localize(F.to_timestamp_ntz("value"), TZ)).cast("string").alias("utc")).collect()
    assert {r[0]: r[1] for r in rows} == cases


def test_boundary_counts(spark):
    def one(a, b):
        df = spark.createDataFrame([(a, b)], "a string, b string").select(F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
        return tuple(df.select(hours_crossed(F.col("a"), F.col("b")), days_crossed(F.col("a"), F.col("b"), TZ)).first())

    assert one("2026-01-01 10:59:00", "2026-01-01 11:01:00") == (1, 0)
    assert one("2026-01-01 11:01:00", "2026-01-01 10:59:00") == (-1, 0)
    assert one("2026-01-02 04:59:00", "2026-01-02 05:00:00") == (1, 1)  # midnight in New York
    assert one("1969-12-31 23:30:00", "1970-01-01 00:30:00") == (1, 0)


def test_numbers(spark):
    row = spark.range(1).select(
        rounded(F.lit(1.005), 2), ratio(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(4)), plain_text(F.lit(0.000448)), plain_text(F.lit(123456789.125)), plain_text(F.lit(3.0))
    ).first()
    assert tuple(row) == (1.0, None, 25.0, "0.000448", "123456789.125", "3.0")


def test_windows_and_anchor(spark):
    got = list(month_windows(dt.datetime(2024, 8, 19), dt.datetime(2024, 10, 2, 5)))
    assert [w[0] for w in got] == ["2024-08", "2024-09", "2024-10"]
    assert got[0][1] == dt.datetime(2024, 8, 19) and got[-1][2] == dt.datetime(2024, 10, 2, 5)
    assert list(month_windows(dt.datetime(2024, 12, 1), dt.datetime(2025, 1, 1))) == [("2024-12", dt.datetime(2024, 12, 1), dt.datetime(2025, 1, 1))]
    for moment, wanted in ((dt.datetime(2026, 1, 2, 2, 59), dt.datetime(2026, 1, 1, 3)), (dt.datetime(2026, 1, 2, 3), dt.datetime(2026, 1, 2, 3))):
        assert anchor(moment) == wanted
        df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
        assert df.select(anchor_column(F.col("t"))).first()[0] == wanted
    assert dict(spark.createDataFrame([(dt.datetime(2026, 1, 2),)], "t timestamp_ntz").select(trunc_naive("month", F.col("t")).alias("m")).dtypes) == {"m": "timestamp_ntz"}


def test_staging_shape(spark):
    row = {"unique_key": "1", "complaint_type": " noise ", "descriptor": "", "status": " Open ", "borough": " bronx", "city": "new york ", "latitude": 0.0, "longitude": 0.0}
    r = models.staging(bronze(spark, row, {"unique_key": "2", "latitude": 40.7, "longitude": -74.0}), CONFIG).orderBy("unique_key").collect()
    assert (r[0].complaint_type, r[0].descriptor, r[0].status, r[0].borough, r[0].city, r[0].has_valid_coordinates) == ("NOISE", "", "Open", "bronx", "NEW YORK", False)
    assert r[1].has_valid_coordinates is True
    assert len(contracts.STAGING) == 49 and len(BRONZE) == 50


def test_null_and_empty_descriptors(spark):
    base = {"complaint_type": "A", "created_date": dt.datetime(2026, 1, 1), "agency": "X", "agency_name": "x", "community_board": "01 B", "borough": "B", "status": "Open"}
    rows = [base | {"unique_key": "1", "descriptor": None}, base | {"unique_key": "2", "descriptor": "D"}, base | {"unique_key": "3", "borough": "C"}, base | {"unique_key": "4", "borough": None, "descriptor": "D"}]
    house = models.Warehouse(bronze(spark, *rows), CONFIG)
    assert [(r.complaint_type_key, r.descriptor) for r in house.types.orderBy("complaint_type_key").collect()] == [(1, None), (2, "D")]
    assert [tuple(r) for r in house.locations.orderBy("location_key").collect()] == [(1, "01 B", "B"), (2, "01 B", "C"), (3, "01 B", None)]
    fact = {r.unique_key: r for r in house.fact.collect()}
    assert len(fact) == 4  # one board in two boroughs does not fan out
    assert fact["1"].complaint_type_key == 1 and fact["4"].location_key is None


def test_contract_is_enforced(spark):
    with pytest.raises(contracts.ContractError):
        contracts.enforce(spark.range(1), "dim_agency")


def test_decode(spark):
    text = '{"unique_key": "7", "created_date": "2026-01-02T03:04:05.000", ":updated_at": "2026-01-03T00:00:00.000Z", "latitude": "40.7", "longitude": "", "location": {"coordinates": [-74.0, 40.7]}, "status": "Open"}'
    r = decode_json(spark.createDataFrame([(text,)], "json string")).first()
    assert (r.unique_key, r.created_date, r.latitude, r.longitude, r.location_lon, r.location_lat) == ("7", dt.datetime(2026, 1, 2, 3, 4, 5), 40.7, None, -74.0, 40.7)
    assert r.closed_date is None and ":updated_at" in source_projection() and source_projection().count("location") == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        decode_json(spark.createDataFrame([('{"unique_key": "1", "latitude": "x"}',)], "json string")).collect()
