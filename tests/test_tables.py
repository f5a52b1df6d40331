import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import append_snapshot
from tidemark.operators.table import VersionedTable, copy_table
from tidemark.operators.upsert import scoped_upsert
from tidemark.plans.scorecard import COLUMNS, acknowledgments
from tidemark.sources.files import Store, coerced, read_csv_text

SCHEMA = "id long, value string, event_ts timestamp_ntz"
DAY1, DAY2, DAY3 = dt.datetime(2026, 8, 1, 9), dt.datetime(2026, 8, 2, 9), dt.datetime(2026, 8, 3, 9)


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, "event_ts")
    made.append(spark.createDataFrame([(1, "a", DAY1), (2, "b", DAY1), (3, "c", DAY1)], SCHEMA))
    made.append(spark.createDataFrame([(4, "d", DAY2), (5, "e", DAY2)], SCHEMA))
    return made


def rows(df):
    return sorted((r.id, r.value) for r in df.collect())


def test_upsert_and_time_travel(spark, table):
    assert table.versions() == [0, 1, 2]
    assert scoped_upsert(table, spark.createDataFrame([(3, "c-UPDATED", DAY1)], SCHEMA), ["id"]) == {"rows_updated": 1, "rows_inserted": 0, "rows_no_op": 0}
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "c-UPDATED"), (4, "d"), (5, "e")]
    assert rows(table.read(1)) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(table.read(0)) == []


def test_equal_rows_write_nothing(spark, table):
    before = table.manifest()
    assert scoped_upsert(table, spark.createDataFrame([(1, "a", DAY1), (4, "d", DAY2)], SCHEMA), ["id"])["rows_no_op"] == 2
    assert table.manifest() == before


def test_only_changed_days_are_rewritten(spark, table):
    table.append(spark.createDataFrame([(6, "f", DAY3)], SCHEMA))
    before = table.manifest()["days"]
    done = scoped_upsert(table, spark.createDataFrame([(1, "A", DAY1), (6, "f", DAY3)], SCHEMA), ["id"])
    after = table.manifest()["days"]
    assert done == {"rows_updated": 1, "rows_inserted": 0, "rows_no_op": 1}
    assert before["2026-08-01"] != after["2026-08-01"] and all(before[d] == after[d] for d in ("2026-08-02", "2026-08-03"))


def test_repeated_new_keys_nulls_and_undated_rows(spark, table):
    batch = spark.createDataFrame([(7, "x", DAY2), (7, "y", DAY2), (8, None, None), (9, "z", DAY3)], SCHEMA)
    assert scoped_upsert(table, batch, ["id"])["rows_inserted"] == 3
    assert scoped_upsert(table, batch, ["id"])["rows_no_op"] == 3
    assert dict(rows(table.read()))[7] == "y"
    undated = spark.createDataFrame([(8, "now", None)], SCHEMA)
    assert scoped_upsert(table, undated, ["id"])["rows_updated"] == 1
    assert dict(rows(table.read()))[8] == "now" and table.read().count() == 8


def test_overwrite_delete_expire_copy(spark, table, tmp_path):
    table.overwrite_where(F.col("id") == 2, spark.createDataFrame([(2, "B", DAY3)], SCHEMA))
    assert dict(rows(table.read()))[2] == "B"
    table.delete_where(F.col("id") > 3)
    assert [r[0] for r in rows(table.read())] == [1, 2, 3]
    other = copy_table(table, spark, str(tmp_path / "copy"))
    assert rows(other.read()) == rows(table.read())
    with pytest.raises(FileExistsError):
        copy_table(table, spark, str(tmp_path / "copy"))
    table.expire(1)
    assert len(table.versions()) == 1 and [r[0] for r in rows(table.read())] == [1, 2, 3]


def test_a_stale_writer_fails(spark, table):
    with pytest.raises(RuntimeError):
        table.commit(append=spark.createDataFrame([(1, "q", DAY1)], SCHEMA), base=0)


def card(spark, day, *checks):
    rows_ = [(c, "unit", "g", 1.5 if c == "a" else None, None, "pass", None, day, dt.datetime.combine(day, dt.time(4))) for c in checks]
    return spark.createDataFrame(rows_, ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))


def test_history(spark, tmp_path):
    folder, name = str(tmp_path), "scorecard_history.csv"
    first = dt.date(2026, 1, 1)
    assert append_snapshot(spark, card(spark, first, "a", "b"), folder)["rows"] == 2
    once = (tmp_path / name).read_bytes()
    assert append_snapshot(spark, card(spark, first, "a", "b"), folder)["rows_replaced"] == 2
    assert (tmp_path / name).read_bytes() == once
    assert append_snapshot(spark, card(spark, first + dt.timedelta(days=1), "a"), folder)["run_dates"] == 2
    done = append_snapshot(spark, card(spark, first + dt.timedelta(days=237), "a"), folder)
    assert (done["rows"], done["rows_expired"]) == (1, 3)
    kept = coerced(read_csv_text(spark, f"{folder}/{name}"), COLUMNS).first()
    assert (kept.measured_value, kept.threshold_description, kept.run_date) == (1.5, None, first + dt.timedelta(days=237))
    for bad in (card(spark, first), card(spark, first, "a").union(card(spark, first + dt.timedelta(days=1), "a"))):
        with pytest.raises(ValueError, match="snapshot"):
            append_snapshot(spark, bad, folder)


def test_store_and_seed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_json("a.json", {"x": 1})
    store.write_json("a.json", {"x": 2})
    assert store.read_json("a.json") == {"x": 2} and store.read_json("none.json", 5) == 5
    with pytest.raises(FileExistsError):
        store.write("a.json", "", replace=False)
    (tmp_path / "seed.csv").write_text('check_name,grain,acknowledged_date,acknowledged_by,reason\nc,DHS,2026-08-22,me,"a, b"\n')
    r = acknowledgments(spark, str(tmp_path / "seed.csv")).first()
    assert (r.grain, r.acknowledged_date, r.reason) == ("DHS", dt.date(2026, 8, 22), "a, b")
