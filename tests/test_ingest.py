import datetime as dt
import json
import re
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from tidemark.sources.files import Store
from tidemark.sources.rest import Client
from tidemark.streaming import state as st
from tidemark.streaming.ingest import Loader, guard_full_refresh, run_for_scheduler
from tidemark.streaming.upsert_stream import stream_upserts
from tidemark.operators.table import VersionedTable
from tidemark.sources.schema import BRONZE


class Source:
    """A REST source on this machine: rows, a filter of the kind the loader sends, offset paging, failures on demand."""

    def __init__(self):
        self.rows, self.failures, self.requests = [], 0, 0
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                outer.requests += 1
                if outer.failures > 0:
                    outer.failures -= 1
                    self.send_response(503)
                    self.end_headers()
                    return
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                found = [r for r in outer.rows if all(outer.holds(r, *m) for m in re.findall(r"(\S+) (>=|<) '([^']*)'", q.get("$where", "")))]
                if q["$select"].startswith("count("):
                    found = [{"count": str(len(found))}]
                elif "$group" in q:
                    found = [{q["$group"]: k, "count": str(sum(r.get(q["$group"]) == k for r in found))} for k in sorted({r.get(q["$group"]) for r in found})]
                else:
                    found.sort(key=lambda r: [r[c] for c in q["$order"].split(",")])
                    found = found[int(q["$offset"]) : int(q["$offset"]) + int(q["$limit"])]
                self.send_response(200)
                self.end_headers()
                self.wfile.write(json.dumps(found).encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/rows"

    @staticmethod
    def holds(row, column, sign, value):
        return row[column] >= value.rstrip("Z") if sign == ">=" else row[column] < value.rstrip("Z")

    def add(self, key, created, touched, status="Open"):
        self.rows = [r for r in self.rows if r["unique_key"] != key]
        self.rows.append({"unique_key": key, "created_date": created, ":updated_at": touched, "status": status})


@pytest.fixture
def source():
    made = Source()
    yield made
    made.server.shutdown()


class Clock:
    def __init__(self, *moment):
        self.moment = dt.datetime(*moment, tzinfo=dt.UTC)

    def __call__(self):
        self.moment += dt.timedelta(seconds=1)
        return self.moment


@pytest.fixture
def loader(spark, source, tmp_path):
    for k in range(7):
        source.add(f"{k}", f"2024-0{8 + k % 2}-2{k % 3}T10:00:00.000", "2024-10-01T01:33:00.000")
    client = Client(source.url, pause=lambda _: None)
    return Loader(spark, client, str(tmp_path / "lake"), start=dt.datetime(2024, 8, 19), page_size=2, now=Clock(2024, 10, 2, 12))


def test_client_retries_and_pages(source):
    for k in range(5):
        source.add(f"{k}", "2024-09-01T00:00:00.000", "2024-09-01T00:00:00.000")
    waits = []
    client = Client(source.url, pause=waits.append)
    source.failures = 2
    assert client.count("created_date >= '2024'") == 5
    assert waits == [1.0, 2.0]
    assert [len(p) for p in client.pages("created_date >= '2024'", "created_date,unique_key", "*", 2)] == [2, 2, 1]
    assert list(client.pages("created_date >= '2025'", "created_date,unique_key", "*", 2)) == []
    assert client.grouped_count("status") == [{"status": "Open", "count": "5"}]
    source.failures = 99
    with pytest.raises(RuntimeError, match="failed 5 times"):
        client.count("")


def test_backfill_and_incremental(source, loader):
    assert loader.backfill() == 7
    assert loader.table.read().count() == 7
    windows = loader.state.windows()
    assert sorted(windows) == ["2024-08", "2024-09", "2024-10"] and all(w["count_matched"] for w in windows.values())
    asked = source.requests
    assert loader.backfill() == 0 and source.requests == asked  # completed windows are not fetched again
    first_start = min(dt.datetime.fromisoformat(w["started_at"]) for w in windows.values())
    assert loader.state.cursor() == st.naive_utc(first_start) - dt.timedelta(hours=48)

    loader.now = Clock(2024, 10, 3, 12)
    source.add("0", "2024-08-20T10:00:00.000", "2024-10-03T01:33:00.000", "Closed")
    source.add("9", "2024-10-02T10:00:00.000", "2024-10-03T01:33:00.000")
    source.add("old", "2020-01-01T00:00:00.000", "2024-10-03T01:33:00.000")  # touched, but out of scope
    done = loader.incremental()
    assert (done["rows_updated"], done["rows_inserted"], done["count_matched"], done["skipped"]) == (1, 1, True, False)
    assert loader.state.cursor() == dt.datetime(2024, 10, 3, 1, 33)
    assert done["staleness"]["consecutive_no_advance"] == 0

    quiet = loader.incremental()  # the cursor moved, so the window is new, but holds nothing newer; its lower end is inclusive
    assert quiet["rows_no_op"] == quiet["rows_fetched"] == 8 and quiet["alarm"] is None
    skipped = loader.incremental()
    assert skipped["skipped"] and skipped["staleness"]["consecutive_short_circuits"] == 1
    assert "found the window of the run before" in skipped["alarm"]


def test_a_killed_window_is_done_again(source, loader, monkeypatch):
    real = loader.load
    monkeypatch.setattr(loader, "load", lambda label, *a: (_ for _ in ()).throw(KeyboardInterrupt()) if label == "2024-09" else real(label, *a))
    with pytest.raises(KeyboardInterrupt):
        loader.backfill()
    assert loader.state.windows()["2024-09"]["status"] == "in_progress"
    monkeypatch.setattr(loader, "load", real)
    loader.backfill()
    assert loader.table.read().count() == 7


def test_scheduler_outcomes(loader):
    assert run_for_scheduler(loader) == (1, {"commit_state": False, "alarm": False})  # no cursor yet
    loader.backfill()
    assert run_for_scheduler(loader)[0] == 0
    assert guard_full_refresh(["--full-refresh"], {"CI": "true"}) == 2
    assert guard_full_refresh([], {"CI": "true", "FULL_REFRESH": "1"}) == 2
    assert guard_full_refresh(["--full-refresh"], {}) == 0


def test_staleness_and_latest():
    state = dict(st.NO_RUNS)
    state = st.after_run(state, False, False, "t1")
    state = st.after_run(state, False, True, "t2")
    assert (state["consecutive_no_advance"], state["consecutive_short_circuits"]) == (2, 1) and "1 of them" in st.alarm(state)
    assert st.alarm(st.after_run(state, True, False, "t3")) is None
    assert st.after_run({"consecutive_no_advance": 1}, False, True, "t")["consecutive_short_circuits"] == 1  # an older file
    windows = {
        "2024-08": {"status": "complete", "completed_at": "9"},
        "incremental_a": {"status": "complete", "completed_at": "1"},
        "incremental_b": {"status": "skipped_no_new_window", "skipped_at": "2"},
        "incremental_c": {"status": "in_progress", "started_at": "3"},
        "incremental_d": {"status": "abandoned", "abandoned_at": "4"},
    }
    assert st.latest_finished(windows)[0] == "incremental_b" and st.latest_finished({}) is None


def test_stream(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), VersionedTable.create(spark, str(tmp_path / "bronze"), BRONZE, "created_date")
    page = lambda *keys: spark.createDataFrame([("w", 0, json.dumps({"unique_key": k, "created_date": "2024-09-01T00:00:00.000"})) for k in keys], "label string, page int, json string")
    page("1", "2").write.parquet(raw)
    stream_upserts(spark, raw, table, str(tmp_path / "cp")).awaitTermination()
    page("2", "3").write.mode("append").parquet(raw)
    stream_upserts(spark, raw, table, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r[0] for r in table.read().select("unique_key").collect()) == ["1", "2", "3"]
    assert Store(spark, str(tmp_path)).exists("cp")
