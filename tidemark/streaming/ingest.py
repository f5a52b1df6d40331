"""Backfill by month windows and incremental loading by a high-water cursor.

The driver plans windows and keeps state; executors fetch and decode pages; the raw pages are landed as they came, and
the table is changed by the scoped upsert, which makes overlaps and repeated windows harmless.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import anchor, month_windows
from ..operators.table import VersionedTable
from ..operators.upsert import scoped_upsert
from ..sources.files import Store
from ..sources.rest import Client, read_windows
from ..sources.schema import BRONZE, decode_json
from . import state as st

log = logging.getLogger(__name__)

NOTHING = {"rows_fetched": 0, "rows_updated": 0, "rows_inserted": 0, "rows_no_op": 0, "newest": None}


@dataclasses.dataclass
class Loader:
    spark: SparkSession
    client: Client
    folder: str  # raw/, bronze/ and state/ lie below it
    transport: str = "tidemark.sources.rest:http"
    start: dt.datetime = dt.datetime(2024, 8, 19)
    buffer: dt.timedelta = dt.timedelta(hours=48)
    anchor_hour: int = 3
    alarm_after: int = 2
    page_size: int = 50_000
    now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC)

    def __post_init__(self) -> None:
        self.state = st.State(Store(self.spark, f"{self.folder}/state"))
        self.table = VersionedTable.create(self.spark, f"{self.folder}/bronze", BRONZE, "created_date")

    def land(self, pages: DataFrame) -> DataFrame:
        """Write source rows as they came, below raw/ingest_date=<day>/batch=<id>, and read that very batch back."""
        folder = f"{self.folder}/raw/ingest_date={self.now():%Y-%m-%d}/batch={uuid.uuid4().hex}"
        pages.write.parquet(folder)
        return self.spark.read.schema(pages.schema).parquet(folder)

    def load(self, label: str, where: str, order: str) -> dict:
        """Fetch a window, land it, decode it, upsert it."""
        window = {"label": label, "where": where, "order": order}
        pages = read_windows(self.spark, self.client.url, [window], transport=self.transport, pagesize=self.page_size, retries=self.client.retries)
        landed = self.land(pages)
        rows = decode_json(landed)
        fetched, newest = rows.agg(F.count(F.lit(1)), F.max("updated_at").cast("timestamp_ntz")).first()
        done = scoped_upsert(self.table, rows, ["unique_key"], newest="updated_at") if fetched else {}
        counted = {"rows_fetched": fetched, "rows_updated": done.get("rows_updated", 0), "rows_inserted": done.get("rows_inserted", 0), "newest": newest}
        return counted | {"rows_no_op": fetched - counted["rows_updated"] - counted["rows_inserted"]}

    def _complete(self, label: str, result: dict, expected: int) -> dict:
        matched = result["rows_fetched"] == expected
        if not matched:  # the window counts as loaded all the same; the result says so
            log.error("window %s: fetched %s rows, expected %s", label, result["rows_fetched"], expected)
        newest = result["newest"]
        self.state.put_window(
            label, status="complete", rows_fetched=result["rows_fetched"], expected_count=expected, count_matched=matched,
            watermark_high=newest.isoformat() if newest else None, completed_at=self.now().isoformat(),
        )
        return result | {"count_matched": matched}

    def backfill_window(self, label: str, start: dt.datetime, end: dt.datetime) -> dict:
        if self.state.is_complete(label):
            return dict(NOTHING)
        low, high = (t.isoformat(timespec="milliseconds") for t in (start, end))
        self.state.restart_window(label, start=low, end=high, status="in_progress", started_at=self.now().isoformat())
        where = f"created_date >= '{low}' and created_date < '{high}'"
        expected = self.client.count(where)
        return self._complete(label, self.load(label, where, "created_date,unique_key"), expected)

    def backfill(self, end: dt.datetime | None = None) -> int:
        """All months from the start on; completed ones are skipped.  Then the cursor is seeded."""
        end = end or st.naive_utc(self.now())
        total = sum(self.backfill_window(*window)["rows_fetched"] for window in month_windows(self.start, end))
        seed = st.seed_cursor(self.state.windows(), self.buffer)
        if seed:
            self.state.put_cursor(seed, self.now())
        return total

    def incremental(self) -> dict:
        """One run: rows touched from the cursor less the buffer up to the last boundary.

        The lower bound is inclusive, as many rows can share a stamp.  A window that the last finished run had is
        not queried again, but is recorded.
        """
        cursor = self.state.cursor()
        if cursor is None:
            raise RuntimeError("there is no cursor: run the backfill first")
        low, high = cursor - self.buffer, anchor(st.naive_utc(self.now()), self.anchor_hour)
        bounds = {"start": low.isoformat(), "end": high.isoformat()}
        label = f"incremental_{self.now():%Y%m%dT%H%M%S%f}"
        last = st.latest_finished(self.state.windows())
        if last and {k: last[1].get(k) for k in bounds} == bounds:
            reason = f"the window is that of {last[0]}: nothing has been published since"
            self.state.restart_window(label, **bounds, status="skipped_no_new_window", reason=reason, skipped_at=self.now().isoformat())
            return self._ended(dict(NOTHING) | {"skipped": True}, False, True)
        self.state.restart_window(label, **bounds, status="in_progress", started_at=self.now().isoformat())
        stamp = lambda t: t.isoformat(timespec="milliseconds")
        where = f":updated_at >= '{stamp(low)}Z' and :updated_at < '{stamp(high)}Z' and created_date >= '{stamp(self.start)}'"
        expected = self.client.count(where)
        result = self._complete(label, self.load(label, where, ":updated_at,unique_key"), expected)
        advanced = result["newest"] is not None and result["newest"] > cursor
        if advanced:
            self.state.put_cursor(result["newest"], self.now())
        return self._ended(result | {"skipped": False}, advanced, False)

    def _ended(self, result: dict, advanced: bool, skipped: bool) -> dict:
        staleness = self.state.record_run(advanced, skipped, self.now())
        message = st.alarm(staleness, self.alarm_after)
        if message:
            log.error(message)
        return result | {"staleness": staleness, "alarm": message}


def run_for_scheduler(loader: Loader) -> tuple[int, dict]:
    """Exit code and flags for a scheduled job: an exception is a failure whose state must not be kept; an alarm is a
    success with a flag."""
    try:
        result = loader.incremental()
    except Exception:
        log.exception("the run failed")
        return 1, {"commit_state": False, "alarm": False}
    return 0, {"commit_state": True, "alarm": bool(result["alarm"])}


def guard_full_refresh(arguments: list[str], environment: dict[str, str]) -> int:
    """2 if a full refresh is asked for on a scheduler, where it would throw history away; else 0."""
    asked = "--full-refresh" in arguments or environment.get("FULL_REFRESH", "").lower() in ("1", "true")
    return 2 if asked and environment.get("CI", "").lower() in ("1", "true") else 0
