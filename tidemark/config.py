"""Parameters of the models.  Nothing in a plan reads the clock: the moment of a run is one of these."""

from __future__ import annotations

import dataclasses
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Config:
    as_of: dt.datetime  # naive, in the zone below
    timezone: str = "America/New_York"
    settlement_days: int = 45
    recent_days: int | None = None  # development slice: only so many days before the newest row
    calendar_start: dt.date = dt.date(2024, 8, 19)
    calendar_end: dt.date = dt.date(2027, 12, 31)

    # detectors
    rate_sigmas: float = 5.0
    rate_excluded_agencies: tuple[str, ...] = ("DHS",)
    drift_types: int = 15
    drift_points: float = 5.0
    completeness_days: int = 45
    completeness_first: dt.date = dt.date(2025, 12, 27)
    completeness_excluded: tuple[dt.date, ...] = (dt.date(2026, 1, 1),)
    completeness_age_days: int = 90
    completeness_fail: float = 85.0
    completeness_warn: float = 90.0
    touch_agencies: int = 13
    touch_sigmas: float = 3.0
    touch_ordinary_below: int = 100_000

    # distribution checks
    volume_band: tuple[float, float] = (4000, 28000)
    missing_band: tuple[float, float] = (0.5, 7.0)
    median_band: tuple[float, float] = (2, 35)
    p90_band: tuple[float, float] = (250, 600)
    closure_band: tuple[float, float] = (90, 99.9)
    shift_points: float = 15.0
    shift_types: int = 10

    history_days: int = 180

    @property
    def today(self) -> dt.date:
        return self.as_of.date()

    def instant(self, day: dt.date, days: int = 0) -> dt.datetime:
        """Local midnight of a day, shifted by days, as an aware UTC time."""
        naive = dt.datetime.combine(day + dt.timedelta(days=days), dt.time())
        return naive.replace(tzinfo=ZoneInfo(self.timezone)).astimezone(dt.UTC)

    def midnight(self, days: int = 0) -> Column:
        """Local midnight of today, shifted by days, as an instant."""
        return F.lit(f"{self.instant(self.today, days):%Y-%m-%d %H:%M:%S}+00:00").cast("timestamp")

    @property
    def run_timestamp(self) -> dt.datetime:
        return self.as_of.replace(tzinfo=ZoneInfo(self.timezone)).astimezone(dt.UTC).replace(tzinfo=None)
