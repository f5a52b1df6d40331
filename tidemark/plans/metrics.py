"""The metric layer: measures with their conditions inside, ratios, and queries by dimension and time grain."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.time import hours_crossed, local, trunc_naive
from .models import Warehouse


@dataclasses.dataclass(frozen=True)
class Metric:
    """An aggregate over the fact (SQL over its columns), or the ratio of two metrics.

    Conditions are part of the aggregate's input, so no grouping or filter of a query can drop them.
    """

    name: str
    aggregate: Column | None = None
    parts: tuple[str, str] | None = None


def _registry() -> dict[str, Metric]:
    count = lambda condition: F.count(F.when(condition, F.col("unique_key")))
    closed, settled, undated = F.col("is_closed"), F.col("is_settled"), F.col("is_undated_closure")
    hours = F.when(settled & closed & ~undated, F.col("resolution_hours"))
    made = [
        Metric("request_count", F.count("unique_key")),
        Metric("closed_count", count(closed)),
        Metric("settled_count", count(settled)),
        Metric("closed_and_settled_count", count(closed & settled)),
        Metric("settled_count_excl_backlog", count(settled & ~undated)),
        Metric("censored_count", count(F.col("is_censored"))),
        Metric("median_resolution_hours", F.median(hours)),
        Metric("p90_resolution_hours", F.percentile(hours, F.lit(0.9))),
        Metric("naive_median_resolution_hours", F.median(hours_crossed(F.col("created_date"), F.col("closed_date")))),
        Metric("closure_rate", parts=("closed_count", "request_count")),
        Metric("settlement_rate", parts=("settled_count", "request_count")),
        Metric("naive_closure_rate", parts=("closed_and_settled_count", "settled_count")),
        Metric("closure_rate_excl_backlog", parts=("closed_and_settled_count", "settled_count_excl_backlog")),
    ]
    return {m.name: m for m in made}


#: Names of all metrics.
METRICS = (
    "request_count", "closed_count", "settled_count", "closed_and_settled_count", "settled_count_excl_backlog", "censored_count", "median_resolution_hours",
    "p90_resolution_hours", "naive_median_resolution_hours", "closure_rate", "settlement_rate", "naive_closure_rate", "closure_rate_excl_backlog",
)

#: Dimension -> (the key that leads to it, its column there); each can be reached by one path.
DIMENSIONS = {
    "agency": ("agency_key", "agency"), "agency_name": ("agency_key", "agency_name"),
    "complaint_type": ("complaint_type_key", "complaint_type"), "descriptor": ("complaint_type_key", "descriptor"),
    "community_board": ("location_key", "community_board"), "borough": ("location_key", "borough"),
    "calendar_year": ("date_key", "year"), "calendar_quarter": ("date_key", "quarter"), "month_name": ("date_key", "month_name"), "day_name": ("date_key", "day_name"),
    "is_weekend": ("date_key", "is_weekend"), "season": ("date_key", "season"),
}
FACT_DIMENSIONS = ("status", "is_closed", "is_settled", "is_censored", "is_undated_closure")
GRAINS = ("day", "week", "month", "quarter", "year")


def metric_query(house: Warehouse, metrics: Sequence[str], group_by: Sequence[str] = (), where: str | Column | None = None) -> DataFrame:
    """Metrics by dimensions, by flags of the fact, or by metric_time__<grain>.

    Only the dimensions that are named are joined, on their keys and before a single aggregation for all metrics.
    """
    registry = _registry()
    unknown = [m for m in metrics if m not in registry] + [g for g in group_by if not (g in DIMENSIONS or g in FACT_DIMENSIONS or g.removeprefix("metric_time__") in GRAINS)]
    if unknown:
        raise ValueError(f"unknown metrics or dimensions: {', '.join(unknown)}")
    tables = {"agency_key": lambda: house.agencies, "complaint_type_key": lambda: house.types, "location_key": lambda: house.locations, "date_key": lambda: house.dates}
    rows = house.fact
    # a status or key of the fact that a dimension also names would be ambiguous: dimensions come in under aliases
    for key in dict.fromkeys(DIMENSIONS[g][0] for g in group_by if g in DIMENSIONS):
        wanted = {g: DIMENSIONS[g][1] for g in group_by if g in DIMENSIONS and DIMENSIONS[g][0] == key}
        rows = rows.join(tables[key]().select(key, *[F.col(c).alias(f"by_{g}") for g, c in wanted.items()]), key, "left")

    def grouping(g: str) -> Column:
        if g in DIMENSIONS:
            return F.col(f"by_{g}").alias(g)
        if g in FACT_DIMENSIONS:
            return F.col(g)
        return trunc_naive(g.removeprefix("metric_time__"), local(F.col("created_date"), house.config.timezone)).alias(g)

    if where is not None:
        rows = rows.where(where)
    needed = dict.fromkeys(n for m in metrics for n in (registry[m].parts or (m,)))
    measured = rows.groupBy(*[grouping(g) for g in group_by]).agg(*[registry[n].aggregate.alias(f"m_{n}") for n in needed])
    out = [ratio(*(F.col(f"m_{p}") for p in registry[m].parts)) if registry[m].parts else F.col(f"m_{m}") for m in metrics]
    return measured.select(*group_by, *[c.alias(m) for m, c in zip(metrics, out, strict=True)])
