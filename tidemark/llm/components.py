"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, staged


def connected_components(links: DataFrame, bound: int | None = None) -> DataFrame:
    """links (a, b) -> (id, component): the smallest id that can be reached, for every id that has a link.

    bound: a number that the links, counted both ways, do not exceed, if one is known.

    Smallest labels travel along links and are then shortened by following the label's own label, so that the number
    of rounds grows with the logarithm of the longest path.  Every round is written, and the round before is deleted;
    both sides of its joins are plain exchanges, so a vertex with many links is split by adaptive execution.

    Cases.  Links of a vertex with itself, links with a null end and repeated links add nothing; no links give no rows.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "components-links", bound)
    n = both.count()
    labels = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("component")), "components-labels", n)
    while True:
        near = both.join(labels.select("id", "component"), F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("low"))
        lower = staged(
            labels.select("id", "component").join(near, F.col("id") == F.col("a")).select("id", F.col("component").alias("old"), F.least("component", "low").alias("component")),
            "components-lower",
            n,
        )
        up = lower.select(F.col("id").alias("via"), F.col("component").alias("above"))
        jumped = staged(lower.join(up, F.col("component") == F.col("via")).select("id", "old", F.col("above").alias("component")), "components-labels", n)
        dropped(labels, lower)
        if jumped.where("old <> component").isEmpty():
            dropped(both)
            return jumped.select("id", "component")
        labels = jumped
