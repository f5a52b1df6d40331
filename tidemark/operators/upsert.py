"""Upsert by key, limited to the days that a batch can touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .table import NO_DAY, VersionedTable


def newest_by_key(batch: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """One row per key: the newest; equal ones go by all columns, so that a retry picks the same row."""
    order = ([F.col(newest).desc_nulls_last()] if newest else []) + [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys]
    ranked = batch.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_nth = 1").drop("_nth")


def changes(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows after an upsert, with `change`: kept, same, updated or inserted.  Values are compared null-safely."""
    others = [c for c in existing.columns if c not in keys]
    old = existing.select(*keys, F.struct(*others).alias("old"))
    new = batch.select(*keys, F.struct(*others).alias("new"))
    joined = old.join(new, list(keys), "full")
    change = F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "inserted").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("updated")
    return joined.select(*keys, *[F.when(F.col("new").isNull(), F.col(f"old.`{c}`")).otherwise(F.col(f"new.`{c}`")).alias(c) for c in others], change.alias("change"), F.col("old"))


def scoped_upsert(table: VersionedTable, batch: DataFrame, keys: Sequence[str], newest: str | None = None) -> dict[str, int]:
    """Insert new keys, replace rows that differ, leave equal ones alone; the incoming row wins.

    Only days between the first and the last of the batch are read, and only days with a changed row are rewritten;
    days that merely gain rows get a further file.  A batch of equal rows writes nothing.  A batch without any date
    is compared with the whole table.  Before the version is published, its rows are counted against those before
    plus those inserted.

    The day of a key must not change: a key whose row lies outside the batch's days is inserted a second time.
    """
    names, day_of = table.schema.names, table.manifest()["day_of"]
    version = table.manifest()["version"]
    batch = newest_by_key(batch.select(names), keys, newest).cache()
    try:
        first, last, undated = batch.agg(F.min(F.to_date(day_of)), F.max(F.to_date(day_of)), F.count_if(F.col(day_of).isNull())).first()
        if first is None:
            existing = table.read()
        else:
            existing = table.read(between=(first, last))
            if undated:
                existing = existing.unionByName(table.read(days=[NO_DAY]))
        judged = changes(existing, batch, keys).cache()
        try:
            old_day = F.to_date(F.col(f"old.`{day_of}`"))
            by_change = {r["change"]: r["n"] for r in judged.groupBy("change").agg(F.count(F.lit(1)).alias("n")).collect()}
            updated, inserted = by_change.get("updated", 0), by_change.get("inserted", 0)
            result = {"rows_updated": updated, "rows_inserted": inserted, "rows_no_op": by_change.get("same", 0)}
            if not updated and not inserted:
                return result
            changed = judged.where("change = 'updated'")
            days = {r[0] for r in changed.select(old_day).union(changed.select(F.to_date(day_of))).distinct().collect()}
            named = sorted(NO_DAY if d is None else d.isoformat() for d in days)
            today = F.to_date(day_of)
            dated = [d for d in days if d is not None]
            inside = F.when(today.isNull(), F.lit(None in days)).otherwise(today.isin(dated) if dated else F.lit(False))
            # an updated row may have left its day: the days it left and those it came to are both rewritten
            whole = judged.where(inside)
            before = table.read(days=named).count()
            moved = whole.agg(F.count_if(F.col("change") == "inserted")).first()[0]
            if whole.count() != before + moved:
                raise RuntimeError(f"upsert would leave {whole.count()} rows where {before} were and {moved} come in")
            added = judged.where((F.col("change") == "inserted") & ~inside)
            table.commit(replace=whole.select(names) if days else None, append=added.select(names) if inserted > moved else None, drop=named, base=version)
            return result
        finally:
            judged.unpersist()
    finally:
        batch.unpersist()
