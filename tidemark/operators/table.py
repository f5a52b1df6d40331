"""A table of day partitions with versions.

Data files never change.  A version is a small JSON manifest that names the folders of each day, and comes into being
by one rename, so a write is seen whole or not at all, and a crash leaves the last version.  Scans take the folders of
the days they need from the manifest: partition pruning without a directory listing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import Store

DAY = "_day"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), Store(spark, folder)

    @classmethod
    def create(cls, spark: SparkSession, folder: str, schema: T.StructType, day_of: str) -> VersionedTable:
        """Open the table, making it if there is none; day_of names the column whose date is the partition."""
        table = cls(spark, folder)
        if not table.exists():
            table.store.write_json("_versions/00000000.json", {"version": 0, "day_of": day_of, "schema": json.loads(schema.json()), "days": {}}, replace=False)
        return table

    def exists(self) -> bool:
        return bool(self.store.names("_versions"))

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.store.names("_versions") if not n.startswith(".")]

    def manifest(self, version: int | None = None) -> dict:
        version = self.versions()[-1] if version is None else version
        found = self.store.read_json(f"_versions/{version:08d}.json")
        if found is None:
            raise KeyError(f"{self.folder} has no version {version}")
        return found

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.manifest()["schema"])

    def day(self) -> Column:
        return F.to_date(F.col(self.manifest()["day_of"]))

    def read(self, version: int | None = None, days: Iterable[str] | None = None, between: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """The rows of a version, of all days or of some: by name, or from a first to a last one."""
        manifest = self.manifest(version)
        chosen = manifest["days"]
        if days is not None:
            wanted = set(days)
            chosen = {d: f for d, f in chosen.items() if d in wanted}
        if between is not None:
            low, high = (d.isoformat() for d in between)
            chosen = {d: f for d, f in chosen.items() if low <= d <= high}
        folders = [f"{self.folder}/{f}" for own in chosen.values() for f in own]
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """New data files: day -> folder."""
        name = f"data/{uuid.uuid4().hex}"
        # one task for each day's rows would meet a hot day; rebalancing splits it
        rows.withColumn(DAY, self.day()).hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{self.folder}/{name}")
        parts = [n for n in self.store.names(name) if n.startswith(f"{DAY}=")]
        return {n.split("=", 1)[1]: f"{name}/{n}" for n in parts}

    def commit(self, append: DataFrame | None = None, replace: DataFrame | None = None, drop: Iterable[str] = (), base: int | None = None) -> int:
        """A new version: days to drop go, days of `replace` take its rows, those of `append` gain its rows.

        A writer that started from an older version than the newest one fails.
        """
        last = self.manifest()
        if base is not None and base != last["version"]:
            raise RuntimeError(f"version {base} is not the newest one, {last['version']} is")
        days = {d: list(f) for d, f in last["days"].items()}
        for d in drop:
            days.pop(d, None)
        for d, folder in (self._write(replace) if replace is not None else {}).items():
            days[d] = [folder]
        for d, folder in (self._write(append) if append is not None else {}).items():
            days.setdefault(d, []).append(folder)
        version = last["version"] + 1
        self.store.write_json(f"_versions/{version:08d}.json", last | {"version": version, "days": days}, replace=False)
        return version

    def append(self, rows: DataFrame) -> int:
        return self.commit(append=rows.select(self.schema.names))

    def overwrite_where(self, condition: Column, rows: DataFrame) -> int:
        """Delete the rows that meet the condition and add others, in one version; only their days are rewritten."""
        version = self.manifest()["version"]
        touched = self._days(self.read().where(condition))
        kept = self.read(days=touched).where(~F.coalesce(condition, F.lit(False)))
        return self.commit(replace=kept, drop=touched, append=rows.select(self.schema.names), base=version)

    def delete_where(self, condition: Column) -> int:
        return self.overwrite_where(condition, self.spark.createDataFrame([], self.schema))

    def _days(self, rows: DataFrame) -> list[str]:
        """The partitions of some rows: as many as the calendar has days, at the most."""
        found = [r[0] for r in rows.select(self.day()).distinct().collect()]
        return [NO_DAY if d is None else d.isoformat() for d in found]

    def expire(self, keep: int) -> None:
        """Drop all but the newest versions, and the data that none of those uses."""
        versions = self.versions()
        used = {f.split("/")[1] for v in versions[-keep:] for own in self.manifest(v)["days"].values() for f in own}
        for v in versions[:-keep]:
            self.store.delete(f"_versions/{v:08d}.json")
        for name in self.store.names("data"):
            if name not in used:
                self.store.delete(f"data/{name}")


def copy_table(source: VersionedTable, spark: SparkSession, folder: str) -> VersionedTable:
    """A one-time copy into an empty place, in one partitioned write; refuses a table that exists."""
    if VersionedTable(spark, folder).exists():
        raise FileExistsError(f"{folder} holds a table already")
    target = VersionedTable.create(spark, folder, source.schema, source.manifest()["day_of"])
    target.append(source.read())
    return target
