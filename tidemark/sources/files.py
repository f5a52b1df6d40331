"""Small files through Hadoop's file systems, so that state can live wherever the tables do; and CSV scans."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """Text files below a folder.  A write is a new file that is renamed: readers see the old or the new text."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._path(name)))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = True) -> None:
        """Without replace, a name that exists raises: the first of two writers wins."""
        if not replace and self.exists(name):
            raise FileExistsError(f"{self.folder}/{name}")
        target, temporary = self._path(name), self._path(f".{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(target.getParent())
        stream = self._fs.create(temporary, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(temporary, target, replace)

    def move(self, source: JavaObject, target: JavaObject, replace: bool = True) -> None:
        """Rename a file; with replace, in one step where the file system can."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE if replace else option.NONE
        context.rename(self._fs.makeQualified(source), self._fs.makeQualified(target), options)

    def read_json(self, name: str, default: object = None) -> object:
        text = self.read(name)
        return default if text is None else json.loads(text)

    def write_json(self, name: str, value: object, replace: bool = True) -> None:
        self.write(name, json.dumps(value, indent=1, default=str), replace)

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def stamps(self, name: str) -> tuple[tuple[str, int, int], ...]:
        """Name, length and time of change of a file, or of each file in a folder."""
        return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self._path(name))))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns as text."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def coerced(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns to a fixed shape: empty or unreadable values of other types are null."""
    make = lambda c, t: F.col(c) if t == "string" else F.nullif(F.col(c).cast("string"), F.lit("")).try_cast(t)
    return rows.select(*[make(c, t).alias(c) for c, t in types.items()])


def write_csv_file(rows: DataFrame, folder: str, name: str) -> None:
    """One CSV file with a header, in the order of the rows, replaced in one step.  For tables that fit one file."""
    store = Store(rows.sparkSession, folder)
    scratch = f".{name}-{uuid.uuid4().hex}"
    try:
        rows.coalesce(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{folder}/{scratch}")
        part = next(n for n in store.names(scratch) if n.startswith("part-"))
        store.move(store._path(f"{scratch}/{part}"), store._path(name))
    finally:
        store.delete(scratch)
