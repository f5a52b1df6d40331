"""A paginated REST source as a Spark data source: executors fetch windows, each page with retries."""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .schema import source_projection

#: A transport takes a URL and a time-out in seconds, and returns a status and a body.
Transport = Callable[[str, float], tuple[int, bytes]]


def http(url: str, timeout: float) -> tuple[int, bytes]:
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
        return answer.status, answer.read()


def _load(name: str) -> Transport:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class Client:
    """Requests with retries: after an error or a status other than 200, wait 1, 2, 4, ... seconds."""

    def __init__(self, url: str, transport: str | Transport = "tidemark.sources.rest:http", retries: int = 5, wait: float = 2.0, timeout: float = 60.0, pause: Callable[[float], None] = time.sleep) -> None:
        self.url, self.retries, self.wait, self.timeout, self.pause = url, retries, wait, timeout, pause
        self.transport = _load(transport) if isinstance(transport, str) else transport

    def get(self, **parameters: object) -> list[dict]:
        url, error = f"{self.url}?{urllib.parse.urlencode(parameters)}", None
        for attempt in range(self.retries):
            try:
                status, body = self.transport(url, self.timeout)
                if status == 200:
                    return json.loads(body)
                error = RuntimeError(f"status {status}")
            except Exception as e:  # noqa: BLE001  any failure of the transport is retried
                error = e
            if attempt + 1 < self.retries:
                self.pause(self.wait**attempt)
        raise RuntimeError(f"{url} failed {self.retries} times") from error

    def count(self, where: str) -> int:
        return int(next(iter(self.get(**{"$select": "count(*)", "$where": where})[0].values())))

    def grouped_count(self, column: str, where: str | None = None) -> list[dict]:
        """Counts by a column, or by an expression such as date_extract_hh(created_date), computed at the source."""
        return self.get(**{"$select": f"{column},count(*)", "$group": column} | ({"$where": where} if where else {}))

    def pages(self, where: str, order: str, select: str, size: int = 50_000) -> Iterator[list[dict]]:
        """Pages by offset, until one is empty or short.  The order must be total, or pages overlap."""
        offset = 0
        while True:
            page = self.get(**{"$select": select, "$where": where, "$order": order, "$limit": size, "$offset": offset})
            if page:
                yield page
            if len(page) < size:
                return
            offset += size


class Window(InputPartition):
    def __init__(self, label: str, where: str, order: str) -> None:
        self.label, self.where, self.order = label, where, order


class RestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Window]:
        return [Window(**w) for w in json.loads(self.options["windows"])]

    def read(self, partition: Window) -> Iterator[tuple[str, int, str]]:
        o = self.options
        client = Client(o["url"], o.get("transport", "tidemark.sources.rest:http"), int(o.get("retries", 5)), float(o.get("wait", 2.0)))
        pages = client.pages(partition.where, partition.order, o.get("select") or ",".join(source_projection()), int(o.get("pagesize", 50_000)))
        for number, page in enumerate(pages):
            for row in page:
                yield partition.label, number, json.dumps(row)


class RestSource(DataSource):
    """spark.read.format("service_requests"): url, windows (JSON), select, pagesize, retries, transport."""

    @classmethod
    def name(cls) -> str:
        return "service_requests"

    def schema(self) -> str:
        return "label string, page int, json string"

    def reader(self, schema: object) -> RestReader:
        return RestReader({k.lower(): v for k, v in self.options.items()})


def read_windows(spark: SparkSession, url: str, windows: list[dict[str, str]], **options: object) -> DataFrame:
    """One partition for each window (label, where, order)."""
    spark.dataSource.register(RestSource)
    reader = spark.read.format("service_requests").option("url", url).option("windows", json.dumps(windows))
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
