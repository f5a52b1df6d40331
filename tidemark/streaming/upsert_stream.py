"""The upsert as a stream: pages that land in the raw folder go to the table, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.table import VersionedTable
from ..operators.upsert import scoped_upsert
from ..sources.schema import decode_json


def stream_upserts(spark: SparkSession, raw: str, table: VersionedTable, checkpoint: str, files_a_batch: int = 100) -> StreamingQuery:
    """Process all pages that have landed and stop; the next call goes on from there.

    A batch that is repeated after a crash changes nothing, as equal rows are no-ops.
    """
    pages = spark.readStream.schema("label string, page int, json string").option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", True).parquet(raw)

    def apply(batch: DataFrame, _: int) -> None:
        scoped_upsert(table, decode_json(batch), ["unique_key"], newest="updated_at")

    return pages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
