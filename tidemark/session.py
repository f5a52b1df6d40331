"""A session with the settings that the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepared(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "tidemark", **settings: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder where the cluster's executors can all write, below spark.checkpoint.dir.

    Where none is set, a session on one machine gets a temporary folder; on a cluster that is an error, as executors
    would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{named or tempfile.mkdtemp(prefix='tidemark-')}/tidemark/{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame) -> DataFrame:
    """The table, written once and read back: what many plans read is computed once."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
