"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: ASCII white space, the set of the contracts: [\x20\x09-\x0D].
SPACE = "[ \\t\\n\\x0B\\f\\r]+"

#: How staged tables are written.  In a local folder Hadoop starts a process (chmod) for each file and folder it makes;
#: until that process runs its program it shares, and counts as, all memory of the executor or driver.  The raw file
#: system makes no file of sums beside each file; the sums that Parquet keeps of its pages are verified instead.
FEW_PROCESSES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}
VERIFIED = {"parquet.page.verify-checksum.enabled": "true"}

#: Rows of a staged table in one file, where the number of rows is known.
ROWS_A_FILE = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir.

    Where none is set, a session on one machine gets a temporary folder; on a cluster that is an error, as executors
    would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named


def staged(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: an executor that is lost later costs no recomputation above this point.  The files go
    when the driver's JVM ends, or earlier by `dropped`.  rows: a bound on the number of rows, if one is known; the
    result is then dealt anew, in proportion to it, by an exchange of its own, so that a small result of many tasks
    makes few files while those tasks stay as many as they are.
    """
    if rows is not None:
        df = df.repartition(rows // ROWS_A_FILE + 1)
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"
    _local_folders(spark, path)
    df.write.options(**FEW_PROCESSES).mode("append").parquet(path)
    _file_system(spark, path).deleteOnExit(_hadoop_path(spark, path))
    out = spark.read.options(**VERIFIED).schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read any more."""
    for table in tables:
        path = getattr(table, "_tidemark_path", None)
        if path:
            _file_system(table.sparkSession, path).delete(_hadoop_path(table.sparkSession, path), True)


def _local_folders(spark: SparkSession, path: str) -> None:
    """Make a local folder, and those in which a job keeps what is not yet committed, without a process for each."""
    if _file_system(spark, path).getScheme() == "file":
        spark.sparkContext._jvm.java.io.File(_hadoop_path(spark, f"{path}/_temporary/0/_temporary").toUri().getPath()).mkdirs()


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, each: Callable[[], Callable[[pa.RecordBatch], dict]], schema: T.StructType | str, rows: int = 1024) -> DataFrame:
    """mapInArrow over slices of at most `rows` rows, so that memory follows the texts of one slice.

    `each` runs once a task and gives the function from a slice to columns (name -> list or array).  Arrow keeps
    nullable integers whole, which pandas does not.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    wanted = to_arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = each()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = work(batch.slice(at, rows))
                arrays = [x if isinstance(x, pa.Array) and x.type == f.type else pa.array(x, type=f.type) if not isinstance(x, pa.Array) else x.cast(f.type) for f in wanted for x in [out[f.name]]]
                yield pa.RecordBatch.from_arrays(arrays, schema=wanted)

    return df.mapInArrow(run, schema)
