"""What the corpus operators share: tables in the shared folder, small Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.operators.storage import fresh_path, ship_package

#: Most rows and bytes in an Arrow batch; texts may be long.
ROWS_PER_BATCH = 1024
BYTES_PER_BATCH = 4 << 20
#: Narrow rows that one file of an intermediate table may hold.
ROWS_PER_FILE = 200_000
#: Whether the shuffle files of a statement go when it ends, not when the driver next collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there.

    ``rows``, an upper bound of its rows if one is known, keeps small tables from
    being written as many tiny files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialise`` gave, when nothing lazy reads them any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def prepare_python(spark: SparkSession) -> None:
    """Make Python functions runnable: package on the executors, small Arrow batches.

    Lowers the session's batch limits to ROWS_PER_BATCH and BYTES_PER_BATCH if
    they are larger.
    """
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", ROWS_PER_BATCH), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        key = f"spark.sql.execution.arrow.{key}"
        told = spark.conf.get(key).rstrip("bB")
        if not told.isdigit() or not 0 < int(told) <= most:
            spark.conf.set(key, str(most))


def freeing(run: Callable) -> Callable:
    """A function for mapInArrow that returns a partition's memory when it ends: workers wait for more with what they keep."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's only
            if trim:
                trim(0)

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))
