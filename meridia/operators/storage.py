"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in a local session without it."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        told = "file://" + tempfile.mkdtemp(prefix="meridia-")
        spark.conf.set("spark.checkpoint.dir", told)
    return told.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: its lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if getattr(context, "_meridia_shipped", False) or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="meridia-package-"), "meridia.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(path))
    context._meridia_shipped = True
