"""Writing contracted tables: cast, sorted by key, published whole, with content digests and lineage."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.quality.contracts import Contract
from meridia.quality.gate import write_json

RUN_ID = re.compile(r"\d{8}T\d{6}Z")


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Exactly the contract's columns, in order and type."""
    missing = [n for n in contract.names if n not in df.columns]
    if missing:
        raise ValueError(f"{contract.entity}: missing columns {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in contract.schema()))


def content_digest(df: DataFrame) -> str:
    """A digest of the rows that depends on neither their order nor the files."""
    texts = [F.coalesce(F.hex(F.col(f.name)) if f.dataType.typeName() == "binary" else F.to_json(F.struct(f.name)), F.lit("null")) for f in df.schema]
    one = F.xxhash64(*texts)
    r = df.agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.bit_xor(F.xxhash64(one, F.lit(1))).alias("y")).first()
    return hashlib.sha256(f"{r.n}:{r.x}:{r.y}".encode()).hexdigest()


def write_entity(df: DataFrame, contract: Contract, root: str, layer: str = "silver", single_file: bool = False) -> dict:
    """Write the table sorted by its key and publish it by renaming; returns a summary.

    It is written in sorted ranges of the key, as many as its size asks for
    (adaptive execution makes one of a small table), or as a single file.
    """
    spark = df.sparkSession
    keys = [F.col(k).asc_nulls_last() for k in contract.primary_key]
    ready = conform(df, contract)
    ready = ready.repartition(1).sortWithinPartitions(*keys) if single_file else ready.repartitionByRange(*keys).sortWithinPartitions(*keys)
    final, part = f"{root}/{layer}/{contract.entity}.parquet", f"{root}/{layer}/_{contract.entity}.part"
    ready.write.mode("overwrite").option("compression", "zstd").parquet(part)
    written = spark.read.parquet(part)
    if [(f.name, f.dataType) for f in written.schema] != [(f.name, f.dataType) for f in contract.schema()]:
        raise ValueError(f"{contract.entity}: the written schema is not the contract's")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path(final), True)
    if not files.rename(path(part), path(final)):
        raise OSError(f"could not publish {final}")
    table = spark.read.parquet(final)
    return {"entity": contract.entity, "rows": table.count(), "bytes": files.getContentSummary(path(final)).getLength(), "content_sha256": content_digest(table), "path": final}


def write_lineage(run_id: str, summaries: Iterable[Mapping], root: str, layer: str) -> Path:
    """The run's record beside the tables, so that tables do not change with it."""
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"bad run id {run_id!r}")
    path = Path(root, layer, "_runs", f"run_id={run_id}.json")
    write_json(path, {"run_id": run_id, "entities": sorted(map(dict, summaries), key=lambda s: s["entity"])})
    return path


def promote(entities: Iterable[str], root: str) -> list[str]:
    """Silver tables as gold ones, by hard links where the file system has them."""
    out = []
    for entity in entities:
        source, target = Path(root, "silver", f"{entity}.parquet"), Path(root, "gold", f"{entity}.parquet")
        shutil.rmtree(target, ignore_errors=True)
        shutil.copytree(source, target, copy_function=_link)
        out.append(str(target))
    return out


def _link(source: str, target: str) -> None:
    try:
        os.link(source, target)
    except OSError:
        shutil.copy2(source, target)


def create_views(spark: SparkSession, views: Mapping[str, str], tables: Mapping[str, DataFrame], may_be_empty: Iterable[str] = ()) -> dict[str, int]:
    """Temporary views by SQL over named tables; raises if one is empty that may not be."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    rows = {}
    for name, sql in views.items():
        spark.sql(sql).createOrReplaceTempView(name)
        rows[name] = spark.table(name).count()
    empty = sorted(n for n, k in rows.items() if not k and n not in set(may_be_empty))
    if empty:
        raise ValueError(f"empty views: {empty}")
    return rows


def file_digest(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def json_digest(told) -> str:
    return hashlib.sha256(json.dumps(told, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def files_digest(files: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """One checksum over a table of files, in order of path."""
    return files.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(path, digest))), lambda s: F.concat(s[path], F.lit("\t"), s[digest], F.lit("\n"))), ""), 256).alias("checksum"))
