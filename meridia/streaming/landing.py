"""Streams: a landing folder whose files pass the quality checks as they come, and windowed counts.

The curated tables are snapshots; these are for sources that keep arriving.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meridia.operators.writer import conform
from meridia.quality import checks
from meridia.quality.contracts import Contract


def gated_landing(spark: SparkSession, landing: str, contract: Contract, accepted: str, checkpoint: str, on_rejected: Callable[[int, list], None] | None = None) -> StreamingQuery:
    """Append each batch of landed Parquet files that passes the contract's checks; report the others.

    A batch is written under its number, so a batch that is run again after a
    failure replaces itself. Counts are those of the whole table and not checked.
    """

    def batch(df: DataFrame, number: int) -> None:
        df.persist()
        failed = [c for c in checks.run(df, contract) if not c.passed and not c.check.startswith("count")]
        if not failed:
            conform(df, contract).write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        elif on_rejected:
            on_rejected(number, failed)
        df.unpersist()

    stream = spark.readStream.schema(contract.schema()).parquet(landing)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows; events later than the watermark are dropped. Works on tables too."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    out = timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")
