"""Windowed counts, checked on the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.streaming.landing import windowed_counts


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return windowed_counts(e).select(F.col("start").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


QUERIES = {"hourly_events": hourly_events}
ORACLE_SQL = {"hourly_events": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"}
