"""Deduplication by precedence, with the counts of what was dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(column: str, precedence: Sequence[str]) -> Column:
    """Place in the list, from 1; what is not in it comes last."""
    place = F.array_position(F.array(*map(F.lit, precedence)), F.col(column))
    return F.when(F.col(column).isNull() | (place == 0), F.lit(len(precedence) + 1)).otherwise(place)


def first_by_precedence(df: DataFrame, key: Sequence[str], category: str, precedence: Sequence[str], then: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the first by precedence, then category, then ``then``.

    A grouped minimum of a struct: it combines before the shuffle, which a
    window does not.
    """
    rest = [c for c in df.columns if c not in (*key, category, *then)]
    order = F.struct(rank_of(category, precedence).alias("_rank"), F.col(category), *then, *rest)
    return df.groupBy(*key).agg(F.min(order).alias("_first")).select(*key, *(F.col(f"_first.{c}").alias(c) for c in df.columns if c not in key))


def dedup_counts(df: DataFrame, key: Sequence[str], category: str) -> DataFrame:
    """One row: raw, unique, repeated in one category, repeated across categories."""
    cells = df.groupBy(category, *key).agg(F.count("*").alias("n"))
    keys = cells.groupBy(*key).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("same"))
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw"), F.count("*").alias("unique_rows"), F.coalesce(F.sum("same"), F.lit(0)).alias("same_category"))
    return total.withColumn("across_categories", F.col("raw") - F.col("unique_rows") - F.col("same_category"))


def priority_union(first: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All rows of the first, and the fallback's rows whose key the first lacks."""
    return first.unionByName(fallback.join(first.select(key).distinct(), key, "left_anti").select(first.columns))
