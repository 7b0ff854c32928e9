"""All queries of the library, by key, with their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from meridia.operators.storage import ship_package

#: Modules with ``QUERIES`` and ``ORACLE_SQL`` dictionaries.
MODULES: tuple[str, ...] = ("inventory", "spatial", "reports", "streams", "country")


def _merged(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out.update(getattr(import_module(f"meridia.plans.{module}"), name))
    return out


def _shipped(query: Callable) -> Callable:
    """The query, after the package was sent to the executors, whose Python functions import it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _shipped(query) for key, query in _merged("QUERIES").items()}


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE_SQL")
