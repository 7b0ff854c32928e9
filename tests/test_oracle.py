"""Every query with oracle SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from meridia.plans import registry

SQL = registry.oracle_sql()


def canonical(frame):
    """Rows with sorted columns, in sorted order."""
    columns = sorted(frame.columns)
    out = []
    for row in frame[columns].itertuples(index=False):
        cells = []
        for x in row:
            if not isinstance(x, (list, dict)) and pd.isna(x):
                cells.append("null")
            elif isinstance(x, float):
                cells.append(f"{x:.9g}")
            else:
                cells.append(str(x).removesuffix(".0"))
        out.append(tuple(cells))
    return columns, sorted(out)


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'").df()
    return con


@pytest.mark.parametrize("key", sorted(k for k in SQL if k in os.environ.get("ONLY", k)))
def test_rows(spark, sf_dir, oracle, key):
    found = registry.queries()[key](spark, sf_dir)
    expected = oracle.execute(SQL[key]).df()
    assert canonical(found.toPandas()) == canonical(expected)
    kinds = {c: str(t) for c, t in zip(expected.columns, expected.dtypes, strict=True)}
    for name, kind in found.dtypes:
        if kind in ("int", "bigint") and len(expected) and not expected[name].isna().any():
            assert kinds[name] == {"int": "int32", "bigint": "int64"}[kind], (name, kind, kinds[name])


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("key", ["join_06_not_in", "set_04_difference"])
def test_differences_have_rows(spark, sf_dir, key):
    assert registry.queries()[key](spark, sf_dir).count() > 0


def test_no_broadcast_of_any_size(spark, sf_dir):
    """Neither NOT IN nor OR in a join's condition brings a broadcast that no setting bounds."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("join_04_left_on_expression", "join_06_not_in"):
            assert "Broadcast" not in registry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
