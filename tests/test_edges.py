"""Points on the edge of a cell or a box: the rows of the oracle SQL, which larger tables hold and the small ones do not."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from meridia.plans import registry
from test_oracle import canonical


def on_edges(spark, sf_dir, folder, keys):
    """The tables, with suppliers of the given keys alone."""
    for path in Path(sf_dir).glob("*.parquet"):
        if path.stem != "supplier":
            (folder / path.name).symlink_to(path)
    one = spark.read.parquet(f"{sf_dir}/supplier.parquet").limit(1)
    own = one.drop("s_suppkey").crossJoin(spark.createDataFrame([(k,) for k in keys], "s_suppkey long")).select(one.columns)
    own.coalesce(1).write.parquet(str(folder / "supplier.parquet"))
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return str(folder), con


@pytest.mark.parametrize("query, keys", [("hex_index", (382, 469, 1160, 1481)), ("curated_poi", (3500, 4700, 5300))])
def test_rows_on_edges(spark, sf_dir, tmp_path, query, keys):
    folder, con = on_edges(spark, sf_dir, tmp_path, keys)
    assert canonical(registry.queries()[query](spark, folder).toPandas()) == canonical(con.execute(registry.oracle_sql()[query]).df())
