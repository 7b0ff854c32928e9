"""Contract checks of a table in one pass.

All column checks compile into one aggregate: one scan of the table, whatever
the number of checks. Minima by category add one grouped count.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.functions import geometry, points
from meridia.quality.contracts import GEOMETRY, Contract

#: Default extent: south, west, north, east.
EXTENT = (20.0, 122.0, 46.0, 154.0)


@dataclass(frozen=True)
class Check:
    entity: str
    check: str
    failing: int
    detail: str = ""
    #: Rows of the table, told by the check of their number.
    rows: int | None = None

    @property
    def passed(self) -> bool:
        return self.failing == 0

    def as_dict(self) -> dict:
        return {"entity": self.entity, "check": self.check, "passed": self.passed, "failing": self.failing, "detail": self.detail}


def _violations(contract: Contract, columns: Iterable[str], extent: tuple[float, float, float, float]) -> dict[str, Column]:
    """For each check a condition that holds for failing rows; null counts as passing."""
    out: dict[str, Column] = {}
    have = set(columns)
    for c in contract.columns:
        if c.name not in have:
            continue
        v = F.col(f"`{c.name}`")
        if not c.nullable:
            out[f"not_null.{c.name}"] = v.isNull()
        if c.pattern:
            out[f"pattern.{c.name}"] = ~v.rlike(c.pattern)
        if c.allowed:
            out[f"allowed.{c.name}"] = ~v.isin(*c.allowed)
        if c.range:
            out[f"range.{c.name}"] = ~v.between(*c.range)
    if contract.geometry_types and GEOMETRY in have:
        shape = F.col(GEOMETRY)
        out["geometry_valid"] = shape.isNull() | geometry.is_empty(GEOMETRY) | ~geometry.valid(GEOMETRY)
        out["geometry_type"] = ~points.geometry_type(shape).isin(*contract.geometry_types)
        if contract.inside_extent:
            box = geometry.envelope(GEOMETRY)
            out["inside_extent"] = points.outside_box(box["west"], box["south"], box["east"], box["north"], *extent)
    return out


def run(df: DataFrame, contract: Contract, extent: tuple[float, float, float, float] = EXTENT) -> list[Check]:
    """All checks of one table: one scan without a shuffle, and one of the key's columns alone that counts its values."""
    entity = contract.entity
    wanted = {f.name: f.dataType for f in contract.schema()}
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{n}: {have.get(n, 'missing')}" for n in wanted if have.get(n) != wanted[n]] + [f"{n}: not declared" for n in have if n not in wanted]
    order = [] if wrong or list(have) == list(wanted) else ["order of columns"]
    out = [Check(entity, "schema", len(wrong) + len(order), "; ".join(map(str, wrong + order)))]
    tests = {k: v for k, v in _violations(contract, have, extent).items()}
    key = [F.col(f"`{k}`") for k in contract.primary_key if k in have]
    counted = df.agg(F.count("*").alias("_n"), *(F.count_if(F.coalesce(v, F.lit(False))).alias(f"_{i}") for i, v in enumerate(tests.values()))).first()
    out += [Check(entity, name, counted[f"_{i}"]) for i, name in enumerate(tests)]
    if key:
        out.append(Check(entity, "primary_key_unique", counted["_n"] - df.select(*key).distinct().count()))
    n = counted["_n"]
    short = max(0, contract.count_min - n)
    over = max(0, n - contract.count_max) if contract.count_max is not None else 0
    out.append(Check(entity, "count", short + over, f"{n} rows; {contract.count_min} to {'any' if contract.count_max is None else contract.count_max}", n))
    if contract.count_by and contract.count_by in have:
        found = {r[0]: r[1] for r in df.where(F.col(contract.count_by).isin(*contract.count_by_min)).groupBy(contract.count_by).count().collect()}
        out += [Check(entity, f"count_by.{v}", max(0, least - found.get(v, 0)), f"{found.get(v, 0)} rows; at least {least}") for v, least in contract.count_by_min.items()]
    return out


def null_rates(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """column_name, grp, row_count, null_count, rate for the whole table (grp null) and each group.

    One pass: the columns are stacked by the aggregate, not by a scan each. Rows
    without a group are counted under ``(no <by>)``.
    """
    label = F.coalesce(F.col(by).cast("string"), F.lit(f"(no {by})")) if by else F.lit(None).cast("string")
    parts = df.groupBy(label.alias("grp")).agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)))
    stacked = parts.select("grp", "n", F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(columns)))).alias("s"))
    groups = stacked.select("s.column_name", "grp", F.col("n").alias("row_count"), "s.null_count")
    whole = groups.groupBy("column_name").agg(F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count")).select("column_name", F.lit(None).cast("string").alias("grp"), "row_count", "null_count")
    both = whole.union(groups) if by else whole
    return both.withColumn("rate", rate(F.col("null_count"), F.col("row_count")))


def rate(part: Column, total: Column) -> Column:
    """Share rounded half even to four digits; null for an empty total."""
    return F.when(total > 0, F.bround(part / total, 4))


def share(value: int, total: int | None) -> float | None:
    return round(value / total, 4) if total else None


def change(now: int, before: int | None) -> float | None:
    """Relative change from an earlier count."""
    return round((now - before) / before, 4) if before else None


def cross_check(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Keys whose value in the two tables is not the same, a missing one included."""
    pair = left.select(key, F.col(column).alias("_l")).join(right.select(key, F.col(column).alias("_r")), key, "full_outer")
    return pair.where(~F.col("_l").eqNullSafe(F.col("_r"))).select(key, F.col("_l").alias("left_value"), F.col("_r").alias("right_value"))


def missing_keys(df: DataFrame, reference: DataFrame, column: str, other: str) -> DataFrame:
    """Values of ``column`` that the reference does not have; nulls are no values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().join(reference.select(F.col(other).alias(column)), column, "left_anti")
