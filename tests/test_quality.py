import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridia.functions import geometry as g
from meridia.operators import writer
from meridia.quality import checks, contracts, gate

TABLES = Path(contracts.__file__).parent / "tables"


def told(**changes):
    base = {
        "entity": "thing",
        "primary_key": ["id"],
        "geometry": {"types": ["POINT"], "inside_extent": True},
        "count": {"min": 2, "max": 3},
        "count_by": {"column": "kind", "min": {"a": 1, "b": 1}},
        "null_report": {"columns": ["note"], "by": "kind"},
        "columns": [
            {"name": "id", "type": "VARCHAR", "pattern": "^t[0-9]$"},
            {"name": "kind", "type": "VARCHAR", "allowed": ["a", "b"]},
            {"name": "size", "type": "DOUBLE", "nullable": True, "range": [0, 10]},
            {"name": "note", "type": "VARCHAR", "nullable": True},
            {"name": "license", "type": "VARCHAR"},
            {"name": "geometry", "type": "GEOMETRY"},
        ],
    }
    return base | changes


def point(x, y):
    return bytearray(g.write_wkb(g.Geometry("POINT", [[[[x, y]]]])))


GOOD = [("t1", "a", 1.0, None, "L", point(139, 35)), ("t2", "b", None, "n", "L", point(140, 36))]


def table(spark, rows):
    return spark.createDataFrame(rows, contracts.build(told()).schema())


def test_all_contracts_are_valid():
    assert len(contracts.load(TABLES / "silver")) == 13
    assert len(contracts.load(TABLES / "gold")) == 10


@pytest.mark.parametrize(
    "change",
    [
        {"other": 1}, {"entity": "Thing"}, {"primary_key": ["nope"]}, {"primary_key": ["note"]}, {"columns": []}, {"count": {}}, {"count": {"min": 3, "max": 1}},
        {"count_by": {"column": "note", "min": {}}}, {"count_by": {"column": "kind", "min": {"z": 1}}}, {"null_report": {"columns": ["id"]}}, {"geometry": {"types": []}}, {"geometry": {"types": ["BLOB"]}},
        {"columns": told()["columns"] + [{"name": "id", "type": "VARCHAR"}]}, {"columns": [{**c, "pattern": "x"} if c["name"] == "size" else c for c in told()["columns"]]},
        {"columns": [{**c, "range": [1, 2]} if c["name"] == "note" else c for c in told()["columns"]]}, {"columns": [c for c in told()["columns"] if c["name"] != "license"]}, {"columns": [{**c, "type": "BLOB"} if c["name"] == "size" else c for c in told()["columns"]]},
    ],
)
def test_breakers(change):
    assert contracts.problems(told(**change), "thing")


def test_good_contract_and_registry():
    assert contracts.problems(told(), "thing") == []
    c = contracts.build(told(sources=["s"]))
    assert contracts.against_registry({"thing": c}, {"s": ["thing"]}) == []
    assert len(contracts.against_registry({"thing": c}, {"t": ["thing", "x"]})) == 3


@pytest.mark.parametrize(
    "bad, check",
    [
        (("t1", "a", None, None, "L", point(139, 35)), "primary_key_unique"),
        (("x1", "a", None, None, "L", point(139, 35)), "pattern.id"),
        (("t3", "c", None, None, "L", point(139, 35)), "allowed.kind"),
        (("t3", "a", 11.0, None, "L", point(139, 35)), "range.size"),
        (("t3", "a", None, None, None, point(139, 35)), "not_null.license"),
        (("t3", "a", None, None, "L", point(10, 35)), "inside_extent"),
        (("t3", "a", None, None, "L", bytearray(g.write_wkb(g.read_wkt("LINESTRING (139 35, 139 36)")))), "geometry_type"),
        (("t3", "a", None, None, "L", point(float("inf"), 35)), "geometry_valid"),
    ],
)
def test_one_violation_fails_one_check(spark, bad, check):
    found = checks.run(table(spark, [*GOOD, bad]), contracts.build(told()))
    assert [c.check for c in found if not c.passed] == [check]


def test_counts_and_schema(spark):
    c = contracts.build(told())
    failing = lambda df: {x.check: x.failing for x in checks.run(df, c) if not x.passed}
    assert failing(table(spark, GOOD)) == {}
    assert failing(table(spark, GOOD[:1])) == {"count": 1, "count_by.b": 1}
    assert failing(table(spark, GOOD).drop("note")) == {"schema": 1}
    assert failing(table(spark, [])) == {"count": 2, "count_by.a": 1, "count_by.b": 1}


def test_gate_writes_then_raises(spark, tmp_path):
    c = {"thing": contracts.build(told())}
    finding = gate.share_of_rows("f", "Notes", "thing", "note IS NULL")
    told1 = gate.run_gate("20260101T000000Z", c, {"thing": table(spark, GOOD)}, tmp_path, (finding,), bronze={"s": {"files": [{"reused_from": "x"}, {}]}})
    assert told1["status"] == "passed" and told1["coverage"][0]["share"] == 0.5
    assert told1["informative"]["null_rates"]["thing"]["note"] == {"rows": 2, "nulls": 1, "rate": 0.5, "by": {"a": {"rows": 1, "nulls": 1, "rate": 1.0}, "b": {"rows": 1, "nulls": 0, "rate": 0.0}}}
    with pytest.raises(gate.QualityError, match="count"):
        gate.run_gate("20260102T000000Z", c | {"other": c["thing"]}, {"thing": table(spark, GOOD[:1])}, tmp_path)
    second = json.loads((tmp_path / "run_id=20260102T000000Z.json").read_text())
    assert second["status"] == "failed" and second["informative"]["count_variation"]["thing"]["change"] == -0.5
    assert [x["entity"] for x in second["blocking"]["checks"] if x["check"] == "exists" and not x["passed"]] == ["other"]


def test_writer_is_idempotent(spark, tmp_path):
    c = contracts.build(told())
    first = writer.write_entity(table(spark, GOOD).withColumn("extra", F.lit(1)), c, f"file://{tmp_path}")
    again = writer.write_entity(table(spark, GOOD[::-1]), c, f"file://{tmp_path}")
    assert first == again and first["rows"] == 2
    assert [r.id for r in spark.read.parquet(first["path"]).collect()] == ["t1", "t2"]
    with pytest.raises(ValueError, match="missing"):
        writer.write_entity(table(spark, GOOD).drop("kind"), c, f"file://{tmp_path}")
    assert writer.write_lineage("20260101T000000Z", [first], str(tmp_path), "silver").is_file()
    with pytest.raises(ValueError):
        writer.write_lineage("today", [], str(tmp_path), "silver")
    assert spark.read.parquet(writer.promote(["thing"], str(tmp_path))[0]).count() == 2
    assert writer.create_views(spark, {"v1": "SELECT id FROM thing"}, {"thing": table(spark, GOOD)}) == {"v1": 2}
    with pytest.raises(ValueError, match="v2"):
        writer.create_views(spark, {"v2": "SELECT id FROM thing WHERE id = 'x'"}, {"thing": table(spark, GOOD)})


def test_rates_and_shares(spark):
    assert checks.share(257, 400) == 0.6425 and checks.share(1, 0) is None and checks.change(90, 100) == -0.1
    left, right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    assert {r.k for r in checks.cross_check(left, right, "k", "v").collect()} == {2, 3}
    assert [r.k for r in checks.missing_keys(left, right, "k", "k").collect()] == [2]
