import dataclasses
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridia.operators import graph
from meridia.plans import assemble, country, runner
from meridia.quality import contracts, gate
from meridia.streaming import landing

C = contracts.Column
PLACE = contracts.Contract("place", ("id",), (C("id", "VARCHAR"), C("kind", "VARCHAR", allowed=("a", "b")), C("license", "VARCHAR")), count_min=1)
SUM = contracts.Contract("total", ("kind",), (C("kind", "VARCHAR"), C("n", "BIGINT"), C("license", "VARCHAR")))


def places(spark, rows):
    return spark.createDataFrame(rows, "id string, kind string").withColumn("license", F.lit("L"))


def test_run_twice_gives_the_same(spark, tmp_path):
    total = lambda t: t["place"].groupBy("kind").agg(F.count("*").alias("n")).withColumn("license", F.lit("L"))
    digests = []
    for run_id in ("20260101T000000Z", "20260102T000000Z"):
        done = runner.run(spark, run_id, f"file://{tmp_path}", str(tmp_path), {"place": lambda t: places(spark, [("1", "a"), ("2", "b")])}, {"total": total}, {"place": PLACE}, {"total": SUM}, (gate.share_of_rows("f", "F", "place", "kind = 'a'"),), check_gold=True)
        digests.append([s["content_sha256"] for s in (*done["silver"], *done["gold"])])
        assert done["report"]["coverage"][0]["share"] == 0.5
    assert digests[0] == digests[1] and done["report"]["informative"]["count_variation"]["place"]["change"] == 0
    assert Path(tmp_path, "gold", "place.parquet").is_dir() and Path(tmp_path, "gold", "_runs", "run_id=20260102T000000Z.json").is_file()
    with pytest.raises(gate.QualityError):
        runner.run(spark, "20260103T000000Z", f"file://{tmp_path}", str(tmp_path), {"place": lambda t: places(spark, [("1", "z")])}, {}, {"place": PLACE}, {})


def test_all_tables_have_an_order():
    tables = Path(contracts.__file__).parent / "tables"
    assert set(runner.SILVER) == set(contracts.load(tables / "silver")) and set(runner.GOLD) == set(contracts.load(tables / "gold"))


def test_gated_landing(spark, tmp_path):
    rejected = []
    for n, rows in enumerate(([("1", "a")], [("2", "z")], [("3", "b")])):
        places(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        landing.gated_landing(spark, f"{tmp_path}/in", PLACE, f"{tmp_path}/ok", f"{tmp_path}/state", lambda number, failed: rejected.append((number, [c.check for c in failed]))).awaitTermination()
    assert rejected == [(1, ["allowed.kind"])]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/ok").collect()) == ["1", "3"]


def test_windowed_stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = landing.windowed_counts(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == events.count()


def test_components_of_chains_and_loners(spark):
    nodes = spark.createDataFrame([(i,) for i in range(40)], "node long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (32, 32)], "a long, b long")
    found = {r.node: r.component for r in graph.connected_components(nodes, edges).collect()}
    assert found == {i: 0 if i <= 20 else 30 if i == 31 else i for i in range(40)}


def test_contract_is_a_value():
    assert dataclasses.replace(PLACE, count_min=2) != PLACE


def test_order_by_what_builders_name():
    """A builder's parameters name the tables that it reads."""
    known = {"station", "rail"}
    assert runner.needs(lambda station, rail: None, known) == ["station", "rail"] and runner.needs(lambda t: None, known) == []


def test_built_in_order(spark, tmp_path):
    built = []

    def place():
        built.append("place")
        return places(spark, [("1", "a"), ("2", "b")])

    def total_of(place):
        built.append("total")
        return place.groupBy("kind").agg(F.count("*").alias("n")).withColumn("license", F.lit("L"))

    tables = {}
    runner.build_layer(spark, {"total": total_of, "place": lambda t: place()}, {"place": PLACE, "total": SUM}, f"file://{tmp_path}", "silver", tables)
    assert built == ["place", "total"] and set(tables) == {"place", "total"}


def test_a_run_of_the_whole_country(spark, sf_dir, tmp_path):
    """Every curated table with sources, the gate, and the derived tables of its report, in one run."""
    sources = country.sources(spark, sf_dir)
    tables = Path(contracts.__file__).parent / "tables"
    # the published counts, codes and extent are those of the real country
    loose = lambda layer: {e: dataclasses.replace(c, count_min=0, count_max=None, count_by=None, geometry_types=(), columns=tuple(dataclasses.replace(x, pattern=None, allowed=None, range=None, nullable=True) for x in c.columns)) for e, c in contracts.load(tables / layer).items()}
    silver = assemble.silver_builders(sources)
    gold = lambda report: assemble.gold_builders(spark, report, assemble.null_island(sources))
    checked = {e: c for e, c in loose("silver").items() if e in silver}
    done = runner.run(spark, "20260101T000000Z", f"file://{tmp_path}", str(tmp_path), silver, gold, checked, loose("gold"), (gate.share_of_rows("f", "F", "poi", "prefecture_code IS NULL"),))
    assert {s["entity"] for s in done["silver"]} == set(silver) and len(silver) == 11
    assert done["tables"]["null_findings"].count() == 2 and done["tables"]["null_rates_by_prefecture"].count() > 20
    assert done["tables"]["osm_summary"].agg(F.sum("elements")).first()[0] > done["tables"]["rail"].count()
