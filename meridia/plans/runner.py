"""A whole run: tables in the order of their dependencies, the gate, promotion, derived tables, lineage."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from meridia.operators import writer
from meridia.quality import gate
from meridia.quality.contracts import Contract

_TABLES = Path(__file__).resolve().parents[1] / "quality" / "tables"
#: The curated and the derived tables: those that have a contract.
SILVER, GOLD = (tuple(sorted(p.stem for p in (_TABLES / layer).glob("*.yaml"))) for layer in ("silver", "gold"))
#: Tables that are built at the same time.
AT_ONCE = 2

#: Takes the tables that its parameters name; one whose parameter names no table takes them all, by name.
Builder = Callable[..., DataFrame]


def needs(builder: Builder, known: set[str]) -> list[str]:
    """The tables that a builder's parameters name."""
    return [p for p in inspect.signature(builder).parameters if p in known]


def build_layer(spark: SparkSession, builders: Mapping[str, Builder], contracts: Mapping[str, Contract], root: str, layer: str, tables: dict[str, DataFrame]) -> list[dict]:
    """Build, write and reread each table once what it needs is there; a failure stops the run."""
    wanted = {e: needs(b, {*builders, *tables} - {e}) for e, b in builders.items()}
    order = TopologicalSorter({e: [d for d in w if d in builders] for e, w in wanted.items()})
    order.prepare()
    done: list[dict] = []

    def one(entity: str) -> dict:
        own = {name: tables[name] for name in wanted[entity]}
        summary = writer.write_entity(builders[entity](**own) if own else builders[entity](tables), contracts[entity], root, layer)
        tables[entity] = spark.read.parquet(summary["path"])
        return summary

    with ThreadPoolExecutor(AT_ONCE) as pool:
        while order.is_active():
            ready = list(order.get_ready())
            for entity, summary in zip(ready, pool.map(one, ready), strict=True):
                done.append(summary)
                order.done(entity)
    return done


def run(spark: SparkSession, run_id: str, root: str, local_root: str, silver: Mapping[str, Builder], gold: Mapping[str, Builder] | Callable[[Mapping], Mapping[str, Builder]], silver_contracts: Mapping[str, Contract], gold_contracts: Mapping[str, Contract], findings: tuple[gate.Finding, ...] = (), check_gold: bool = False) -> dict:
    """Silver, gate, promotion, gold, lineage. ``root`` is ``local_root`` as Spark names it; ``gold`` may be a function of the gate's report."""
    tables: dict[str, DataFrame] = {}
    made = build_layer(spark, silver, silver_contracts, root, "silver", tables)
    writer.write_lineage(run_id, made, local_root, "silver")
    checked = {e: c for e, c in silver_contracts.items() if e in silver}
    report = gate.run_gate(run_id, checked, tables, f"{local_root}/quality", findings)
    writer.promote(silver, local_root)
    gold = gold(report) if callable(gold) else gold
    more = build_layer(spark, gold, gold_contracts, root, "gold", tables)
    writer.write_lineage(run_id, more, local_root, "gold")
    if check_gold:
        gate.run_gate(run_id, {e: c for e, c in gold_contracts.items() if e in gold}, tables, f"{local_root}/quality_gold")
    return {"report": report, "silver": made, "gold": more, "tables": tables}
