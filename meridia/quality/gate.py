"""The quality gate: checks that block, figures that inform, findings on coverage.

The report is written whatever the checks say; then the gate raises if any failed.
"""

from __future__ import annotations

import datetime
import json
import os
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame

from meridia.quality import checks
from meridia.quality.contracts import Contract


class QualityError(RuntimeError):
    """At least one blocking check failed; the report says which."""


Finding = Callable[[Mapping[str, DataFrame]], dict]


def finding(name: str, title: str, value: int, total: int | None, source: str, detail: str | None = None) -> dict:
    return {"id": name, "title": title, "value": value, "total": total, "share": checks.share(value, total), "source": source, "detail": detail}


def share_of_rows(name: str, title: str, entity: str, condition: str, of: str = "true", source: str = "") -> Finding:
    """A finding that counts the rows of an entity that meet a condition, in one aggregate."""

    def run(tables: Mapping[str, DataFrame]) -> dict:
        r = tables[entity].selectExpr(f"coalesce({of}, false) AS t", f"coalesce({of}, false) AND coalesce({condition}, false) AS v").selectExpr("count_if(v) AS v", "count_if(t) AS t").first()
        return finding(name, title, r.v, r.t, source or entity)

    return run


def previous_counts(folder: str | Path, run_id: str) -> dict[str, int]:
    """Row counts of the last earlier report."""
    earlier = sorted(p for p in Path(folder).glob("run_id=*.json") if p.stem.removeprefix("run_id=") < run_id)
    return json.loads(earlier[-1].read_text())["informative"]["rows"] if earlier else {}


def write_json(path: str | Path, told: dict) -> None:
    """Write whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    part.write_text(json.dumps(told, ensure_ascii=False, indent=2, sort_keys=True), encoding="utf-8")
    os.replace(part, path)


def run_gate(run_id: str, contracts: Mapping[str, Contract], tables: Mapping[str, DataFrame], folder: str | Path, findings: tuple[Finding, ...] = (), extra: tuple[checks.Check, ...] = (), bronze: Mapping[str, dict] | None = None, extent: tuple[float, float, float, float] = checks.EXTENT) -> dict:
    """Check every contracted table, write the report, raise QualityError if a check failed.

    A table without a contract is not checked, one that is missing fails
    ``exists``. ``bronze`` holds the sources' metadata, of which modes and
    reuse are counted.
    """
    found = list(extra)
    rows: dict[str, int] = {}
    rates: dict[str, dict] = {}
    for entity, contract in contracts.items():
        df = tables.get(entity)
        found.append(checks.Check(entity, "exists", int(df is None)))
        if df is None:
            continue
        own = checks.run(df, contract, extent)
        found += own
        rows[entity] = next(c.rows for c in own if c.check == "count")
        report = [c for c in contract.null_report if c in df.columns]
        if report:
            rates[entity] = {}
            for r in checks.null_rates(df, report, contract.null_report_by).collect():
                column = rates[entity].setdefault(r.column_name, {"by": {}})
                figures = {"rows": r.row_count, "nulls": r.null_count, "rate": r.rate}
                column["by"].setdefault(r.grp, figures) if r.grp is not None else column.update(figures)
    before = previous_counts(folder, run_id)
    failed = [c for c in found if not c.passed]
    told = {
        "version": 1,
        "run_id": run_id,
        "generated_at": datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "status": "failed" if failed else "passed",
        "blocking": {"passed": len(found) - len(failed), "failed": len(failed), "checks": [c.as_dict() for c in found]},
        "informative": {
            "rows": rows,
            "null_rates": rates,
            "count_variation": {e: {"rows": n, "previous": before.get(e), "change": checks.change(n, before.get(e))} for e, n in rows.items()},
            "bronze": {s: {"files": len(m.get("files", [])), "reused": sum(bool(f.get("reused_from")) for f in m.get("files", [])), "warnings": len(m.get("warnings", []))} for s, m in (bronze or {}).items()},
        },
        "coverage": [f(tables) for f in findings],
    }
    write_json(Path(folder) / f"run_id={run_id}.json", told)
    if failed:
        raise QualityError("; ".join(f"{c.entity}.{c.check}: {c.failing}" for c in failed))
    return told
