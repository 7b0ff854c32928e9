"""Stops are matched as the definition in ``choose`` says, without a row for each stop and candidate."""

from __future__ import annotations

import random

from meridia.operators import matching


def walk(stops, candidates):
    out = {}
    for line in {s[0] for s in stops}:
        previous = None
        for _, seq, kind, name in sorted(s for s in stops if s[0] == line):
            found = [c[1:] for c in candidates if c[0] == name and c[1] is not None]
            chosen, method = matching.choose(found, kind, previous)
            previous = chosen[1:3] if chosen else previous
            out[line, seq] = (chosen[0] if chosen else None, len(found), method)
    return out


def network(seed, n, names):
    rnd = random.Random(seed)
    candidates = [(f"n{rnd.randrange(names)}", f"s{i}", float(rnd.randrange(30)), float(rnd.randrange(5)), rnd.choice([None, None, float(rnd.randrange(9))])) for i in range(n)]
    stops = [(f"l{i}", k, rnd.choice(["full", "mini"]) if i % 3 else "full", rnd.choice([None, *(f"n{j}" for j in range(names + 1))])) for i in range(60) for k in range(rnd.randrange(1, 9))]
    return stops, [*candidates, ("n0", None, 1.0, 1.0, 0.0)]


def matched(spark, stops, candidates):
    found = matching.match_stops(spark.createDataFrame(stops, "line_id string, seq int, kind string, name string"), spark.createDataFrame(candidates, "name string, station_id string, lon double, lat double, track_m double"))
    return {(r.line_id, r.seq): (r.station_id, r.candidates, r.match_method) for r in found.collect()}


def test_as_defined(spark, monkeypatch):
    monkeypatch.setattr(matching, "STOPS_A_PART", 50)
    for seed, n, names in ((1, 40, 5), (2, 12, 8), (3, 200, 3)):
        stops, candidates = network(seed, n, names)
        assert matched(spark, stops, candidates) == walk(stops, candidates)
    stops = [("a", 1, "mini", "x"), ("a", 2, "mini", None)]
    assert matched(spark, stops, []) == walk(stops, [])


def test_a_part_gets_candidates_once(spark):
    """The walk's input has a row for each candidate of a part's names, not for each stop and candidate."""
    candidates = [("x", f"s{i:03}", float(i), 0.0, None) for i in range(500)]
    stops = [(f"l{i}", k, "mini", "x") for i in range(200) for k in range(10)]
    found = matching.match_stops(spark.createDataFrame(stops, "line_id string, seq int, kind string, name string"), spark.createDataFrame(candidates, "name string, station_id string, lon double, lat double, track_m double"))
    assert "FlatMapCoGroupsInPandas" in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.station_id, r.candidates, r.match_method) for r in found.collect()} == {("s000", 500, "sequence")} and found.count() == 2000
