import copy

import pytest

from meridia.sources import registry

KNOWN = {"required": frozenset({"seeds"}), "tables": frozenset({"poi", "building", "prefecture"}), "resources": frozenset({"region"})}


def source(name, kind, **params):
    return {"id": name, "kind": kind, "url": "https://x.org", "license": {"id": "L", "name": "L", "url": "https://l.org"}, "attribution": "A", "feeds": ["poi"], "days": [1, 30], "params": params}


@pytest.fixture
def told(tmp_path):
    (tmp_path / "q.rq").write_text("SELECT")
    return {
        "version": 1,
        "user_agent": "engine (+https://x.org)",
        "map_api": {"endpoint": "https://m.org", "timeout_s": 180, "pause_s": 10, "snapshot_date": None},
        "boxes": {"north": [41.3, 139.3, 45.6, 145.9]},
        "sources": [
            source("files", "http_files", files=[{"name": "a", "url": "https://x.org/a.zip"}]),
            source("map", "overpass", categories=[{"id": "c", "selectors": ['nwr["a"="b"]'], "out": "center", "bboxes": "all"}]),
            source("around", "overpass_around", center={"lat": 35.6, "lon": 139.7}, radius_m=500, selectors=["way[building]"], out="geom"),
            source("graph", "sparql", queries=[{"id": "q", "file": "q.rq"}]),
            source("rest", "rest_json", resources=["region"]),
            source("dem", "cog_tiles", bucket="b", region="r", tile_name="{lat}_{lon}", aois={"a": [35, 138, 36, 139]}),
            source("night", "earthdata_tiles", product="p", collection="5", year=2025, archive_url="https://n.org/{year}", token_env="TOKEN", tiles=["h31v05"], crop_bbox=[30, 130, 40, 140], layers=["l"]),
            source("seeds", "local_csv", dir="seeds", files=[{"name": "s", "file": "s.csv", "required_columns": ["source_url"]}]),
        ],
    }


def test_good(told, tmp_path):
    assert registry.problems(told, tmp_path, **KNOWN) == []
    assert registry.feeds(told)["map"] == ["poi"]


def params(told, name):
    return next(s for s in told["sources"] if s["id"] == name)["params"]


BREAKERS = [
    lambda t: t["sources"].append(copy.deepcopy(t["sources"][0])), lambda t: t["sources"][0].update(kind="ftp"), lambda t: t["sources"][0]["license"].pop("url"), lambda t: params(t, "rest")["resources"].append("images"),
    lambda t: params(t, "map")["categories"][0].update(selectors=['nwr(area.x)["a"="b"]']), lambda t: params(t, "map")["categories"][0].update(bboxes=["mars"]), lambda t: t["boxes"].update(north=[139.3, 41.3, 145.9, 45.6]),
    lambda t: t["map_api"].update(snapshot_date="31/10/2026"), lambda t: t.update(sources=t["sources"][:-1]), lambda t: params(t, "seeds")["files"][0]["required_columns"].clear(), lambda t: params(t, "around").update(radius_m=50_000),
    lambda t: params(t, "graph")["queries"][0].update(file="none.rq"), lambda t: t.update(user_agent="requests"), lambda t: t["sources"][0].update(feeds=["x"]), lambda t: t["sources"][0].update(days=[31]), lambda t: t["sources"][0].pop("params"),
    lambda t: params(t, "night").update(tiles=["x"]), lambda t: params(t, "dem").update(tile_name="x"), lambda t: t.update(version=2),
]


@pytest.mark.parametrize("breaker", BREAKERS)
def test_broken(told, tmp_path, breaker):
    breaker(told)
    assert registry.problems(told, tmp_path, **KNOWN)
