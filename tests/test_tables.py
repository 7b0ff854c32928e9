"""The curated and derived tables on a small made-up country."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions import geometry as g
from meridia.operators import dedup
from meridia.operators.matching import choose
from meridia.plans import curated, derived
from meridia.quality import checks, contracts, findings
from meridia.sources import readers

TABLES = Path(contracts.__file__).parent / "tables"
SILVER, GOLD = contracts.load(TABLES / "silver"), contracts.load(TABLES / "gold")


def square(w, s, size=1.0):
    return bytearray(g.write_wkb(g.read_wkt(f"POLYGON (({w} {s}, {w + size} {s}, {w + size} {s + size}, {w} {s + size}, {w} {s}))")))


def conforms(df, contract):
    """All checks but the counts, which are those of the whole country."""
    failed = [c for c in checks.run(df, contract) if not c.passed and not c.check.startswith("count")]
    types = [c for c in failed if c.check == "schema"]
    assert not failed or types == failed and all("order" not in c.detail for c in types), failed
    return df


@pytest.fixture(scope="module")
def prefecture(spark):
    admin = spark.createDataFrame([("JP-13", "東京", "Tokyo", "Kanto", "Q1", "JPN", square(139, 35)), ("JP-27", "大阪", "Osaka", None, "Q2", "JPN", square(135, 34)), ("XX-1", None, "x", None, "Q3", "XXX", square(0, 0))], "iso_3166_2 string, name_ja string, name string, region string, wikidataid string, adm0_a3 string, geometry binary")
    labels = spark.createDataFrame([("JP-13", "Q9", "東京都", "Tokyo", None)], "iso string, prefecture string, name_ja string, name_en string, name_es string")
    return curated.prefecture(admin, labels, spark.createDataFrame([("JP-27", "Kinki")], "prefecture_code string, real_region string")).cache()


@pytest.fixture(scope="module")
def regions(spark, prefecture):
    seed = spark.createDataFrame([("kanto", "Kanto", "1", "1996", "Kanto", "oficial", "JP-13", "https://a"), ("kanto", "Kanto", "1", "1996", "Kinki", "teoría de fans", "JP-27", "https://b"), ("johto", "Johto", "2", "1999", "Kinki", "ampliamente aceptada", "JP-27", "https://c")], "region_id string, game_name string, generation string, year string, real_region string, confidence string, prefecture_code string, source_url string")
    labels = spark.createDataFrame([("Kanto", "カントー", None)], "name_en string, name_ja string, name_es string")
    return curated.game_region(seed, labels, prefecture).cache()


def element(category, kind, number, lon=None, lat=None, path=None, members=None, **tags):
    return {"category": category, "doc": {"type": kind, "id": number, "lon": lon, "lat": lat, "geometry": path and [{"lon": x, "lat": y} for x, y in path], "members": members, "tags": {k.replace("__", ":"): v for k, v in tags.items()}}}


@pytest.fixture(scope="module")
def elements(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("map")

    def make(name, items):
        paths = []
        for i, item in enumerate(items):
            folder = root / name / f"b{i}" / item["category"]
            folder.mkdir(parents=True)
            (folder / "box.json").write_text(json.dumps({"elements": [item["doc"]]}))
            paths.append(str(folder / "box.json"))
        return readers.read_elements(spark, paths)

    return make


@pytest.fixture(scope="module")
def poi_raw(elements):
    return elements("poi", [
        element("pokemon_store", "node", 1, 139.5, 35.5, name="ポケモンセンター A"), element("pokemon_store", "node", 1, 139.5, 35.5, name="ポケモンセンター A"), element("onsen", "node", 1, 139.5, 35.5, name="ポケモンセンター A"),
        element("poke_lids", "node", 2, 139.51, 35.5), element("poke_lids", "node", 3, 139.515, 35.5), element("poke_lids", "node", 4, 139.95, 35.9),
        element("power_plant", "node", 5, 140.03, 35.5, plant__source="solar; Nuclear", plant__output__electricity="1.2 GW"), element("power_plant", "node", 6, 139.1, 35.1, plant__output__electricity="9 MW"), element("onsen", "node", 7, 145.0, 45.0, name="湯"),
        element("pokemon_cafe", "node", 8, 139.6, 35.6),
    ])


@pytest.fixture(scope="module")
def poi(spark, poi_raw, prefecture, regions):
    seed = spark.createDataFrame([("tokyo", "カフェ", "Cafe", "住所", "139.6", "35.6", "osm:node/8"), ("x", "y", "z", None, "135.5", "34.5", None)], "cafe_id string, name_ja string, name_en string, address_ja string, lon string, lat string, coords_osm string")
    return curated.poi(poi_raw, seed, prefecture, regions.where("region_id = 'kanto'")).cache()


@pytest.fixture(scope="module")
def station(elements, prefecture):
    raw = elements("station", [element("station", "node", i, x, 35.5, name__ja=n, **t) for i, (n, x, t) in enumerate([("東京", 139.4, {"line": "山手線; 中央線"}), ("上野", 139.5, {}), ("大宮", 139.6, {}), ("大宮", 139.9, {})], 1)])
    return curated.station(raw, prefecture).cache()


@pytest.fixture(scope="module")
def rail(elements):
    return curated.rail(elements("rail", [element("rail_kanto", "way", 1, path=[(139.3, 35.5), (139.7, 35.5)]), element("shinkansen", "way", 1, path=[(139.3, 35.5), (139.7, 35.5)], name="新幹線"), element("rail_kanto", "way", 2, path=[(139, 35), (139.1, 35)]), element("rail_kanto", "way", 3, path=[(139, 35)])])).cache()


@pytest.fixture(scope="module")
def line_station(spark, station, rail):
    rows = [("a", "A", "full", "o", str(i), n) for i, n in enumerate(["東京", "上野", "大宮"], 1)] + [("b", "B", "full", "o", str(i), n) for i, n in enumerate(["上野", "東京"], 1)] + [("m", "M", "mini", "o", "1", "上野"), ("m", "M", "mini", "o", "2", "大宮"), ("m", "M", "mini", "o", "3", "なし")]
    seed = spark.createDataFrame([(*r, "https://s") for r in rows], "line_id string, line_name_ja string, kind string, operator string, seq string, station_name_ja string, source_url string")
    return curated.line_stations(seed, station, rail).cache()


def test_prefecture_and_regions(prefecture, regions):
    rows = {r.prefecture_code: r for r in conforms(prefecture, SILVER["prefecture"]).collect()}
    assert (rows["JP-13"].name_ja, rows["JP-13"].wikidata, rows["JP-13"].real_region_source) == ("東京都", "Q9", "natural_earth")
    assert (rows["JP-27"].real_region, rows["JP-27"].real_region_source) == ("Kinki", "seed") and 9_500 < rows["JP-13"].area_km2 < 10_500
    r = {r.region_id: r for r in regions.collect()}
    assert (r["kanto"].confidence, r["kanto"].real_region, r["kanto"].prefecture_codes, r["kanto"].generation) == ("teoría de fans", "Kanto + Kinki", ["JP-13", "JP-27"], 1)
    assert g.area_m2(g.read_wkb(r["kanto"].geometry)) > 1.9 * g.area_m2(g.read_wkb(r["johto"].geometry))


def test_points(poi, poi_raw):
    rows = {r.poi_id: r for r in conforms(poi, SILVER["poi"]).collect()}
    assert len(rows) == 9 and "osm:node/8" not in rows
    assert rows["osm:node/1"].category == "pokemon_center" and rows["osm:node/1"].game_region == "kanto"
    assert (rows["osm:node/5"].prefecture_method, rows["osm:node/5"].plant_output_mw) == ("nearest", 1200.0)
    assert rows["osm:node/7"].prefecture_code is None and rows["seed:x"].prefecture_code == "JP-27"
    assert tuple(dedup.dedup_counts(poi_raw, ["key"], "category").first()) == (10, 8, 1, 1)


def test_stations_and_rails(station, rail):
    rows = {r.station_id: r for r in conforms(station, SILVER["station"]).collect()}
    assert rows["osm:node/1"].lines == ["山手線", "中央線"] and rows["osm:node/2"].lines is None
    rows = {r.rail_id: r for r in conforms(rail, SILVER["rail"]).collect()}
    assert rows["osm:way/1"].kind == "shinkansen" and 9_000 < rows["osm:way/2"].length_m < 9_300 and len(rows) == 2


def test_buildings(elements):
    ring = [(139, 35), (139.01, 35), (139.01, 35.01), (139, 35.01), (139, 35)]
    hole = [(139.004, 35.004), (139.006, 35.004), (139.006, 35.006), (139.004, 35.006), (139.004, 35.004)]
    member = lambda role, line: {"type": "way", "ref": 1, "role": role, "geometry": [{"lon": x, "lat": y} for x, y in line]}
    raw = elements("building", [element("buildings", "way", 1, path=ring, building="yes", height="12 m", building__levels="3"), element("buildings", "way", 2, path=ring[:4], building="yes"), element("buildings", "relation", 3, members=[member("outer", ring[:3]), member("outer", ring[2:]), member("inner", hole)], building="yes", height="187", building__levels="52")])
    rows = {r.building_id: r for r in curated.building(raw).collect()}
    assert set(rows) == {"osm:way/1", "osm:relation/3"} and (rows["osm:way/1"].height_m, rows["osm:relation/3"].levels) == (12.0, 52)
    assert g.area_m2(g.read_wkb(rows["osm:relation/3"].geometry)) < 0.97 * g.area_m2(g.read_wkb(rows["osm:way/1"].geometry))


def test_route_stops(spark, elements, station):
    member = lambda ref, role: {"type": "node", "ref": ref, "role": role}
    raw = elements("routes", [element("shinkansen_routes", "relation", 9, members=[member(1, "stop"), member(2, "platform"), member(3, "stop_exit_only")], name="R")])
    nodes = spark.createDataFrame([("osm:node/1", 139.401, 35.5), ("osm:node/2", 139.5, 35.5), ("osm:node/3", 139.8, 35.5)], "node string, lon double, lat double")
    rows = conforms(curated.route_stops(raw, nodes, station), SILVER["shinkansen_route_stop"]).orderBy("stop_order").collect()
    assert [(r.stop_order, r.station_id, r.name_ja) for r in rows] == [(1, "osm:node/1", "東京"), (2, None, None)]


def test_network(line_station):
    rows = {(r.line_id, r.seq): r for r in line_station.collect()}
    assert (rows["a", 3].station_id, rows["a", 3].match_method, rows["a", 3].candidates) == ("osm:node/3", "track", 2)
    assert rows["m", 2].match_method == "sequence" and rows["m", 3].station_id is None
    edges = {r.edge_id: r for r in conforms(derived.shinkansen_edges(line_station.where("station_id IS NOT NULL")), GOLD["shinkansen_edges"]).collect()}
    assert len(edges) == 2 and any(r.lines == ["a", "b"] and r.kind == "full" for r in edges.values()) and any(r.lines == ["a", "m"] for r in edges.values())
    hubs = conforms(derived.shinkansen_stations(line_station.where("station_id IS NOT NULL")), GOLD["shinkansen_stations"])
    assert {r.name_ja: r.lines for r in hubs.collect()} == {"東京": ["a", "b"], "上野": ["a", "b", "m"], "大宮": ["a", "m"]}


def test_choose():
    near, far = ("b", 1.0, 0.0, 5.0), ("a", 0.0, 0.0, 9.0)
    assert choose([], "full", None) == (None, None) and choose([near], "mini", None) == (near, "unique")
    assert choose([far, near], "full", (0.0, 0.0)) == (near, "track") and choose([far, near], "mini", (0.0, 0.0)) == (far, "sequence")
    assert choose([far, near], "mini", None) == (near, "track") and choose([("b", 0, 0, None), ("a", 1, 1, None)], "full", None)[0][0] == "a"


def test_derived_points(poi, station, line_station):
    clusters = {r.cluster_id.split(":")[0]: r for r in conforms(derived.poi_clusters(poi), GOLD["poi_clusters"]).collect()}
    assert clusters["poke_lids"].member_count == 2 and clusters["poke_lids"].prefecture_codes == ["JP-13"]
    plants = conforms(derived.power_plants(poi), GOLD["power_plants_kanto"]).collect()
    assert [(r.poi_id, r.reason) for r in plants] == [("osm:node/5", "source+capacity")]
    nearest = conforms(derived.center_nearest_station(poi, station), GOLD["center_nearest_station"]).collect()
    assert [(r.station_id, round(r.distance_m)) for r in nearest] == [("osm:node/2", 0)]
    hubs = derived.shinkansen_stations(line_station.where("station_id IS NOT NULL"))
    assert [r.station_key for r in conforms(derived.center_to_shinkansen(poi, hubs), GOLD["center_to_shinkansen"]).collect()] == ["shinkansen:上野"]


def test_places_base_map_and_metrics(spark, poi, rail, prefecture):
    seed = spark.createDataFrame([("pallet", "Pallet", "kanto", "Shimoda", "Q1", "JP-13", "139.5", "35.5", "oficial", "https://a", "https://b; https://c", None)], "place_id string, game_name string, region_id string, real_place string, real_place_wikidata string, prefecture_code string, lat string, lon string, confidence string, source_url string, other_sources string, notes string")
    assert curated.game_place(seed.withColumns({"lon": F.col("lat"), "lat": F.col("lon")})).first().other_sources == ["https://b", "https://c"]
    own = spark.createDataFrame([("unova", "Unova", "New York", "Q60", "oficial", "https://a", "-74.0", "40.7")], "region_id string, game_name string, real_place string, real_place_wikidata string, confidence string, source_url string, lon string, lat string")
    based = spark.createDataFrame([("Q5", "Q142", "France", "Francia", "Point(2.3 48.9)"), ("Q6", "Q60", "New York", None, "Point(-74 40)"), ("Q7", "Q9", "x", None, None)], "region string, based_on string, based_on_en string, based_on_es string, coord string")
    labels = spark.createDataFrame([("Q5", "Kalos"), ("Q6", "Unova"), ("Q7", "Galar")], "region string, name_en string")
    games = spark.createDataFrame([("5", "g", "2010-09-18T00:00:00Z"), ("5", "h", "2011-01-01T00:00:00Z"), ("6", "i", "2013-10-12T00:00:00Z")], "generation string, game string, first_release string")
    generations = spark.createDataFrame([("unova", 5), ("kalos", 6)], "region_id string, generation int")
    rows = {r.region_id: r for r in conforms(curated.outside_region(own, based, labels, games, generations), SILVER["outside_region"]).collect()}
    assert (rows["kalos"].real_place, rows["kalos"].year, rows["unova"].year) == ("Francia", 2013, 2010) and rows["unova"].license.endswith("LicenseRef-factual-data")
    coast = spark.createDataFrame([(1, "Coastline", "1", square(130, 31)), (2, "Null island", "1", square(0, 0))], "row bigint, featurecla string, scalerank string, geometry binary")
    deep = spark.createDataFrame([(1, "200", square(100, 10))], "row bigint, DEPTH string, geometry binary")
    base = curated.basemap({"coastline": coast, "bathymetry": deep})
    assert sorted((r.feature_id, r.depth_m) for r in conforms(base, SILVER["basemap"]).collect()) == [("bathymetry:1", 200), ("coastline:1", None)]
    assert [r.layer for r in derived.day_view(spark, 26, {"basemap": base}).collect()] == ["coastline"]
    from meridia.functions import hexgrid

    cells = spark.createDataFrame([(139.5, 35.5, 100.0), (139.5, 35.5005, 50.0)], "lon double, lat double, population double").select(hexgrid.cell_of(F.col("lon"), F.col("lat"), 8).alias("h3"), "population")
    light = spark.createDataFrame([(139.01 + i * 0.002, 35.01, None if i % 2 else 20.0, i == 0) for i in range(20)], "lon double, lat double, value double, poor boolean")
    metric = conforms(curated.grid_metric(cells, light, poi, rail, prefecture), SILVER["h3_metric"]).cache()
    total = {(r.metric, r.resolution): r for r in metric.groupBy("metric", "resolution").agg(F.sum("value").alias("v"), F.min("coverage").alias("c"), F.bool_and("is_proxy").alias("p"), F.sort_array(F.collect_set("value")).alias("s")).collect()}
    assert total["population", 8].v == total["population", 7].v == 150 and total["poi_density", 7].v == 6
    assert total["night_light", 7].s == [20.0] and total["shinkansen_sound_proxy", 9].s == [0.0, 1.0, 2.0] and total["shinkansen_sound_proxy", 9].p
    assert metric.where("prefecture_code = 'JP-13'").count() > 0


def test_views_findings_and_viewshed(spark, poi, rail, station, prefecture, regions):
    summary = derived.osm_summary(poi, rail, station, rail.limit(2), station.limit(1))
    assert {(r.layer, r.category): r.elements for r in summary.collect()}[("poi", "poke_lids")] == 3
    report = {"coverage": [{"id": "a", "title": "t", "value": 1, "total": 2, "share": 0.5, "source": "s", "detail": None}], "informative": {"null_rates": {"poi": {"name_en": {"by": {"JP-13": {"rows": 2, "nulls": 1, "rate": 0.5}}}}}}}
    assert derived.null_findings(spark, report, 1).count() == 2
    assert derived.null_rates_by_prefecture(spark, report, SILVER).first().null_count == 1
    mask = np.zeros((10, 10), np.uint8)
    mask[2:5, 2:5] = 255
    area = conforms(derived.viewshed_area(spark, "summit", mask, 138.0, 36.0, 0.01, 0.01, "line of sight", "n", "L"), GOLD["fuji_viewshed"]).first()
    assert area.visible_share == 0.09 and g.read_wkb(area.geometry).kind == "POLYGON"
    tables = {"poi": poi, "rail": rail, "game_region": regions, "prefecture": prefecture, "osm_summary": summary}
    for day, rows in ((1, 4), (2, 2), (3, 4), (15, 0), (19, 1), (21, 9), (22, 2), (23, 2), (30, 4)):
        assert derived.day_view(spark, day, tables).count() == rows, day
    assert len(derived.DAYS) == 24


def test_coverage_findings(spark, poi, poi_raw, rail, station, elements):
    seed = spark.createDataFrame([("osm:node/8",), (None,)], "coords_osm string")
    stop = spark.createDataFrame([("東海道新幹線 (下り)",), ("東海道新幹線 (上り)",), (None,)], "route_name string")
    light = spark.createDataFrame([("night_light", 8, None, "JP-13"), ("night_light", 8, None, None), ("night_light", 8, None, None), ("night_light", 8, 1.0, "JP-13"), ("population", 8, None, "JP-13")], "metric string, resolution int, value double, prefecture_code string")
    tables = {
        "poi": poi, "rail": rail, "station": station, "poi_counts": curated.poi_counts(poi_raw, seed), "shinkansen_route_stop": stop, "h3_metric": light,
        "building": spark.createDataFrame([(1.0, None), (None, 2), (3.0, None)], "height_m double, levels int"),
        "game_places": spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "place string, based_on string"),
        "game_regions": spark.createDataFrame([("Q1", "Kanto"), ("Q2", "Orre"), ("Q3", "Fiore")], "region string, name_en string"),
        "based_regions": spark.createDataFrame([("Q1",), ("Q1",)], "region string"),
        "dishes": spark.createDataFrame([("d", "JP-01"), ("d", "JP-02"), ("e", None)], "dish string, iso string"),
        "coverage_references": spark.createDataFrame([("poke_lids_total", "400", "n", "2026", "https://a")], "reference_id string, value string, notes string, as_of string, source_url string"),
    }
    told = {f["id"]: f for f in (fact(tables) for fact in findings.available(tables))}
    assert len(told) == len(findings.FACTS) == 12
    figures = {k: (f["value"], f["total"]) for k, f in told.items()}
    assert figures["wikidata_p144_places"] == (1, 2) and figures["wikidata_p144_regions"] == (1, 3) and told["wikidata_p144_regions"]["detail"] == "Sin P144: Fiore, Orre."
    assert figures["osm_pokemon_cafe_brand"] == (1, 2) and figures["osm_center_store_brand"] == (1, None) and figures["osm_station_lines"] == (1, 4)
    assert figures["osm_building_height"] == (2, 3) and figures["osm_building_levels"] == (1, 3) and figures["osm_poke_lids"] == (3, 400)
    assert figures["points_without_prefecture"] == (1, None) and told["points_without_prefecture"]["detail"].startswith("0 en las Kuriles")
    assert figures["osm_shinkansen_routes"] == (1, 1) and "東海道新幹線." in told["osm_shinkansen_routes"]["detail"]
    assert figures["wikidata_regional_dishes"] == (2, 47) and told["wikidata_regional_dishes"]["detail"].startswith("1 de 2 platos") and "ninguno: JP-03, JP-04" in told["wikidata_regional_dishes"]["detail"]
    assert figures["viirs_night_light_null"] == (3, 4) and told["viirs_night_light_null"]["detail"].endswith("(sin prefectura): 2, JP-13: 1")
    empty = {k: df.limit(0) for k, df in tables.items() if k != "coverage_references"}
    assert {f["value"] for f in (fact(empty) for fact in findings.available(empty))} <= {0, None}
