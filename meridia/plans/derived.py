"""The derived tables and the day views over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridia.functions import geometry, hexgrid
from meridia.functions.points import haversine_m
from meridia.functions.topology import Topology, buffered_hulls, per_group
from meridia.operators import graph, spatial
from meridia.plans import settings as S
from meridia.plans.curated import with_xy


def _segment(a: str, b: str) -> Column:
    """A line between two point geometries."""

    def run(p: bytes, q: bytes) -> bytes:
        ends = [geometry.read_wkb(v).coordinates()[0] for v in (p, q)]
        return geometry.write_wkb(geometry.Geometry("LINESTRING", [[ends]]))

    return geometry.arrow_rows("binary", run)(a, b)


def poi_clusters(poi: DataFrame) -> DataFrame:
    """Clusters of points in cells within two steps of each other, with a buffered hull."""
    out = None
    for layer, categories in S.CLUSTER_LAYERS.items():
        points = with_xy(poi.where(F.col("category").isin(*categories)))
        around = F.transform(hexgrid.disk(F.col("h3_r7"), S.CLUSTER_RING, 7), lambda d: d["cell"])
        clusters, placed = graph.cell_clusters(points, "poi_id", "h3_r7", around)
        members = placed.join(points.select("poi_id", "prefecture_code", "lon", "lat"), "poi_id").join(clusters.select("component"), "component", "left_semi")
        codes = members.groupBy("component").agg(F.array_sort(F.collect_set("prefecture_code")).alias("prefecture_codes"))
        shapes = buffered_hulls(members, "component", "lon", "lat", S.CLUSTER_MARGIN)
        part = clusters.join(codes, "component").join(shapes, "component").select(F.concat(F.lit(f"{layer}:"), "component").alias("cluster_id"), F.lit(layer).alias("layer"), F.col("member_count").cast("int").alias("member_count"), "members", "prefecture_codes", F.lit(S.MAP_LICENSE).alias("license"), "geometry")
        out = part if out is None else out.unionByName(part)
    return out


def viewshed_area(spark: SparkSession, product_id: str, mask, west: float, north: float, dx: float, dy: float, method: str, notice: str, license: str) -> DataFrame:
    """One row: the visible share and the outline of a viewshed mask, simplified."""
    from meridia.raster.relief import outlines

    t = Topology(spark)
    squares = [geometry.write_wkb(g) for g in outlines(mask == 255, west, north, dx, dy)]
    shape = t.simplify(t.union(squares), S.SIMPLIFY_DEGREES) if squares else None
    return spark.createDataFrame([(product_id, float((mask == 255).mean()), method, notice, license, bytearray(shape) if shape else None)], "product_id string, visible_share double, method string, notice string, license string, geometry binary")


def power_plants(poi: DataFrame, region: str = "kanto") -> DataFrame:
    pattern = rf"(^|;)\s*({'|'.join(S.PLANT_SOURCES)})\s*(;|$)"
    by_source = F.coalesce(F.lower("plant_source").rlike(pattern), F.lit(False))
    by_capacity = F.coalesce(F.col("plant_output_mw") >= S.PLANT_MEGAWATTS, F.lit(False))
    reason = F.when(by_source & by_capacity, "source+capacity").when(by_source, "source").otherwise("capacity")
    wanted = poi.where((F.col("category") == "power_plant") & (F.col("game_region") == region) & (by_source | by_capacity))
    return wanted.select("poi_id", "name_ja", "name_en", "plant_source", "plant_output_mw", reason.alias("reason"), "prefecture_code", "license", "geometry")


def center_nearest_station(poi: DataFrame, station: DataFrame) -> DataFrame:
    c = with_xy(poi.where(F.col("category") == "pokemon_center")).select("poi_id", F.col("name_ja").alias("center_name"), "game_region", F.col("geometry").alias("a"), "lon", "lat")
    s = with_xy(station).select("station_id", F.col("name_ja").alias("station_name"), F.col("geometry").alias("b"), F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    best = spatial.nearest_within(c, s, "poi_id", "station_id", S.CENTER_DEGREES, ("lon", "lat"), ("s_lon", "s_lat"))
    return best.join(c, "poi_id").join(s, "station_id").select("poi_id", "center_name", "station_id", "station_name", "distance_m", "game_region", F.lit(S.MAP_LICENSE).alias("license"), _segment("a", "b").alias("geometry"))


def shinkansen_stations(line_station: DataFrame) -> DataFrame:
    first = F.min_by("geometry", "station_id")
    kind = F.when(F.bool_and(F.col("kind") == "mini"), "mini").otherwise("full")
    t = line_station.groupBy("name_ja").agg(F.min("station_id").alias("station_id"), F.array_sort(F.collect_set("line_id")).alias("lines"), kind.alias("kind"), F.min("prefecture_code").alias("prefecture_code"), first.alias("geometry"))
    return t.select(F.concat(F.lit("shinkansen:"), "name_ja").alias("station_key"), "station_id", "name_ja", "lines", "kind", "prefecture_code", F.lit(S.SEED_LICENSE).alias("license"), "geometry")


def shinkansen_edges(line_station: DataFrame) -> DataFrame:
    """Edges between neighbours of each line, once for all lines that share them.

    Where a name has several places, those of the first line are used.
    """
    w = Window.partitionBy("line_id").orderBy("seq")
    nxt = line_station.select("line_id", "kind", "name_ja", "geometry", F.lead("name_ja").over(w).alias("n2"), F.lead("geometry").over(w).alias("g2")).where("n2 IS NOT NULL")
    ahead = F.col("name_ja") < F.col("n2")
    pairs = nxt.select(F.least("name_ja", "n2").alias("a"), F.greatest("name_ja", "n2").alias("b"), "line_id", "kind", F.when(ahead, F.col("geometry")).otherwise(F.col("g2")).alias("ga"), F.when(ahead, F.col("g2")).otherwise(F.col("geometry")).alias("gb"))
    mini = F.bool_and(F.col("kind") == "mini")
    e = pairs.groupBy("a", "b").agg(F.array_sort(F.collect_set("line_id")).alias("lines"), mini.alias("schematic"), F.min_by("ga", "line_id").alias("ga"), F.min_by("gb", "line_id").alias("gb"))
    p, q = geometry.envelope("ga"), geometry.envelope("gb")
    e = e.withColumns({"p": p, "q": q})
    far = haversine_m(F.col("p.west"), F.col("p.south"), F.col("q.west"), F.col("q.south")) / 1000
    key = lambda c: F.concat(F.lit("shinkansen:"), c)
    return e.select(F.concat(key("a"), F.lit("|"), key("b")).alias("edge_id"), key("a").alias("from_key"), key("b").alias("to_key"), "lines", F.when(F.col("schematic"), "mini").otherwise("full").alias("kind"), "schematic", far.alias("distance_km"), F.lit(S.SEED_LICENSE).alias("license"), _segment("ga", "gb").alias("geometry"))


def center_to_shinkansen(poi: DataFrame, hubs: DataFrame) -> DataFrame:
    c = with_xy(poi.where(F.col("category") == "pokemon_center")).select("poi_id", F.col("name_ja").alias("center_name"), F.col("geometry").alias("a"), "lon", "lat")
    h = with_xy(hubs).select("station_key", F.col("name_ja").alias("station_name"), F.col("geometry").alias("b"), F.col("lon").alias("h_lon"), F.col("lat").alias("h_lat"))
    best = spatial.nearest_of_few(c, h, "poi_id", "station_key", ("lon", "lat"), ("h_lon", "h_lat"))
    return best.join(c, "poi_id").join(h, "station_key").select("poi_id", "center_name", "station_key", "station_name", (F.col("distance_m") / 1000).alias("distance_km"), F.lit(S.MAP_LICENSE).alias("license"), _segment("a", "b").alias("geometry"))


#: The license of what is told from the quality report, and the finding on the base map's left-out point.
REPORT_LICENSE = "LicenseRef-quality-report"
NULL_ISLAND = ("natural_earth_null_island", "Null Island en Natural Earth", "natural_earth", "Elemento ficticio en 0°, 0° (featurecla = 'Null island') en las capas de costas y tierra; se excluye del mapa base.")


def null_findings(spark: SparkSession, report: Mapping, null_island: int, license: str = REPORT_LICENSE) -> DataFrame:
    """The report's findings on coverage, and the base map's left-out point."""
    rows = [(f["id"], f["title"], f["value"], f["total"], f["share"], f["source"], f["detail"], license) for f in report["coverage"]]
    name, title, source, detail = NULL_ISLAND
    rows.append((name, title, null_island, None, None, source, detail, license))
    return spark.createDataFrame(rows, "finding_id string, title string, value bigint, total bigint, share double, source string, detail string, license string")


def null_rates_by_prefecture(spark: SparkSession, report: Mapping, contracts: Mapping, license: str = REPORT_LICENSE) -> DataFrame:
    """The report's null rates of tables that group them by prefecture, as rows."""
    rows = [(e, c, g, f["rows"], f["nulls"], f["rate"], license) for e, columns in report["informative"]["null_rates"].items() if contracts[e].null_report_by == "prefecture_code" for c, own in columns.items() for g, f in own["by"].items()]
    return spark.createDataFrame(rows, "entity string, column_name string, prefecture_code string, row_count bigint, null_count bigint, rate double, license string")


def osm_summary(poi: DataFrame, rail: DataFrame, station: DataFrame, building: DataFrame, route_stop: DataFrame) -> DataFrame:
    one = lambda df, layer, category: df.agg(F.count("*").alias("elements")).select(F.lit(layer).alias("layer"), F.lit(category).alias("category"), "elements")
    t = poi.where(F.col("source") == "osm").groupBy("category").count().select(F.lit("poi").alias("layer"), "category", F.col("count").alias("elements"))
    t = t.union(rail.groupBy("kind").count().select(F.lit("rail"), "kind", "count"))
    for df, layer, category in ((station, "station", "station"), (building, "building", "building"), (route_stop, "shinkansen_route_stop", "stop")):
        t = t.union(one(df, layer, category))
    return t.select("layer", "category", "elements", F.lit(S.ATTRIBUTION).alias("attribution"), F.lit(S.MAP_LICENSE).alias("license"))


def intersecting(df: DataFrame, shape: bytes) -> DataFrame:
    """Rows whose geometry meets one shape, tested by envelope first."""
    west, south, east, north = geometry.read_wkb(shape).envelope()
    box = geometry.envelope("geometry")
    near = df.withColumn("_b", box).where((F.col("_b.west") <= east) & (F.col("_b.east") >= west) & (F.col("_b.south") <= north) & (F.col("_b.north") >= south)).drop("_b")
    return near.withColumn("_s", F.lit(bytearray(shape))).where(geometry.shapes_intersect("geometry", "_s")).drop("_s")


#: The views that are plain SQL over the tables, by day; their names, columns, aliases and literals are published.
VIEWS = {
    1: "SELECT poi_id, category, name_ja, name_en, name_es, prefecture_code, game_region, geometry FROM poi WHERE category IN ('pokemon_center', 'poke_lids')",
    3: "SELECT 'game_region' AS layer, region_id AS id, name_ja, name_en, name_es, confidence, geometry FROM game_region UNION ALL SELECT 'prefecture', prefecture_code, name_ja, name_en, name_es, NULL, geometry FROM prefecture",
    4: "SELECT cluster_id, layer, member_count, members, prefecture_codes, geometry FROM poi_clusters",
    5: "SELECT product_id, visible_share, method, notice, geometry FROM fuji_viewshed",
    8: "SELECT 'game_place' AS layer, place_id AS id, game_name, region_id, real_place, confidence, source_url, geometry FROM game_place UNION ALL SELECT 'game_region', region_id, game_name, region_id, real_region, confidence, source_urls[0], geometry FROM game_region",
    9: "SELECT h.h3, h.value AS population, h.prefecture_code, r.region_id AS game_region FROM h3_metric h LEFT JOIN (SELECT explode(prefecture_codes) AS prefecture_code, region_id FROM game_region) r ON h.prefecture_code = r.prefecture_code WHERE h.metric = 'population' AND h.resolution = 7",
    11: "SELECT h3, value AS rings_from_track, is_proxy, prefecture_code FROM h3_metric WHERE metric = 'shinkansen_sound_proxy'",
    12: "SELECT * FROM power_plants_kanto",
    13: "SELECT * FROM center_nearest_station",
    14: "SELECT building_id, building, name, height_m, levels, geometry FROM building",
    15: "SELECT region_id, name_ja, name_en, name_es, real_region, geometry FROM game_region WHERE region_id = 'sinnoh'",
    17: "SELECT h3, value AS radiance, coverage, poor_quality_share, prefecture_code FROM h3_metric WHERE metric = 'night_light' AND resolution = 7",
    18: "SELECT 'finding' AS kind, finding_id AS id, title, value, total, share, source, detail, CAST(NULL AS STRING) AS prefecture_code FROM null_findings UNION ALL SELECT 'null_rate', concat(entity, '.', column_name), column_name, null_count, row_count, rate, entity, NULL, prefecture_code FROM null_rates_by_prefecture",
    19: "SELECT poi_id, name_ja, name_en, prefecture_code, game_region, game_region = 'hoenn' AS in_hoenn, geometry FROM poi WHERE category = 'onsen'",
    20: "SELECT h3, value AS pokemon_points, prefecture_code FROM h3_metric WHERE metric = 'poi_density'",
    21: "SELECT * FROM osm_summary",
    22: "SELECT prefecture_code, name_ja, name_en, name_es, real_region, area_km2, geometry FROM prefecture",
    23: "SELECT poi_id, name_ja, name_en, address_ja, prefecture_code, game_region, geometry FROM poi WHERE category = 'pokemon_cafe'",
    24: "SELECT 'station' AS layer, station_key AS id, name_ja AS name, kind, array_join(lines, ' / ') AS detail, false AS schematic, CAST(NULL AS DOUBLE) AS distance_km, geometry FROM shinkansen_stations UNION ALL SELECT 'edge', edge_id, concat(from_key, ' - ', to_key), kind, array_join(lines, ' / '), schematic, distance_km, geometry FROM shinkansen_edges UNION ALL SELECT 'center_link', poi_id, center_name, NULL, station_name, false, distance_km, geometry FROM center_to_shinkansen",
    28: "SELECT region_id, game_name, generation, year, confidence, 'japan' AS where_, geometry FROM game_region UNION ALL SELECT region_id, game_name, generation, year, confidence, 'outside', geometry FROM outside_region",
    29: "SELECT product_id, aoi, path, width, height, notice, geometry FROM raster_product WHERE kind = 'hillshade'",
    30: "SELECT 'game_region' AS layer, region_id AS id, name_en, geometry FROM game_region UNION ALL SELECT 'prefecture', prefecture_code, name_en, geometry FROM prefecture",
}


def day_view(spark: SparkSession, day: int, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The view of a day over the named tables."""
    if day == 2:
        shape = tables["game_region"].where(F.col("region_id") == "kanto").select("geometry").first()
        found = intersecting(tables["rail"], bytes(shape[0]))
        return found.select("rail_id", "kind", (F.col("kind") == "shinkansen").alias("highlight"), "name_ja", "name_en", "operator", "length_m", "geometry")
    if day == 26:
        west, south, east, north = S.WATERS
        box = geometry.write_wkb(geometry.read_wkt(f"POLYGON (({west} {south}, {east} {south}, {east} {north}, {west} {north}, {west} {south}))"))
        return intersecting(tables["basemap"].where(F.col("layer").isin("bathymetry", "coastline")), box).select("layer", "feature_id", "depth_m", "geometry")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(VIEWS[day])


DAYS = tuple(sorted([*VIEWS, 2, 26]))
