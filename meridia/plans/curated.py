"""The curated tables, each a function of DataFrames: no action but where topology needs the driver.

Elements are tables as ``sources.readers.read_elements`` gives them; places are
``prefecture`` tables with WKB geometry. Cells are those of
``functions.hexgrid``. Writing, checking and lineage are the runner's part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridia.functions import geometry, hexgrid, text
from meridia.functions.points import planar_distance, point_from_wkt
from meridia.functions.topology import Topology, per_group, union_by
from meridia.operators import dedup, matching, spatial
from meridia.plans import settings as S
from meridia.sources.readers import element_point, tag


def point_wkb(lon: Column, lat: Column) -> Column:
    return geometry.arrow_rows("binary", lambda x, y: geometry.write_wkb(geometry.Geometry("POINT", [[[[x, y]]]])))(lon, lat)


def elements(raw: DataFrame, precedence: Sequence[str] = ()) -> DataFrame:
    """One row for each element: of its categories the first by precedence. ``operators.dedup.dedup_counts`` counts the rest."""
    # tags are a map, which has no order: the survivor's other fields are ordered by their JSON text
    keyed = raw.select("key", "category", F.to_json(F.struct("*")).alias("json"), F.struct("*").alias("e"))
    first = F.min_by("e", F.struct(dedup.rank_of("category", precedence) if precedence else F.lit(0), F.col("category"), F.col("json")))
    return keyed.groupBy("key").agg(first.alias("e")).select("e.*")


def name_local() -> Column:
    return F.coalesce(tag("name:ja"), tag("name"))


def assign_prefecture(points: DataFrame, prefecture: DataFrame, key: str) -> DataFrame:
    """key, prefecture_code, prefecture_method for points (lon, lat) within a polygon or on its boundary, or near one; others are absent.

    Candidates meet on grid cells of the polygons' envelopes; only they are tested exactly.
    """
    boxes = prefecture.select("prefecture_code", "geometry", geometry.envelope("geometry").alias("b")).select("prefecture_code", "geometry", "b.*")
    near = spatial.box_candidates(points.select(key, "lon", "lat"), boxes, 1.0, S.NEAREST_DEGREES)
    tested = near.select(key, F.struct(geometry.distance_to("geometry", "lon", "lat").alias("d"), "prefecture_code").alias("b")).where(F.col("b.d") <= S.NEAREST_DEGREES)
    best = tested.groupBy(key).agg(F.min("b").alias("b"))
    return best.select(key, "b.prefecture_code", F.when(F.col("b.d") == 0, "within").otherwise("nearest").alias("prefecture_method"))


def prefecture(admin: DataFrame, labels: DataFrame, regions: DataFrame, country: str = "JPN") -> DataFrame:
    """From admin polygons, query bindings (iso, prefecture, names) and the hand-made regions."""
    topology = Topology(admin.sparkSession)
    own = admin.where(F.col("adm0_a3") == country).select(F.col("iso_3166_2").alias("prefecture_code"), F.col("name_ja").alias("own_ja"), F.col("name").alias("own_en"), F.col("region").alias("own_region"), F.col("wikidataid").alias("own_id"), "geometry")
    fixed = per_group(own, "prefecture_code", "geometry", lambda shapes: topology.make_valid(shapes[0]))
    names = labels.groupBy(F.col("iso").alias("prefecture_code")).agg(F.min("prefecture").alias("qid"), *(F.min(c).alias(c) for c in ("name_ja", "name_en", "name_es")))
    joined = own.drop("geometry").join(fixed, "prefecture_code").join(names, "prefecture_code", "left").join(regions.select("prefecture_code", "real_region"), "prefecture_code", "left")
    return joined.select(
        "prefecture_code", F.coalesce("name_ja", "own_ja").alias("name_ja"), F.coalesce("name_en", "own_en").alias("name_en"), "name_es", F.coalesce("own_region", "real_region").alias("real_region"),
        F.when(F.col("own_region").isNull(), "seed").otherwise("natural_earth").alias("real_region_source"), F.coalesce("qid", "own_id").alias("wikidata"), geometry.area_km2("geometry").alias("area_km2"), F.lit("CC0-1.0").alias("license"), "geometry",
    )


def game_region(seed: DataFrame, labels: DataFrame, places: DataFrame) -> DataFrame:
    """Regions as unions of prefectures; the lowest confidence of their rows is the region's."""
    ranked = seed.withColumn("rank", text.lookup(F.col("confidence"), S.CONFIDENCE)).where("rank IS NOT NULL").join(places.select("prefecture_code", "geometry"), "prefecture_code")
    facts = ranked.groupBy("region_id").agg(
        F.min("game_name").alias("game_name"), F.min(F.col("generation").cast("int")).alias("generation"), F.min(F.col("year").cast("int")).alias("year"), F.array_join(F.array_sort(F.collect_set("real_region")), " + ").alias("real_region"),
        F.min("rank").alias("rank"), F.array_sort(F.collect_set("prefecture_code")).alias("prefecture_codes"), F.array_sort(F.collect_set("source_url")).alias("source_urls"),
    )
    shapes = union_by(ranked.select("region_id", "geometry"), "region_id")
    confidence = text.lookup(F.col("rank"), {v: k for k, v in S.CONFIDENCE.items()})
    named = labels.select(F.lower("name_en").alias("region_id"), "name_ja", "name_en", "name_es")
    return facts.join(shapes, "region_id").join(named, "region_id", "left").select("region_id", "game_name", "name_ja", "name_en", "name_es", "real_region", "generation", "year", confidence.alias("confidence"), "prefecture_codes", "source_urls", F.lit("LicenseRef-seeds + CC0-1.0").alias("license"), "geometry")


def game_place(seed: DataFrame) -> DataFrame:
    lon, lat = F.col("lon").cast("double"), F.col("lat").cast("double")
    own = ("place_id", "game_name", "region_id", "real_place", "real_place_wikidata", "prefecture_code", "confidence", "source_url")
    return seed.select(*own, F.coalesce(text.split_list(F.col("other_sources")), F.array().cast("array<string>")).alias("other_sources"), "notes", hexgrid.cell_of(lon, lat, 7).alias("h3_r7"), hexgrid.cell_of(lon, lat, 9).alias("h3_r9"), F.lit("LicenseRef-seeds").alias("license"), point_wkb(lon, lat).alias("geometry"))


def outside_region(seed: DataFrame, based_on: DataFrame, labels: DataFrame, games: DataFrame, generations: DataFrame) -> DataFrame:
    """Hand-made rows first, then those of the query; years are the first release of the generation."""
    point = point_from_wkt(F.col("coord"))
    theory = next(iter(S.CONFIDENCE))
    found = based_on.join(labels.select("region", "name_en"), "region").where(F.lower("name_en").isin(*S.OUTSIDE_REGIONS) & F.col("coord").isNotNull())
    found = found.select(F.lower("name_en").alias("region_id"), F.col("name_en").alias("game_name"), F.coalesce("based_on_es", "based_on_en").alias("real_place"), F.col("based_on").alias("real_place_wikidata"), F.lit(theory).alias("confidence"), F.concat(F.lit("https://www.wikidata.org/wiki/"), "region", F.lit("#P144")).alias("source_url"), F.lit("CC0-1.0").alias("license"), point["lon"].alias("lon"), point["lat"].alias("lat"))
    own = seed.select("region_id", "game_name", "real_place", "real_place_wikidata", "confidence", "source_url", F.lit("LicenseRef-seeds + CC0-1.0").alias("license"), F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    years = games.groupBy(F.col("generation").cast("int").alias("generation")).agg(F.min(F.year(F.to_timestamp("first_release"))).alias("year"))
    joined = dedup.priority_union(own, found, "region_id").join(generations.select("region_id", F.col("generation").cast("int").alias("generation")), "region_id").join(years, "generation", "left")
    return joined.select("region_id", "game_name", "generation", "year", "real_place", "real_place_wikidata", "confidence", "source_url", F.concat("license", F.lit(S.FACTS)).alias("license"), point_wkb(F.col("lon"), F.col("lat")).alias("geometry"))


def poi(raw: DataFrame, seed: DataFrame, places: DataFrame, regions: DataFrame) -> DataFrame:
    """Points of interest: map elements, the hand-made ones in place of theirs, with prefecture, region and cells."""
    e = elements(raw, S.POINT_PRECEDENCE).withColumn("category", text.by_prefix(name_local(), F.col("category"), S.BY_NAME)).withColumn("p", element_point())
    plant = F.col("category") == "power_plant"
    none = F.lit(None).cast("string")
    mapped = e.select(F.concat(F.lit("osm:"), "key").alias("poi_id"), F.lit("osm").alias("source"), F.col("key").alias("source_id"), "category", name_local().alias("name_ja"), tag("name:en").alias("name_en"), tag("name:es").alias("name_es"), F.when(plant, tag("plant:source")).alias("plant_source"), F.when(plant, text.power_mw(tag("plant:output:electricity"))).alias("plant_output_mw"), none.alias("address_ja"), F.lit(S.MAP_LICENSE).alias("license"), "p.lon", "p.lat")
    # a left anti join keeps rows when a reference is null, where NOT IN would drop them all
    mapped = mapped.join(seed.select(F.col("coords_osm").alias("poi_id")), "poi_id", "left_anti").select(mapped.columns)
    made = seed.select(F.concat(F.lit("seed:"), "cafe_id").alias("poi_id"), F.lit("seed").alias("source"), F.col("cafe_id").alias("source_id"), F.lit("pokemon_cafe").alias("category"), "name_ja", "name_en", none.alias("name_es"), none.alias("plant_source"), F.lit(None).cast("double").alias("plant_output_mw"), "address_ja", F.lit(S.SEED_LICENSE).alias("license"), F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    points = mapped.unionByName(made)
    region = regions.select(F.explode("prefecture_codes").alias("prefecture_code"), F.col("region_id").alias("game_region"))
    joined = points.join(assign_prefecture(points, places, "poi_id"), "poi_id", "left").join(region, "prefecture_code", "left")
    lon, lat = F.col("lon"), F.col("lat")
    return joined.select("poi_id", "source", "source_id", "category", "name_ja", "name_en", "name_es", "plant_source", "plant_output_mw", "address_ja", "prefecture_code", "prefecture_method", "game_region", hexgrid.cell_of(lon, lat, 7).alias("h3_r7"), hexgrid.cell_of(lon, lat, 9).alias("h3_r9"), "license", point_wkb(lon, lat).alias("geometry"))


def poi_counts(raw: DataFrame, seed: DataFrame) -> DataFrame:
    """One row: elements that hand-made points replace, and those whose name changes their category."""
    e = elements(raw, S.POINT_PRECEDENCE).select(F.concat(F.lit("osm:"), "key").alias("poi_id"), "category", text.by_prefix(name_local(), F.col("category"), S.BY_NAME).alias("named"))
    own = seed.select(F.col("coords_osm").alias("poi_id"), F.lit(True).alias("own")).where("poi_id IS NOT NULL").distinct()
    return e.join(own, "poi_id", "left").agg(F.count("own").alias("replaced"), F.count_if(F.col("named") != F.col("category")).alias("reclassified"))


def rail(raw: DataFrame) -> DataFrame:
    """Lines of at least two vertices with their geodesic length."""
    e = elements(raw, S.RAIL_PRECEDENCE).where((F.col("type") == "way") & (F.size("geometry") >= 2)).withColumn("geometry", geometry.line_wkb(F.col("geometry")))
    return e.select(F.concat(F.lit("osm:"), "key").alias("rail_id"), F.when(F.col("category") == "shinkansen", "shinkansen").otherwise("line").alias("kind"), name_local().alias("name_ja"), tag("name:en").alias("name_en"), tag("name:es").alias("name_es"), tag("operator").alias("operator"), geometry.length_spheroid("geometry").alias("length_m"), F.lit(S.MAP_LICENSE).alias("license"), "geometry")


def station(raw: DataFrame, places: DataFrame) -> DataFrame:
    e = elements(raw).where(F.col("type") == "node").withColumn("p", element_point())
    points = e.select(F.concat(F.lit("osm:"), "key").alias("station_id"), name_local().alias("name_ja"), tag("name:en").alias("name_en"), tag("name:es").alias("name_es"), tag("operator").alias("operator"), F.transform(F.split(tag("line"), ";"), lambda x: F.trim(x)).alias("lines"), "p.lon", "p.lat")
    joined = points.join(assign_prefecture(points, places, "station_id").drop("prefecture_method"), "station_id", "left")
    return joined.select("station_id", "name_ja", "name_en", "name_es", "operator", "lines", "prefecture_code", hexgrid.cell_of(F.col("lon"), F.col("lat"), 9).alias("h3_r9"), F.lit(S.MAP_LICENSE).alias("license"), point_wkb(F.col("lon"), F.col("lat")).alias("geometry"))


def building(raw: DataFrame, most: int = 100_000) -> DataFrame:
    """Closed ways and relations (outer less inner rings) as valid polygons; elements without an area go.

    Ring work is JTS's, on the driver: the source is one small neighbourhood, and ``most`` bounds it.
    """
    e = elements(raw)
    spark: SparkSession = e.sparkSession
    t = Topology(spark)
    ways = e.where((F.col("type") == "way") & (F.size("geometry") >= 4) & (F.col("geometry")[0] == F.element_at("geometry", -1))).select("key", geometry.polygon_wkb(F.col("geometry")).alias("shape"))
    single = per_group(ways, "key", "shape", lambda s: t.extract(t.make_valid(s[0]), 2), most)
    parts = e.where(F.col("type") == "relation").select("key", F.explode("members").alias("m")).where(F.size("m.geometry") >= 2).select("key", F.concat_ws("|", "key", "m.role").alias("k"), "m.role", geometry.line_wkb(F.col("m.geometry")).alias("line")).limit(most + 1).collect()
    rings: dict[str, dict[str, list[bytes]]] = {}
    for r in parts:
        rings.setdefault(r.key, {"outer": [], "inner": []}).setdefault(r.role, []).append(bytes(r.line))
    made = [(k, bytearray(w)) for k, v in sorted(rings.items()) if (w := t.rings_to_polygon(v["outer"], v["inner"]))]
    shapes = single.union(spark.createDataFrame(made, "key string, geometry binary"))
    shapes = shapes.where(~geometry.is_empty("geometry"))
    return e.drop("geometry").join(shapes, "key").select(F.concat(F.lit("osm:"), "key").alias("building_id"), tag("building").alias("building"), name_local().alias("name"), text.height_m(tag("height")).alias("height_m"), text.levels(tag("building:levels")).alias("levels"), F.lit(S.MAP_LICENSE).alias("license"), "geometry")


def basemap(layers: dict[str, DataFrame]) -> DataFrame:
    """Layers of a base map under one schema; the fictitious point at 0, 0 is left out.

    A layer has row (its place in the file), geometry, and whichever of featurecla,
    scalerank, names and depth it has, in any case.
    """
    out = None
    for layer, df in layers.items():
        have = {c.lower(): c for c in df.columns}
        col = lambda name, kind="string", have=have: F.col(f"`{have[name]}`").cast(kind) if name in have else F.lit(None).cast(kind)
        part = df.where(F.coalesce(F.lower(col("featurecla")) != S.NULL_ISLAND.lower(), F.lit(True)))
        part = part.select(F.lit(layer).alias("layer"), F.coalesce(col("ne_id"), F.concat(F.lit(f"{layer}:"), col("row"))).alias("feature_id"), col("name_en").alias("name_en"), col("name_es").alias("name_es"), col("name_ja").alias("name_ja"), col("depth", "double").cast("int").alias("depth_m"), col("scalerank", "double").cast("int").alias("scalerank"), F.lit("CC0-1.0").alias("license"), F.col("geometry"))
        out = part if out is None else out.unionByName(part)
    return out.where(~F.coalesce(geometry.is_empty("geometry"), F.lit(True)))


def route_stops(raw: DataFrame, stops: DataFrame, stations: DataFrame) -> DataFrame:
    """Stops of route relations in order with the nearest station. ``stops`` gives nodes' places: node, lon, lat."""
    r = elements(raw).where(F.col("type") == "relation").select(F.concat(F.lit("osm:"), "key").alias("route_id"), name_local().alias("route_name"), F.posexplode("members").alias("position", "m"))
    r = r.where((F.col("m.type") == "node") & F.col("m.role").isin(*S.STOP_ROLES)).select("route_id", "route_name", "position", F.concat(F.lit("osm:node/"), F.col("m.ref").cast("string")).alias("stop_node")).join(stops.withColumnRenamed("node", "stop_node"), "stop_node")
    r = r.withColumn("stop_order", F.row_number().over(Window.partitionBy("route_id").orderBy("position")))
    s = with_xy(stations).select("station_id", "name_ja", F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    pairs = spatial.within_distance(r, s, S.STOP_DEGREES, ("lon", "lat"), ("s_lon", "s_lat"))
    best = pairs.groupBy("route_id", "stop_order").agg(F.min(F.struct("distance", "station_id", "name_ja")).alias("n"))
    return r.join(best, ["route_id", "stop_order"], "left").select("route_id", "route_name", F.col("stop_order").cast("int").alias("stop_order"), "stop_node", "n.station_id", "n.name_ja", F.lit(S.MAP_LICENSE).alias("license"), point_wkb(F.col("lon"), F.col("lat")).alias("geometry"))


def with_xy(df: DataFrame) -> DataFrame:
    """lon and lat of point geometries."""
    box = geometry.envelope("geometry")
    return df.withColumn("_b", box).withColumns({"lon": F.col("_b.west"), "lat": F.col("_b.south")}).drop("_b")


def track_distances(stations: DataFrame, rails: DataFrame, kind: str = "shinkansen") -> DataFrame:
    """station_id, track_m: metres from a station to the nearest track of a kind within reach."""
    boxes = rails.where(F.col("kind") == kind).select("geometry", geometry.envelope("geometry").alias("b")).select("geometry", "b.*")
    near = spatial.box_candidates(stations.select("station_id", "lon", "lat"), boxes, 0.5, S.TRACK_DEGREES)
    d = near.select("station_id", geometry.distance_to("geometry", "lon", "lat").alias("d")).where(F.col("d") <= S.TRACK_DEGREES)
    return d.groupBy("station_id").agg((F.min("d") * S.TRACK_METRES).alias("track_m"))


def line_stations(seed: DataFrame, stations: DataFrame, rails: DataFrame) -> DataFrame:
    """Stations of each line in order, matched by name, track and sequence. What is not matched is null, for the gate to find."""
    named = with_xy(stations.join(seed.select(F.col("station_name_ja").alias("name_ja")).distinct(), "name_ja", "left_semi"))
    found = named.join(track_distances(named, rails), "station_id", "left").select(F.col("name_ja").alias("name"), "station_id", "lon", "lat", "track_m")
    stops = seed.select("line_id", F.col("seq").cast("int").alias("seq"), "kind", F.col("station_name_ja").alias("name"))
    matched = matching.match_stops(stops, found)
    rest = seed.withColumn("seq", F.col("seq").cast("int"))
    return matched.join(rest, ["line_id", "seq"]).join(named.select("station_id", "prefecture_code", "geometry"), "station_id", "left").select("line_id", "line_name_ja", "kind", "operator", "seq", F.col("station_name_ja").alias("name_ja"), "station_id", F.col("candidates").cast("int").alias("candidates"), "match_method", "prefecture_code", "source_url", F.lit(S.SEED_LICENSE).alias("license"), "geometry")


def grid_metric(population: DataFrame, light: DataFrame, points: DataFrame, rails: DataFrame, places: DataFrame) -> DataFrame:
    """The long table of metrics by cell.

    ``population``: h3 (resolution 8), population. ``light``: pixels on land, lon,
    lat, value (null where masked), poor.
    """
    none = F.lit(None).cast("double")

    def metric(df: DataFrame, name: str, source: str, license: str, proxy: bool = False) -> DataFrame:
        have = set(df.columns)
        return df.select("h3", F.col("resolution").cast("int").alias("resolution"), F.lit(name).alias("metric"), F.col("value").cast("double").alias("value"), *(F.col(c) if c in have else none.alias(c) for c in ("coverage", "poor_quality_share")), F.lit(proxy).alias("is_proxy"), F.lit(source).alias("source"), F.lit(license).alias("license"))

    both = hexgrid.two_resolutions(population.select("h3", "population"), "h3", 8, 7, "h3").groupBy("h3", "resolution").agg(F.sum("population").alias("value"))
    pixels = hexgrid.two_resolutions(light.select(hexgrid.cell_of(F.col("lon"), F.col("lat"), 8).alias("h3"), "value", "poor"), "h3", 8, 7, "h3")
    lit = pixels.groupBy("h3", "resolution").agg(F.avg("value").alias("value"), (F.count("value") / F.count("*")).alias("coverage"), F.when(F.count("value") > 0, F.count_if("poor") / F.greatest(F.count("value"), F.lit(1))).alias("poor_quality_share"))
    density = points.where(F.col("category").isin(*S.BRAND)).groupBy(F.col("h3_r7").alias("h3")).agg(F.count("*").alias("value")).withColumn("resolution", F.lit(7))
    vertices = rails.where(F.col("kind") == "shinkansen").select(F.explode(vertices_of("geometry")).alias("v")).select(hexgrid.cell_of(F.col("v.lon"), F.col("v.lat"), 9).alias("origin")).distinct()
    sound = vertices.select(F.explode(hexgrid.disk(F.col("origin"), S.SOUND_RING, 9)).alias("d")).groupBy(F.col("d.cell").alias("h3")).agg(F.min("d.ring").alias("value")).withColumn("resolution", F.lit(9))
    parts = (metric(both, "population", "kontur_population", "CC-BY-4.0"), metric(lit, "night_light", "viirs_night", "CC0-1.0"), metric(density, "poi_density", "osm_overpass", S.MAP_LICENSE), metric(sound, "shinkansen_sound_proxy", "osm_overpass", S.MAP_LICENSE, True))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    cells = out.select("h3", "resolution").distinct()
    xy = cells.select("h3", *(F.coalesce(*(F.when(F.col("resolution") == r, hexgrid.center(F.col("h3"), r)[i]) for r in (7, 8, 9))).alias(n) for i, n in enumerate(("lon", "lat"))))
    boxes = places.select("prefecture_code", "geometry", geometry.envelope("geometry").alias("b")).select("prefecture_code", "geometry", "b.*")
    home = spatial.box_candidates(xy, boxes, 1.0).where(geometry.contains_point("geometry", "lon", "lat")).groupBy("h3").agg(F.min("prefecture_code").alias("prefecture_code"))
    return out.join(home, "h3", "left").select("h3", "resolution", "metric", "value", "coverage", "poor_quality_share", "prefecture_code", "is_proxy", "source", "license")


def vertices_of(shape: str) -> Column:
    kind = "array<struct<lon:double,lat:double>>"
    return geometry.arrow_rows(kind, lambda s: [{"lon": x, "lat": y} for x, y in geometry.read_wkb(s).coordinates().tolist()])(shape)
