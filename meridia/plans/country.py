"""The curated tables, derived tables and day views on a country made of the driver's tables.

Nations are prefectures (boxes), regions are game regions, customers and
suppliers are points, orders are routes. ``INPUTS`` are the sources' rows in SQL
that both engines run; the curated and derived functions make the tables of
them, and ``SQL`` says what the tables must be. Geometry is compared by its
envelope, lists as joined text. Cells and geodesic lengths are left to tests:
DuckDB has neither here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from meridia.functions import geometry
from meridia.functions.points import box_wkt
from meridia.plans import assemble, derived, runner
from meridia.plans import settings as S
from meridia.plans.spatial import HAVERSINE, LAT, LON
from meridia.quality import checks, gate
from meridia.sources.readers import ELEMENT

SOURCES = ("nation", "region", "customer", "supplier", "orders", "lineitem")
_CODE = "concat('JP-', lpad(CAST(n_nationkey + 1 AS STRING), 2, '0'))"
_GAME = "CASE n_regionkey WHEN 0 THEN 'kanto' WHEN 1 THEN 'johto' WHEN 2 THEN 'hoenn' WHEN 3 THEN 'sinnoh' ELSE 'orre' END"
_OUTSIDE = "CASE r_regionkey WHEN 0 THEN 'Unova' WHEN 1 THEN 'Kalos' WHEN 2 THEN 'Alola' WHEN 3 THEN 'Galar' ELSE 'Nowhere' END"


def _at(key: str, off: str = "0.00037E0") -> str:
    """A key's place, off the boxes' edges."""
    k = f"CAST({key} AS BIGINT)"
    return f"{LON.format(k=k)} + {off} AS lon, {LAT.format(k=k)} + {off} AS lat"


INPUTS = {
    "admin": f"SELECT {_CODE} AS iso_3166_2, concat(n_name, ' ja') AS name_ja, n_name AS name, CASE WHEN n_nationkey % 3 > 0 THEN concat('R', CAST(n_regionkey AS STRING)) END AS region, concat('Q', CAST(n_nationkey AS STRING)) AS wikidataid, CASE WHEN n_nationkey = 24 THEN 'XXX' ELSE 'JPN' END AS adm0_a3, 122 + 6.4E0 * (n_nationkey % 5) AS west, 20 + 5.2E0 * floor(n_nationkey / 5) AS south, 127 + 6.4E0 * (n_nationkey % 5) AS east, 24 + 5.2E0 * floor(n_nationkey / 5) AS north FROM {{nation}}",
    "names": f"SELECT {_CODE} AS iso, concat('Q9', CAST(n_nationkey AS STRING)) AS prefecture, concat('L ', n_name) AS name_ja, lower(n_name) AS name_en, CAST(NULL AS STRING) AS name_es FROM {{nation}} WHERE n_nationkey % 2 = 0",
    "homes": f"SELECT {_CODE} AS prefecture_code, concat('S', CAST(n_regionkey AS STRING)) AS real_region FROM {{nation}}",
    "games": f"SELECT {_GAME} AS region_id, upper({_GAME}) AS game_name, CAST(n_regionkey + 1 AS STRING) AS generation, CAST(1996 + n_regionkey AS STRING) AS year, concat('S', CAST(n_nationkey % 2 AS STRING)) AS real_region, CASE WHEN n_nationkey % 7 = 0 THEN 'teoría de fans' WHEN n_nationkey % 2 = 0 THEN 'ampliamente aceptada' ELSE 'oficial' END AS confidence, {_CODE} AS prefecture_code, concat('https://', lower(n_name)) AS source_url FROM {{nation}}",
    "game_names": "SELECT r.name_en, concat(r.name_en, ' ja') AS name_ja, CAST(NULL AS STRING) AS name_es FROM (SELECT CASE r_regionkey WHEN 0 THEN 'Kanto' ELSE 'Hoenn' END AS name_en FROM {region} WHERE r_regionkey IN (0, 2)) r",
    "seed_places": f"SELECT concat('p', CAST(s_suppkey AS STRING)) AS place_id, s_name AS game_name, 'kanto' AS region_id, lower(s_name) AS real_place, CAST(NULL AS STRING) AS real_place_wikidata, 'JP-01' AS prefecture_code, 'oficial' AS confidence, 'https://a' AS source_url, CASE WHEN s_suppkey % 2 = 0 THEN 'https://b; ;https://c' END AS other_sources, CAST(NULL AS STRING) AS notes, {_at('s_suppkey')} FROM {{supplier}}",
    "seed_outside": f"SELECT lower({_OUTSIDE}) AS region_id, {_OUTSIDE} AS game_name, r_name AS real_place, 'Q60' AS real_place_wikidata, 'oficial' AS confidence, 'https://a' AS source_url, CAST(-74 - r_regionkey AS DOUBLE) AS lon, CAST(40 + r_regionkey AS DOUBLE) AS lat FROM {{region}} WHERE r_regionkey < 2",
    "based": f"SELECT concat('Q', CAST(r_regionkey AS STRING)) AS region, concat('Q1', CAST(r_regionkey AS STRING)) AS based_on, r_name AS based_on_en, CASE WHEN r_regionkey = 2 THEN lower(r_name) END AS based_on_es, concat('Point(', CAST(r_regionkey AS STRING), ' 48.5)') AS coord, {_OUTSIDE} AS name_en FROM {{region}}",
    "releases": "SELECT CAST(5 + n_nationkey % 4 AS STRING) AS generation, n_name AS game, concat('20', CAST(10 + n_nationkey AS STRING), '-09-18T00:00:00Z') AS first_release FROM {nation}",
    "generations": f"SELECT lower({_OUTSIDE}) AS region_id, CAST(r_regionkey + 5 AS INT) AS generation FROM {{region}}",
    "pois": f"SELECT concat('node/', CAST(c_custkey AS STRING)) AS key, CASE WHEN d = 1 THEN 'onsen' ELSE CASE c_custkey % 6 WHEN 0 THEN 'pokemon_store' WHEN 1 THEN 'pokemon_cafe' WHEN 2 THEN 'poke_lids' WHEN 3 THEN 'onsen' ELSE 'power_plant' END END AS category, CASE WHEN c_custkey % 12 = 0 THEN concat('ポケモンセンター', c_name) ELSE concat(' ', c_name) END AS name, CASE WHEN c_custkey % 5 = 0 THEN lower(c_name) ELSE ' ' END AS en, CASE WHEN c_custkey % 4 = 0 THEN 'solar; Nuclear' WHEN c_custkey % 4 = 1 THEN 'wind' END AS source, CASE WHEN c_custkey % 3 = 1 THEN concat(CAST(c_custkey % 20 AS STRING), ' MW') END AS output, {_at('c_custkey')} FROM {{customer}} CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1) twice WHERE d = 0 OR c_custkey % 10 = 0",
    "cafes": f"SELECT concat('s', CAST(s_suppkey AS STRING)) AS cafe_id, s_name AS name_ja, lower(s_name) AS name_en, concat('street ', CAST(s_suppkey AS STRING)) AS address_ja, CASE WHEN s_suppkey % 2 = 0 THEN concat('osm:node/', CAST(s_suppkey * 6 + 1 AS STRING)) END AS coords_osm, {_at('s_suppkey', '0.5E0')} FROM {{supplier}}",
    "rails": f"SELECT concat('way/', CAST(c_custkey AS STRING)) AS key, CASE WHEN c_custkey % 3 = 0 THEN 'shinkansen' ELSE 'rail_kanto' END AS category, c_name AS name, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 2 END AS vertices, {_at('c_custkey')} FROM {{customer}}",
    "stations": f"SELECT concat('node/', CAST(s_suppkey AS STRING)) AS key, concat('st', CAST(s_suppkey % 50 AS STRING)) AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'A; B' END AS line, {_at('s_suppkey', '0.001E0')} FROM {{supplier}}",
    "buildings": f"SELECT s_suppkey AS k, s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN '12 m' WHEN 1 THEN '7.5' ELSE 'high' END AS height, CASE WHEN s_suppkey % 2 = 0 THEN '3' END AS storeys, {_at('s_suppkey')} FROM {{supplier}}",
    "stops": "SELECT l_orderkey AS route, l_linenumber AS position, min(l_suppkey) AS ref, CASE WHEN l_linenumber % 5 = 0 THEN 'platform' ELSE 'stop' END AS role FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "nodes": f"SELECT concat('osm:node/', CAST(s_suppkey AS STRING)) AS node, {_at('s_suppkey')} FROM {{supplier}}",
    "lines": "SELECT concat('line', CAST(s_nationkey AS STRING)) AS line_id, concat('Line ', CAST(s_nationkey AS STRING)) AS line_name_ja, CASE WHEN s_nationkey % 3 = 0 THEN 'mini' ELSE 'full' END AS kind, 'o' AS operator, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY k) AS STRING) AS seq, station_name_ja, 'https://s' AS source_url FROM (SELECT s_nationkey, CASE WHEN s_suppkey % 9 = 4 THEN 'none' ELSE concat('st', CAST(s_suppkey % 50 AS STRING)) END AS station_name_ja, min(s_suppkey) AS k FROM {supplier} GROUP BY 1, 2) s",
    "coast": "SELECT CAST(r_regionkey AS BIGINT) AS row, CASE WHEN r_regionkey = 0 THEN 'Null island' ELSE 'Coastline' END AS featurecla, '1' AS scalerank, CAST(125 + r_regionkey AS DOUBLE) AS west, CAST(25 + r_regionkey AS DOUBLE) AS south, CAST(126 + r_regionkey AS DOUBLE) AS east, CAST(28 + r_regionkey AS DOUBLE) AS north FROM {region}",
    "deep": "SELECT CAST(n_nationkey AS BIGINT) AS row, CASE WHEN n_nationkey % 2 = 0 THEN concat('id', n_name) END AS ne_id, CAST(n_nationkey * 100 AS STRING) AS DEPTH, CAST(120 + n_nationkey AS DOUBLE) AS west, 30.5E0 AS south, 120.5E0 + n_nationkey AS east, 31.5E0 AS north FROM {nation}",
}
#: Tables whose makers need rasters or cells, given as they are to the views that read them.
GIVEN = {
    "poi_clusters": "SELECT concat('poke_lids:', n_name) AS cluster_id, 'poke_lids' AS layer, CAST(n_nationkey + 2 AS INT) AS member_count, n_name AS members, 'JP-01' AS prefecture_codes, 'L' AS license, 1.0E0 * n_nationkey AS west, 1.0E0 AS south, 1.0E0 + n_nationkey AS east, 2.0E0 AS north FROM {nation}",
    "fuji_viewshed": "SELECT r_name AS product_id, r_regionkey * 0.25E0 AS visible_share, 'line of sight' AS method, 'n' AS notice, 'L' AS license, 1.0E0 * r_regionkey AS west, 1.0E0 AS south, 1.0E0 + r_regionkey AS east, 2.0E0 AS north FROM {region}",
    "raster_product": "SELECT r_name AS product_id, 'summit' AS aoi, CASE WHEN r_regionkey % 2 = 0 THEN 'hillshade' ELSE 'elevation' END AS kind, concat(r_name, '.tif') AS path, 10 AS width, 20 AS height, 'n' AS notice, 1.0E0 * r_regionkey AS west, 1.0E0 AS south, 1.0E0 + r_regionkey AS east, 2.0E0 AS north FROM {region}",
    "h3_metric": "SELECT concat('cell', CAST(c_custkey AS STRING)) AS h3, CASE WHEN c_custkey % 8 < 4 THEN 7 ELSE 8 END AS resolution, CASE c_custkey % 4 WHEN 0 THEN 'population' WHEN 1 THEN 'night_light' WHEN 2 THEN 'poi_density' ELSE 'shinkansen_sound_proxy' END AS metric, CAST(c_custkey AS DOUBLE) AS value, 0.5E0 AS coverage, 0.25E0 AS poor_quality_share, CASE WHEN c_custkey % 11 > 0 THEN concat('JP-', lpad(CAST(c_custkey % 25 + 1 AS STRING), 2, '0')) END AS prefecture_code, c_custkey % 4 = 3 AS is_proxy FROM {customer}",
}
_MADE = {**INPUTS, **GIVEN}


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _MADE[name]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES if f"{{{t}}}" in text})


def _boxed(df: DataFrame) -> DataFrame:
    """The envelope columns as a polygon."""
    sides = ("west", "south", "east", "north")
    return df.withColumn("_t", box_wkt(*map(F.col, sides))).withColumn("geometry", geometry.wkb_from_text("_t")).drop("_t", *sides)


def _elements(df: DataFrame, kind: str, category: Column, tags: dict[str, str], **given: Column) -> DataFrame:
    """Rows as map elements: what is not given is null."""
    made = {"type": F.lit(kind), "id": F.element_at(F.split("key", "/"), -1), "tags": F.create_map(*(x for k, c in tags.items() for x in (F.lit(k), F.col(c)))), **given}
    return df.select(category.alias("category"), "key", *(made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DataType.fromDDL(ELEMENT).elementType))


def _corners(*places: tuple[float, float]) -> Column:
    """The place moved by each of some steps."""
    return F.array(*(F.struct((F.col("lat") + y).alias("lat"), (F.col("lon") + x).alias("lon")) for x, y in places))


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The country's raw tables, as ``plans.assemble`` names them."""
    rows = partial(_rows, spark, sf_dir)
    place = {"lon": F.col("lon"), "lat": F.col("lat")}
    poi = _elements(rows("pois"), "node", F.col("category"), {"name": "name", "name:en": "en", "plant:source": "source", "plant:output:electricity": "output"}, **place)
    path = F.slice(_corners((0.0, 0.0), (0.05, 0.0)), F.lit(1), F.col("vertices"))
    member = F.struct(F.lit("node").alias("type"), F.col("ref").cast("bigint").alias("ref"), "role", F.lit(None).cast("array<struct<lat:double,lon:double>>").alias("geometry"))
    listed = rows("stops").groupBy("route").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", member.alias("m")))), lambda s: s["m"]).alias("members"))
    listed = listed.select(F.concat(F.lit("relation/"), F.col("route").cast("string")).alias("key"), F.concat(F.lit("R"), F.col("route").cast("string")).alias("name"), "members")
    based = rows("based")
    return {
        "admin": _boxed(rows("admin")),
        "prefecture_names": rows("names"),
        "prefecture_homes": rows("homes"),
        "region_seed": rows("games"),
        "region_names": rows("game_names"),
        "place_seed": rows("seed_places"),
        "outside_seed": rows("seed_outside"),
        "based_on": based.drop("name_en"),
        "outside_names": based.select("region", "name_en"),
        "game_releases": rows("releases"),
        "generations": rows("generations"),
        "poi_elements": poi,
        "cafe_seed": rows("cafes"),
        "rail_elements": _elements(rows("rails"), "way", F.col("category"), {"name": "name"}, geometry=path),
        "station_elements": _elements(rows("stations"), "node", F.lit("station"), {"name": "name", "line": "line"}, **place),
        "building_elements": _buildings(rows("buildings")),
        "route_elements": _elements(listed, "relation", F.lit("shinkansen_routes"), {"name": "name"}, members=F.col("members")),
        "stop_nodes": rows("nodes"),
        "line_seed": rows("lines"),
        "layer_coastline": _boxed(rows("coast")),
        "layer_bathymetry": _boxed(rows("deep")),
    }


def _buildings(rows: DataFrame) -> DataFrame:
    """Squares as ways, every seventh not closed; every fifth is a relation with a hole."""
    ring = ((0.0, 0.0), (0.01, 0.0), (0.01, 0.01), (0.0, 0.01), (0.0, 0.0))
    hole = ((0.004, 0.004), (0.006, 0.004), (0.006, 0.006), (0.004, 0.006), (0.004, 0.004))
    rows = rows.withColumn("key", F.concat(F.when(F.col("k") % 5 == 4, "relation/").otherwise("way/"), F.col("k").cast("string")))
    tags = {"name": "name", "height": "height", "building:levels": "storeys", "building": "name"}
    path = F.when(F.col("k") % 7 == 0, _corners(*ring[:4])).otherwise(_corners(*ring))
    member = lambda role, *places: F.struct(F.lit("way").alias("type"), F.lit(1).cast("bigint").alias("ref"), F.lit(role).alias("role"), _corners(*places).alias("geometry"))
    parts = F.array(member("outer", *ring[:3]), member("outer", *ring[2:]), member("inner", *hole))
    ways = _elements(rows.where("k % 5 <> 4"), "way", F.lit("buildings"), tags, geometry=path)
    return ways.union(_elements(rows.where("k % 5 = 4"), "relation", F.lit("buildings"), tags, members=parts))


class Country(Mapping):
    """The tables by name, each made by its builder when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.rows, self.sources = spark, partial(_rows, spark, sf_dir), sources(spark, sf_dir)
        self.silver = assemble.silver_builders(self.sources)
        self.made: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter((*CURATED, *DERIVED, *GIVEN))

    def __len__(self) -> int:
        return len((*CURATED, *DERIVED, *GIVEN))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.given(name) if name in GIVEN else self.build(name)
        return self.made[name]

    def build(self, name: str) -> DataFrame:
        told = self.report(name) if name in REPORTED else {}
        left_out = assemble.null_island(self.sources) if name in REPORTED else 0
        builder = self.silver.get(name) or assemble.gold_builders(self.spark, told, left_out)[name]
        wanted = runner.needs(builder, set(self))
        return builder(**{t: self[t] for t in wanted}) if wanted else builder(self)

    def given(self, name: str) -> DataFrame:
        df = self.rows(name)
        lists = {c: F.array(c) for c in ("members", "prefecture_codes") if c in df.columns}
        return (_boxed(df) if "west" in df.columns else df).withColumns(lists)

    def report(self, name: str) -> dict:
        """The part of the gate's report that a table tells."""
        if name == "null_findings":
            return {"coverage": [gate.share_of_rows("poi_placed", "Placed", "poi", "prefecture_code IS NOT NULL", source="osm")(self)]}
        columns: dict[str, dict] = {}
        for r in checks.null_rates(self["poi"], ["name_en", "plant_source"], "prefecture_code").where("grp IS NOT NULL").collect():
            columns.setdefault(r.column_name, {"by": {}})["by"][r.grp] = {"rows": r.row_count, "nulls": r.null_count, "rate": r.rate}
        return {"informative": {"null_rates": {"poi": columns}}}


#: Tables that tell the gate's report.
REPORTED = ("null_findings", "null_rates_by_prefecture")
#: What DuckDB cannot tell, or tells by a series of its own: cells and geodesic lengths.
UNTOLD = ("h3_r7", "h3_r9", "length_m")


def _told(df: DataFrame) -> DataFrame:
    """Lists as text, geometry as its envelope, measures to six digits."""
    for name, kind in df.dtypes:
        if name in UNTOLD:
            df = df.drop(name)
        elif kind == "array<string>":
            df = df.withColumn(name, F.array_join(name, ","))
    if "geometry" in df.columns:
        df = df.withColumn("_b", geometry.envelope("geometry"))
        df = df.withColumns({c: F.round(F.col("_b")[c], 6) for c in ("west", "south", "east", "north")}).drop("geometry", "_b")
    return df.withColumns({c: F.round(c, 3) for c in MEASURES if c in df.columns})


MEASURES = ("distance_m", "distance_km", "area_km2")

_E = geometry._E2**0.5
_Q = f"{1 - geometry._E2!r} * (sin(radians({{0}})) / (1 - {geometry._E2!r} * pow(sin(radians({{0}})), 2)) + atanh({_E!r} * sin(radians({{0}}))) / {_E!r})"
_KM2 = f"radians(east - west) * {geometry.WGS84_A**2 / 2e6!r} * ({_Q.format('north')} - ({_Q.format('south')}))"
_POINT = "lon AS west, lat AS south, lon AS east, lat AS north"
_GAP = "sqrt(pow(greatest({0}west - lon, 0, lon - {0}east), 2) + pow(greatest({0}south - lat, 0, lat - {0}north), 2))"
_HOME = f"(SELECT min(row(({_GAP.format('p.')} > 0)::INT, {_GAP.format('p.')}, p.prefecture_code)) FROM prefecture p WHERE {_GAP.format('p.')} <= {S.NEAREST_DEGREES})"
_METRES = HAVERSINE.format(a="a.", b="b.")
#: What each table must be, for DuckDB: sides of the envelope stand for the geometry.
SQL = {
    "prefecture": f"""SELECT iso_3166_2 AS prefecture_code, coalesce(n.name_ja, a.name_ja) AS name_ja, coalesce(name_en, a.name) AS name_en, name_es, coalesce(region, real_region) AS real_region,
        CASE WHEN region IS NULL THEN 'seed' ELSE 'natural_earth' END AS real_region_source, coalesce(prefecture, wikidataid) AS wikidata, {_KM2} AS area_km2, 'CC0-1.0' AS license, west, south, east, north
        FROM in_admin a LEFT JOIN in_names n ON iso = iso_3166_2 LEFT JOIN in_homes ON prefecture_code = iso_3166_2 WHERE adm0_a3 = 'JPN'""",
    "game_region": """SELECT g.*, l.* EXCLUDE (id), 'LicenseRef-seeds + CC0-1.0' AS license FROM (SELECT region_id, min(game_name) AS game_name, CAST(min(generation) AS INT) AS generation, CAST(min(year) AS INT) AS year, string_agg(DISTINCT s.real_region, ' + ' ORDER BY s.real_region) AS real_region,
        CASE min(CASE confidence WHEN 'oficial' THEN 3 WHEN 'ampliamente aceptada' THEN 2 ELSE 1 END) WHEN 3 THEN 'oficial' WHEN 2 THEN 'ampliamente aceptada' ELSE 'teoría de fans' END AS confidence,
        list(DISTINCT prefecture_code ORDER BY prefecture_code) AS prefecture_codes, list(DISTINCT source_url ORDER BY source_url) AS source_urls, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north
        FROM in_games s JOIN prefecture USING (prefecture_code) GROUP BY region_id) g LEFT JOIN (SELECT lower(name_en) AS id, * FROM in_game_names) l ON id = region_id""",
    "game_place": f"SELECT * EXCLUDE (lon, lat, other_sources), CASE WHEN other_sources IS NULL THEN [] ELSE ['https://b', 'https://c'] END AS other_sources, 'LicenseRef-seeds' AS license, {_POINT} FROM in_seed_places",
    "outside_region": f"""SELECT o.* EXCLUDE (lon, lat, license), g.generation, year, o.license || '{S.FACTS}' AS license, {_POINT} FROM (SELECT *, 'LicenseRef-seeds + CC0-1.0' AS license FROM in_seed_outside
        UNION ALL SELECT lower(name_en), name_en, coalesce(based_on_es, based_on_en), based_on, 'teoría de fans', 'https://www.wikidata.org/wiki/' || region || '#P144', CAST(regexp_extract(coord, '\\((\\S+) ', 1) AS DOUBLE), 48.5E0, 'CC0-1.0' FROM in_based
        WHERE name_en <> 'Nowhere' AND lower(name_en) NOT IN (SELECT region_id FROM in_seed_outside)) o JOIN in_generations g USING (region_id) LEFT JOIN (SELECT CAST(generation AS INT) AS generation, CAST(min(left(first_release, 4)) AS INT) AS year FROM in_releases GROUP BY 1) USING (generation)""",
    "poi": f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE category WHEN 'pokemon_store' THEN 2 WHEN 'pokemon_cafe' THEN 3 WHEN 'poke_lids' THEN 4 WHEN 'onsen' THEN 5 ELSE 6 END) AS r FROM in_pois),
        points AS (SELECT 'osm:' || key AS poi_id, 'osm' AS source, key AS source_id, CASE WHEN category = 'pokemon_store' AND name LIKE 'ポケモンセンター%' THEN 'pokemon_center' ELSE category END AS category, trim(name) AS name_ja, nullif(trim(en), '') AS name_en, CAST(NULL AS VARCHAR) AS name_es,
            CASE WHEN category = 'power_plant' THEN source END AS plant_source, CASE WHEN category = 'power_plant' THEN CAST(split_part(output, ' ', 1) AS DOUBLE) END AS plant_output_mw, CAST(NULL AS VARCHAR) AS address_ja, '{S.MAP_LICENSE}' AS license, lon, lat
            FROM ranked WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM in_cafes WHERE coords_osm = 'osm:' || key)
            UNION ALL SELECT 'seed:' || cafe_id, 'seed', cafe_id, 'pokemon_cafe', name_ja, name_en, NULL, NULL, NULL, address_ja, '{S.SEED_LICENSE}', lon, lat FROM in_cafes),
        homes AS (SELECT *, {_HOME} AS home FROM points)
        SELECT h.* EXCLUDE (lon, lat, home), home[3] AS prefecture_code, CASE home[1] WHEN 0 THEN 'within' WHEN 1 THEN 'nearest' END AS prefecture_method, region_id AS game_region, {_POINT} FROM homes h LEFT JOIN (SELECT region_id, unnest(prefecture_codes) AS code FROM game_region) ON code = home[3]""",
    "rail": f"SELECT 'osm:' || key AS rail_id, CASE category WHEN 'shinkansen' THEN 'shinkansen' ELSE 'line' END AS kind, name AS name_ja, CAST(NULL AS VARCHAR) AS name_en, CAST(NULL AS VARCHAR) AS name_es, CAST(NULL AS VARCHAR) AS operator, '{S.MAP_LICENSE}' AS license, lon AS west, lat AS south, lon + 0.05E0 AS east, lat AS north FROM in_rails WHERE vertices = 2",
    "station": f"SELECT * EXCLUDE (key, name, line, lon, lat, home), 'osm:' || key AS station_id, name AS name_ja, CAST(NULL AS VARCHAR) AS name_en, CAST(NULL AS VARCHAR) AS name_es, CAST(NULL AS VARCHAR) AS operator, CASE WHEN line IS NOT NULL THEN ['A', 'B'] END AS lines, home[3] AS prefecture_code, '{S.MAP_LICENSE}' AS license, {_POINT} FROM (SELECT *, {_HOME} AS home FROM in_stations)",
    "building": f"""SELECT 'osm:' || CASE WHEN k % 5 = 4 THEN 'relation/' ELSE 'way/' END || k AS building_id, name AS building, name, CASE height WHEN '12 m' THEN 12.0E0 WHEN '7.5' THEN 7.5E0 END AS height_m, CAST(storeys AS INT) AS levels, '{S.MAP_LICENSE}' AS license,
        lon AS west, lat AS south, lon + 0.01E0 AS east, lat + 0.01E0 AS north FROM in_buildings WHERE k % 5 = 4 OR k % 7 > 0""",
    "basemap": """SELECT 'coastline' AS layer, 'coastline:' || "row" AS feature_id, CAST(NULL AS VARCHAR) AS name_en, CAST(NULL AS VARCHAR) AS name_es, CAST(NULL AS VARCHAR) AS name_ja, CAST(NULL AS INT) AS depth_m, 1 AS scalerank, 'CC0-1.0' AS license, west, south, east, north FROM in_coast WHERE featurecla <> 'Null island'
        UNION ALL SELECT 'bathymetry', coalesce(ne_id, 'bathymetry:' || "row"), NULL, NULL, NULL, CAST(DEPTH AS INT), NULL, 'CC0-1.0', west, south, east, north FROM in_deep""",
    "shinkansen_route_stop": f"""WITH s AS (SELECT route, position, node, lon, lat, CAST(row_number() OVER (PARTITION BY route ORDER BY position) AS INT) AS stop_order FROM in_stops JOIN in_nodes ON node = 'osm:node/' || ref WHERE role = 'stop'),
        near AS (SELECT n.node, min(row(sqrt(pow(n.lon - t.west, 2) + pow(n.lat - t.south, 2)), t.station_id, t.name_ja)) AS b FROM in_nodes n JOIN station t ON sqrt(pow(n.lon - t.west, 2) + pow(n.lat - t.south, 2)) <= {S.STOP_DEGREES} GROUP BY n.node)
        SELECT 'osm:relation/' || route AS route_id, 'R' || route AS route_name, stop_order, node AS stop_node, b[2] AS station_id, b[3] AS name_ja, '{S.MAP_LICENSE}' AS license, {_POINT} FROM s LEFT JOIN near USING (node)""",
    "tracked": f"""SELECT name_ja AS name, list(struct_pack(id := station_id, lon := west, lat := south, track := track)) AS c FROM (SELECT name_ja, station_id, west, south, (SELECT min(d) * {S.TRACK_METRES} FROM (SELECT sqrt(pow(greatest(r.west - t.west, 0, t.west - r.east), 2) + pow(r.south - t.south, 2)) AS d FROM rail r WHERE kind = 'shinkansen') x WHERE d <= {S.TRACK_DEGREES}) AS track FROM station t) y GROUP BY 1""",
    "listed": "SELECT line_id, CAST(seq AS INT) AS seq, kind, coalesce(c, []) AS c FROM in_lines LEFT JOIN tracked ON name = station_name_ja",
    "walked": """SELECT line_id, 0 AS seq, CAST(NULL AS VARCHAR) AS station_id, 0 AS candidates, -1 AS tier, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat FROM listed WHERE seq = 1
        UNION ALL SELECT line_id, seq, best.id, n, best.tier, coalesce(best.lon, lon), coalesce(best.lat, lat) FROM (SELECT w.line_id, l.seq, w.lon, w.lat, CAST(len(l.c) AS INTEGER) AS n, list_sort(list_transform(l.c, lambda x: struct_pack(
            tier := CASE WHEN (l.kind = 'full' OR w.lon IS NULL) AND x.track IS NOT NULL THEN 0 ELSE 1 END,
            metres := CASE WHEN (l.kind = 'full' OR w.lon IS NULL) AND x.track IS NOT NULL THEN x.track WHEN w.lon IS NULL THEN 0.0E0 ELSE (x.lon - w.lon) * (x.lon - w.lon) + (x.lat - w.lat) * (x.lat - w.lat) END,
            id := x.id, lon := x.lon, lat := x.lat)))[1] AS best FROM walked w JOIN listed l ON l.line_id = w.line_id AND l.seq = w.seq + 1)""",
    "shinkansen_line_station": f"""SELECT l.line_id, line_name_ja, kind, l.operator, w.seq, station_name_ja AS name_ja, w.station_id, candidates, CASE WHEN candidates = 1 THEN 'unique' WHEN candidates > 1 THEN CASE tier WHEN 0 THEN 'track' ELSE 'sequence' END END AS match_method,
        prefecture_code, source_url, '{S.SEED_LICENSE}' AS license, west, south, east, north FROM walked w JOIN in_lines l ON l.line_id = w.line_id AND CAST(l.seq AS INT) = w.seq LEFT JOIN station s ON s.station_id = w.station_id""",
    "power_plants_kanto": r"""SELECT poi_id, name_ja, name_en, plant_source, plant_output_mw, CASE WHEN a AND b THEN 'source+capacity' WHEN a THEN 'source' ELSE 'capacity' END AS reason, prefecture_code, license, west, south, east, north
        FROM (SELECT *, coalesce(plant_source LIKE '%Nuclear%', false) AS a, coalesce(plant_output_mw >= 10, false) AS b FROM poi WHERE category = 'power_plant' AND game_region = 'kanto') WHERE a OR b""",
    "center_nearest_station": f"""SELECT a.poi_id AS poi_id, arg_min(b.n, row(m, b.id)) AS station_name, arg_min(b.id, row(m, b.id)) AS station_id, min(m) AS distance_m, any_value(a.name_ja) AS center_name, any_value(a.game_region) AS game_region, '{S.MAP_LICENSE}' AS license,
        least(any_value(a.lon), arg_min(b.lon, row(m, b.id))) AS west, least(any_value(a.lat), arg_min(b.lat, row(m, b.id))) AS south, greatest(any_value(a.lon), arg_min(b.lon, row(m, b.id))) AS east, greatest(any_value(a.lat), arg_min(b.lat, row(m, b.id))) AS north
        FROM (SELECT a, b, {_METRES} AS m FROM (SELECT *, west AS lon, south AS lat FROM poi WHERE category = 'pokemon_center') a JOIN (SELECT station_id AS id, name_ja AS n, west AS lon, south AS lat FROM station) b ON sqrt(pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2)) <= {S.CENTER_DEGREES}) GROUP BY a.poi_id""",
    "shinkansen_stations": f"""SELECT 'shinkansen:' || name_ja AS station_key, min(station_id) AS station_id, name_ja, list(DISTINCT line_id ORDER BY line_id) AS lines, CASE WHEN bool_and(kind = 'mini') THEN 'mini' ELSE 'full' END AS kind, min(prefecture_code) AS prefecture_code, '{S.SEED_LICENSE}' AS license,
        arg_min(west, station_id) AS west, arg_min(south, station_id) AS south, arg_min(east, station_id) AS east, arg_min(north, station_id) AS north FROM shinkansen_line_station WHERE station_id IS NOT NULL GROUP BY name_ja""",
    "shinkansen_edges": f"""WITH n AS (SELECT line_id, kind, struct_pack(n := name_ja, lon := west, lat := south) AS p, lead(struct_pack(n := name_ja, lon := west, lat := south)) OVER (PARTITION BY line_id ORDER BY seq) AS q FROM shinkansen_line_station WHERE station_id IS NOT NULL),
        e AS (SELECT least(p.n, q.n) AS x, greatest(p.n, q.n) AS y, list(DISTINCT line_id ORDER BY line_id) AS lines, bool_and(kind = 'mini') AS schematic, arg_min(CASE WHEN p.n < q.n THEN p ELSE q END, line_id) AS a, arg_min(CASE WHEN p.n < q.n THEN q ELSE p END, line_id) AS b FROM n WHERE q IS NOT NULL GROUP BY 1, 2)
        SELECT 'shinkansen:' || x || '|shinkansen:' || y AS edge_id, 'shinkansen:' || x AS from_key, 'shinkansen:' || y AS to_key, lines, CASE WHEN schematic THEN 'mini' ELSE 'full' END AS kind, schematic, {_METRES} / 1000 AS distance_km, '{S.SEED_LICENSE}' AS license,
        least(a.lon, b.lon) AS west, least(a.lat, b.lat) AS south, greatest(a.lon, b.lon) AS east, greatest(a.lat, b.lat) AS north FROM e""",
    "center_to_shinkansen": f"""SELECT a.poi_id, a.name_ja AS center_name, best.k AS station_key, best.n AS station_name, best.m / 1000 AS distance_km, '{S.MAP_LICENSE}' AS license, least(a.lon, best.lon) AS west, least(a.lat, best.lat) AS south, greatest(a.lon, best.lon) AS east, greatest(a.lat, best.lat) AS north
        FROM (SELECT a, (SELECT min(struct_pack(m := {_METRES}, k := b.station_key, n := b.name_ja, lon := b.lon, lat := b.lat)) FROM (SELECT *, west AS lon, south AS lat FROM shinkansen_stations) b) AS best FROM (SELECT *, west AS lon, south AS lat FROM poi WHERE category = 'pokemon_center') a)""",
    "null_findings": f"""SELECT 'poi_placed' AS finding_id, 'Placed' AS title, count(prefecture_code) AS value, count(*) AS total, round_even(count(prefecture_code) / count(*), 4) AS share, 'osm' AS source, CAST(NULL AS VARCHAR) AS detail, '{derived.REPORT_LICENSE}' AS license FROM poi
        UNION ALL SELECT '{derived.NULL_ISLAND[0]}', '{derived.NULL_ISLAND[1]}', count(*), NULL, NULL, '{derived.NULL_ISLAND[2]}', '{derived.NULL_ISLAND[3].replace("'", "''")}', '{derived.REPORT_LICENSE}' FROM in_coast WHERE featurecla = 'Null island'""",
    "null_rates_by_prefecture": f"""SELECT 'poi' AS entity, c AS column_name, coalesce(prefecture_code, '(no prefecture_code)') AS prefecture_code, count(*) AS row_count, CAST(count(*) - count(v) AS BIGINT) AS null_count, round_even((count(*) - count(v)) / count(*), 4) AS rate, '{derived.REPORT_LICENSE}' AS license
        FROM (SELECT prefecture_code, 'name_en' AS c, name_en AS v FROM poi UNION ALL SELECT prefecture_code, 'plant_source', plant_source FROM poi) GROUP BY 2, 3""",
    "osm_summary": f"""SELECT *, '{S.ATTRIBUTION}' AS attribution, '{S.MAP_LICENSE}' AS license FROM (SELECT 'poi' AS layer, category, count(*) AS elements FROM poi WHERE source = 'osm' GROUP BY 2 UNION ALL SELECT 'rail', kind, count(*) FROM rail GROUP BY 2
        UNION ALL SELECT 'station', 'station', count(*) FROM station UNION ALL SELECT 'building', 'building', count(*) FROM building UNION ALL SELECT 'shinkansen_route_stop', 'stop', count(*) FROM shinkansen_route_stop)""",
}
_PLAIN = {t: t for t in SOURCES}
_ALL = {**{f"in_{k}": v.format(**_PLAIN) for k, v in INPUTS.items()}, **{k: v.format(**_PLAIN) for k, v in GIVEN.items()}, **SQL}
#: The tables that have a query of their own, and the prefix of its name.
CURATED = ("prefecture", "game_region", "game_place", "outside_region", "poi", "rail", "station", "building", "basemap", "shinkansen_route_stop", "shinkansen_line_station")
DERIVED = ("power_plants_kanto", "center_nearest_station", "shinkansen_stations", "shinkansen_edges", "center_to_shinkansen", "null_findings", "null_rates_by_prefecture", "osm_summary")


#: Lists and measures of tables and of views, which ``_told`` changes; sides are those of all but the last three.
SPECIAL = {
    "prefecture": ("area_km2",), "game_region": ("prefecture_codes", "source_urls"), "game_place": ("other_sources",), "station": ("lines",), "shinkansen_stations": ("lines",), "shinkansen_edges": ("lines", "distance_km"),
    "center_nearest_station": ("distance_m",), "center_to_shinkansen": ("distance_km",), 13: ("distance_m",), 22: ("area_km2",), 24: ("distance_km",),
}
SIDES = ("west", "south", "east", "north")


def _oracle(body: str, shaped: bool, special: tuple[str, ...] = ()) -> str:
    """A statement with the tables that it reads, directly or not, and columns as ``_told`` gives them."""
    seen: set[str] = set()
    order: list[str] = []

    def need(text: str) -> None:
        for name in _ALL:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                need(_ALL[name])
                order.append(name)

    need(body)
    told = [f"round({c}, 3) AS {c}" if c in MEASURES else f"array_to_string({c}, ',') AS {c}" for c in special] + [f"round({c}, 6) AS {c}" for c in SIDES if shaped]
    return f"WITH RECURSIVE {', '.join(f'{n} AS ({_ALL[n]})' for n in order)} SELECT *{f' REPLACE ({', '.join(told)})' if told else ''} FROM ({body}) told"


#: The view that reads spatially, in SQL on envelopes; all others are their own text in DuckDB's words.
_MEETS = "{0}west <= {1} AND {0}east >= {2} AND {0}south <= {3} AND {0}north >= {4}"
_SPATIAL = {
    2: f"SELECT rail_id, kind, kind = 'shinkansen' AS highlight, name_ja, name_en, operator, west, south, east, north FROM rail r WHERE EXISTS (SELECT 1 FROM in_games g JOIN prefecture p ON p.prefecture_code = g.prefecture_code WHERE g.region_id = 'kanto' AND {_MEETS.format('r.', 'p.east', 'p.west', 'p.north', 'p.south')})",
    26: f"SELECT layer, feature_id, depth_m, west, south, east, north FROM basemap WHERE {_MEETS.format('', S.WATERS[2], S.WATERS[0], S.WATERS[3], S.WATERS[1])}",
}
_WORDS = (("explode(", "unnest("), ("source_urls[0]", "source_urls[1]"), ("array_join(", "array_to_string("), ("geometry", "west, south, east, north"))


def _view_sql(day: int) -> str:
    body = _SPATIAL.get(day) or derived.VIEWS[day]
    for ours, theirs in _WORDS if day not in _SPATIAL else ():
        body = body.replace(ours, theirs)
    return _oracle(body, "west" in body or day in (12, 13), SPECIAL.get(day, ()))


def _tables_of(day: int) -> list[str]:
    """The tables that a view reads."""
    text = {2: "FROM rail FROM game_region", 26: "FROM basemap"}.get(day) or derived.VIEWS[day]
    return sorted(set(re.findall(r"FROM (\w+)", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _told(Country(spark, sf_dir)[name])


def view(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    country = Country(spark, sf_dir)
    return _told(derived.day_view(spark, day, {t: country[t] for t in _tables_of(day)}))


def _named() -> dict[str, str]:
    return {f"{kind}_{t}": t for kind, names in (("curated", CURATED), ("derived", DERIVED)) for t in names}


QUERIES = {**{key: partial(table, name=t) for key, t in _named().items()}, **{f"view_day_{d:02}": partial(view, day=d) for d in derived.DAYS}}
ORACLE_SQL = {**{key: _oracle(f"SELECT * FROM {t}", t not in DERIVED[-3:], SPECIAL.get(t, ())) for key, t in _named().items()}, **{f"view_day_{d:02}": _view_sql(d) for d in derived.DAYS}}
