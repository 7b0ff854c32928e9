"""The report's findings on coverage: what the sources lack, told as counts.

Each is one aggregate in SQL over named tables, giving ``value``, ``total`` and
``detail``. The tables are the curated ones and, from the sources,
``game_places`` (place, based_on), ``game_regions`` (region, name_en),
``based_regions`` (region), ``dishes`` (dish, iso), ``coverage_references``
(reference_id, value, notes, as_of, source_url) and ``poi_counts`` (see
``plans.curated.poi_counts``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.functions import geometry
from meridia.quality.gate import Finding, finding

#: The islands' corner, the direction at the end of a route's name, and the country's prefectures.
KURILS = (145.3, 43.3)
DIRECTION = r"[（(].*[）)]\s*$"
PREFECTURES = 47


@dataclass(frozen=True)
class Fact:
    """A finding's published texts and the statement that counts it."""

    name: str
    title: str
    source: str
    reads: tuple[str, ...]
    sql: str

    def __call__(self, tables: Mapping[str, DataFrame]) -> dict:
        read = {t: tables[t] for t in self.reads}
        if "unplaced" in self.sql:
            read = {"unplaced": unplaced(*read.values())}
        row = next(iter(read.values())).sparkSession.sql(self.sql, **read).first()
        return finding(self.name, self.title, row.value, row.total, self.source, row.detail)


def unplaced(*tables: DataFrame) -> DataFrame:
    """lon, lat of the tables' points without a prefecture."""
    out = None
    for df in tables:
        part = df.where("prefecture_code IS NULL").select(geometry.envelope("geometry").alias("b")).select(F.col("b.west").alias("lon"), F.col("b.south").alias("lat"))
        out = part if out is None else out.union(part)
    return out


def _filled(table: str, column: str) -> str:
    return f"SELECT count({column}) AS value, count(*) AS total, '' AS detail FROM {{{table}}}"


#: Names, titles, sources and details are published.
FACTS: tuple[Fact, ...] = (
    Fact(
        "wikidata_p144_places", "Lugares del juego (Kanto, Johto, Hoenn, Sinnoh) con P144 en Wikidata", "wikidata", ("game_places",),
        "SELECT count(DISTINCT CASE WHEN based_on <> '' THEN place END) AS value, count(DISTINCT place) AS total, 'Ninguno cita referencias; uno apunta fuera de Japón (Battle Zone → Sajalín).' AS detail FROM {game_places}",
    ),
    Fact(
        "wikidata_p144_regions", "Regiones principales con P144 en Wikidata", "wikidata", ("game_regions", "based_regions"),
        "SELECT count(b.region) AS value, count(*) AS total, concat('Sin P144: ', array_join(sort_array(collect_list(CASE WHEN b.region IS NULL THEN name_en END)), ', '), '.') AS detail FROM {game_regions} g LEFT JOIN (SELECT DISTINCT region FROM {based_regions}) b ON b.region = g.region",
    ),
    Fact(
        "osm_pokemon_cafe_brand", "Pokémon Café con la etiqueta brand en OSM", "osm_overpass", ("poi", "poi_counts"),
        "SELECT max(c.replaced) AS value, (SELECT count(*) FROM {poi} WHERE category = 'pokemon_cafe') AS total, 'El de Osaka está en OSM solo por nombre (nodo 7012998620); los dos entran por el seed.' AS detail FROM {poi_counts} c",
    ),
    Fact(
        "osm_center_store_brand", "Pokémon Center y Store con la marca equivocada en OSM", "osm_overpass", ("poi_counts",),
        "SELECT max(reclassified) AS value, CAST(NULL AS BIGINT) AS total, 'Se separan por el nombre en Silver.' AS detail FROM {poi_counts}",
    ),
    Fact("osm_station_lines", "Estaciones con el tag de línea en OSM", "osm_overpass", ("station",), _filled("station", "lines")),
    Fact("osm_building_height", "Edificios con altura en OSM (día 14)", "osm_buildings", ("building",), _filled("building", "height_m")),
    Fact("osm_building_levels", "Edificios con cantidad de pisos en OSM (día 14)", "osm_buildings", ("building",), _filled("building", "levels")),
    Fact(
        "points_without_prefecture", "Puntos (POI y estaciones) sin prefectura", "natural_earth", ("poi", "station"),
        f"SELECT count(*) AS value, CAST(NULL AS BIGINT) AS total, concat(count_if(lon > {KURILS[0]} AND lat > {KURILS[1]}), ' en las Kuriles del sur (se sigue a Natural Earth: control de hecho) y ', count(*) - count_if(lon > {KURILS[0]} AND lat > {KURILS[1]}), ' en islas chicas que Natural Earth a 10 m no tiene.') AS detail FROM {{unplaced}}",
    ),
    Fact(
        "osm_shinkansen_routes", "Líneas del Shinkansen con relación de ruta y paradas en OSM", "osm_overpass", ("shinkansen_route_stop", "rail"),
        f"SELECT count(DISTINCT r) AS value, (SELECT count(DISTINCT name_ja) FROM {{rail}} WHERE kind = 'shinkansen' AND name_ja LIKE '%新幹線') AS total, concat('Con ruta: ', array_join(array_sort(collect_set(r)), ', '), '. Las estaciones del día 24 salen del listado oficial de JR (seed shinkansen_stations).') AS detail FROM (SELECT trim(regexp_replace(route_name, r'{DIRECTION}', '')) AS r FROM {{shinkansen_route_stop}})",
    ),
    Fact(
        "osm_poke_lids", "Poké Lids en OSM contra el total de referencia", "osm_overpass", ("poi", "coverage_references"),
        "SELECT (SELECT count(*) FROM {poi} WHERE category = 'poke_lids') AS value, CAST(value AS BIGINT) AS total, concat('Referencia: ', notes, ' (', as_of, ', ', source_url, ').') AS detail FROM {coverage_references} WHERE reference_id = 'poke_lids_total'",
    ),
    Fact(
        "wikidata_regional_dishes", "Prefecturas con algún plato regional en Wikidata", "wikidata", ("dishes",),
        f"SELECT size(found) AS value, {PREFECTURES} AS total, concat(placed, ' de ', dishes, ' platos de Japón tienen prefectura. Sin ninguno: ', array_join(array_except(transform(sequence(1, {PREFECTURES}), i -> concat('JP-', lpad(i, 2, '0'))), found), ', '), '.') AS detail FROM (SELECT collect_set(nullif(iso, '')) AS found, count(DISTINCT CASE WHEN iso <> '' THEN dish END) AS placed, count(DISTINCT dish) AS dishes FROM {{dishes}})",
    ),
    Fact(
        "viirs_night_light_null", "Celdas de luz nocturna (resolución 8) sin dato (NULL)", "viirs_night", ("h3_metric",),
        "SELECT coalesce(sum(empty), 0) AS value, coalesce(sum(n), 0) AS total, concat('Sin ningún píxel válido en la celda (relleno o calidad 255); quedan en NULL, nunca en 0. ', array_join(transform(array_sort(collect_list(CASE WHEN empty > 0 THEN struct(-empty AS e, p) END)), s -> concat(s.p, ': ', -s.e)), ', ')) AS detail FROM (SELECT coalesce(prefecture_code, '(sin prefectura)') AS p, count(*) - count(value) AS empty, count(*) AS n FROM {h3_metric} WHERE metric = 'night_light' AND resolution = 8 GROUP BY 1)",
    ),
)


def available(tables: Mapping[str, DataFrame]) -> tuple[Finding, ...]:
    """The findings whose tables are all there, in the report's order."""
    return tuple(f for f in FACTS if all(t in tables for t in f.reads))
