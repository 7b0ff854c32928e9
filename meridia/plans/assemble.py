"""The builders of a run: which function makes each table, from which sources and tables.

``sources`` holds the raw tables by the names used here. A builder's parameters
name the tables that it reads, so ``plans.runner`` finds the order by itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.plans import curated, derived
from meridia.plans import settings as S
from meridia.plans.runner import Builder
from meridia.quality import contracts

#: Layers of the base map are the sources whose names begin so.
LAYER = "layer_"


def null_island(sources: Mapping[str, DataFrame]) -> int:
    """How many features the base map leaves out as fictitious."""
    layers = [df for name, df in sources.items() if name.startswith(LAYER) and "featurecla" in {c.lower() for c in df.columns}]
    return sum(df.where(F.lower("featurecla") == S.NULL_ISLAND.lower()).count() for df in layers)


def silver_builders(sources: Mapping[str, DataFrame]) -> dict[str, Builder]:
    """Builders of the curated tables; those whose sources are not given are left out."""
    s = sources
    layers = {name.removeprefix(LAYER): df for name, df in s.items() if name.startswith(LAYER)}
    made: dict[str, tuple[tuple[str, ...], Builder]] = {
        "prefecture": (("admin", "prefecture_names", "prefecture_homes"), lambda _: curated.prefecture(s["admin"], s["prefecture_names"], s["prefecture_homes"])),
        "game_region": (("region_seed", "region_names"), lambda prefecture: curated.game_region(s["region_seed"], s["region_names"], prefecture)),
        "game_place": (("place_seed",), lambda _: curated.game_place(s["place_seed"])),
        "outside_region": (("outside_seed", "based_on", "outside_names", "game_releases", "generations"), lambda _: curated.outside_region(s["outside_seed"], s["based_on"], s["outside_names"], s["game_releases"], s["generations"])),
        "poi": (("poi_elements", "cafe_seed"), lambda prefecture, game_region: curated.poi(s["poi_elements"], s["cafe_seed"], prefecture, game_region)),
        "rail": (("rail_elements",), lambda _: curated.rail(s["rail_elements"])),
        "station": (("station_elements",), lambda prefecture: curated.station(s["station_elements"], prefecture)),
        "building": (("building_elements",), lambda _: curated.building(s["building_elements"])),
        "shinkansen_route_stop": (("route_elements", "stop_nodes"), lambda station: curated.route_stops(s["route_elements"], s["stop_nodes"], station)),
        "shinkansen_line_station": (("line_seed",), lambda station, rail: curated.line_stations(s["line_seed"], station, rail)),
        "h3_metric": (("population", "night_light"), lambda poi, rail, prefecture: curated.grid_metric(s["population"], s["night_light"], poi, rail, prefecture)),
    }
    out = {name: builder for name, (reads, builder) in made.items() if all(r in s for r in reads)}
    return {**out, "basemap": lambda _: curated.basemap(layers)} if layers else out


def gold_builders(spark: SparkSession, report: Mapping, left_out: int = 0) -> dict[str, Builder]:
    """Builders of the derived tables but the viewshed, which ``derived.viewshed_area`` makes of a mask."""
    known = contracts.load(Path(contracts.__file__).parent / "tables" / "silver")
    matched = lambda df: df.where("station_id IS NOT NULL")
    return {
        "poi_clusters": derived.poi_clusters,
        "power_plants_kanto": derived.power_plants,
        "center_nearest_station": derived.center_nearest_station,
        "shinkansen_stations": lambda shinkansen_line_station: derived.shinkansen_stations(matched(shinkansen_line_station)),
        "shinkansen_edges": lambda shinkansen_line_station: derived.shinkansen_edges(matched(shinkansen_line_station)),
        "center_to_shinkansen": lambda poi, shinkansen_stations: derived.center_to_shinkansen(poi, shinkansen_stations),
        "null_findings": lambda _: derived.null_findings(spark, report, left_out),
        "null_rates_by_prefecture": lambda _: derived.null_rates_by_prefecture(spark, report, known),
        "osm_summary": lambda poi, rail, station, building, shinkansen_route_stop: derived.osm_summary(poi, rail, station, building, shinkansen_route_stop),
    }
