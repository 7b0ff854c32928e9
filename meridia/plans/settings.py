"""Fixed values of the curated tables: they decide results, so they are stated as they are."""

#: Categories of points, the first wins; which are reclassified by the beginning of their name.
POINT_PRECEDENCE = ("pokemon_center", "pokemon_store", "pokemon_cafe", "poke_lids", "onsen", "power_plant")
BY_NAME = (("ポケモンセンター", "pokemon_center"), ("ポケモンストア", "pokemon_store"))
BRAND = ("pokemon_center", "pokemon_store", "pokemon_cafe", "poke_lids")
RAIL_PRECEDENCE = ("shinkansen", "rail_kanto")
CLUSTER_LAYERS = {"poke_lids": ("poke_lids",), "pokemon_retail": ("pokemon_center", "pokemon_store", "pokemon_cafe")}
STOP_ROLES = ("stop", "stop_entry_only", "stop_exit_only")
OUTSIDE_REGIONS = ("unova", "kalos", "alola", "galar", "paldea")
CONFIDENCE = {"teoría de fans": 1, "ampliamente aceptada": 2, "oficial": 3}

#: Radii in degrees, metres in a degree, rings of cells, the hulls' margin, megawatts.
NEAREST_DEGREES = 0.05
STOP_DEGREES = 0.003
TRACK_DEGREES = 0.02
TRACK_METRES = 111_000
CENTER_DEGREES = 0.1
CLUSTER_RING = 2
CLUSTER_MARGIN = 0.002
SOUND_RING = 2
PLANT_SOURCES = ("nuclear", "hydro", "coal", "gas", "oil")
PLANT_MEGAWATTS = 10.0
SIMPLIFY_DEGREES = 0.0025
NULL_ISLAND = "Null island"
WATERS = (127.5, 29.5, 133.0, 35.0)  # west, south, east, north

#: Licences and attribution of the sources.
MAP_LICENSE = "ODbL-1.0"
SEED_LICENSE = "LicenseRef-seeds + ODbL-1.0"
FACTS = " + LicenseRef-factual-data"
ATTRIBUTION = "© OpenStreetMap contributors"
