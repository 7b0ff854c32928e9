"""Spatial, hexagon, network and clustering queries on points derived from keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridia.functions import hexgrid, points
from meridia.operators import dedup, graph, spatial

LON = "(122 + CAST(({k} * 7919) % 32000 AS DOUBLE) / 1000)"
LAT = "(20 + CAST(({k} * 104729) % 26000 AS DOUBLE) / 1000)"
#: 25 boxes of 5 by 4 degrees in a lattice.
BOXES = "SELECT n_nationkey AS code, 122 + 6.4E0 * (n_nationkey % 5) AS west, 20 + 5.2E0 * floor(n_nationkey / 5) AS south, 127 + 6.4E0 * (n_nationkey % 5) AS east, 24 + 5.2E0 * floor(n_nationkey / 5) AS north FROM {nation}"
NEAREST = 0.5
CELL_DEGREES = 0.25
HAVERSINE = "2 * 6371008.8E0 * asin(sqrt(least(pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2), 1.0E0)))"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(df: DataFrame, key: str, *keep: str) -> DataFrame:
    """The table's points: key, lon, lat."""
    k = f"CAST({key} AS BIGINT)"
    return df.select(F.expr(k).alias("id"), F.expr(LON.format(k=k)).alias("lon"), F.expr(LAT.format(k=k)).alias("lat"), *keep)


def _points_sql(table: str, key: str, *keep: str) -> str:
    k = f"CAST({key} AS BIGINT)"
    return f"SELECT {', '.join([f'{k} AS id', f'{LON.format(k=k)} AS lon', f'{LAT.format(k=k)} AS lat', *keep])} FROM {table}"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BOXES, nation=_read(spark, sf_dir, "nation"))


def region_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by method and box: within, nearest within half a degree, or none."""
    found = spatial.assign_boxes(placed(_read(spark, sf_dir, "customer"), "c_custkey"), _boxes(spark, sf_dir), "id", "code", NEAREST)
    return found.groupBy("method", "code").agg(F.count("*").alias("n"))


def points_in_bbox_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.assign_boxes(placed(_read(spark, sf_dir, "supplier"), "s_suppkey"), _boxes(spark, sf_dir), "id", "code", NEAREST)


_FAR = "sqrt(pow(greatest(west - lon, 0, lon - east), 2) + pow(greatest(south - lat, 0, lat - north), 2))"


def _assign_sql(table: str, key: str) -> str:
    boxes = BOXES.replace("{nation}", "nation")
    return f"""
    WITH p AS ({_points_sql(table, key)}), b AS ({boxes}),
    best AS (SELECT id, min(row({_FAR}, code)) AS m FROM p, b WHERE {_FAR} <= {NEAREST} GROUP BY id)
    SELECT p.id, m[2] AS code, CASE WHEN m[1] = 0 THEN 'within' WHEN m IS NOT NULL THEN 'nearest' ELSE 'none' END AS method
    FROM p LEFT JOIN best USING (id)"""


def inside_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose envelope reaches beyond an extent."""
    p = placed(_read(spark, sf_dir, "customer"), "c_custkey")
    return p.where(points.outside_box(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat"), 25, 125, 40, 150)).select("id")


def dwithin_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's nearest supplier within half a degree, by great-circle distance."""
    c, s = placed(_read(spark, sf_dir, "customer"), "c_custkey"), placed(_read(spark, sf_dir, "supplier"), "s_suppkey")
    s = s.select(F.col("id").alias("s_id"), F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    found = spatial.nearest_within(c, s, "id", "s_id", 0.5, ("lon", "lat"), ("s_lon", "s_lat"))
    return found.select("id", "s_id", F.round("distance_m", 3).alias("distance_m"))


def dwithin_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many suppliers lie within 0.1 degrees of each customer."""
    c, s = placed(_read(spark, sf_dir, "customer"), "c_custkey"), placed(_read(spark, sf_dir, "supplier"), "s_suppkey")
    s = s.select(F.col("id").alias("s_id"), F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    return spatial.within_distance(c, s, 0.1, ("lon", "lat"), ("s_lon", "s_lat")).groupBy("id").agg(F.count("*").alias("n"), F.min("s_id").alias("first"))


def nearest_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's nearest nation point at any distance."""
    n, s = placed(_read(spark, sf_dir, "nation"), "n_nationkey"), placed(_read(spark, sf_dir, "supplier"), "s_suppkey")
    n = n.select(F.col("id").alias("n_id"), F.col("lon").alias("n_lon"), F.col("lat").alias("n_lat"))
    found = spatial.nearest_of_few(s, n, "id", "n_id", ("lon", "lat"), ("n_lon", "n_lat"))
    return found.select("id", "n_id", F.round("distance_m", 3).alias("distance_m"))


def haversine_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each order's line through its suppliers' points, in line order."""
    stops = placed(_read(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "id")
    steps = stops.select("l_orderkey", "lon", "lat", F.lead("lon").over(w).alias("lon2"), F.lead("lat").over(w).alias("lat2"))
    step = points.haversine_m(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2"))
    return steps.groupBy("l_orderkey").agg(F.round(F.coalesce(F.sum(step), F.lit(0.0)) / 1000, 3).alias("km"))


def edges_from_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected edges between suppliers that follow each other in an order."""
    stops = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return graph.edges_of_sequences(stops, "l_orderkey", ("l_linenumber", "l_partkey", "l_suppkey"), "l_suppkey")


def hub_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as hubs: first order that uses them, whether all uses are large, the modes."""
    t = _read(spark, sf_dir, "lineitem")
    return t.groupBy("l_suppkey").agg(F.min_by("l_partkey", F.struct("l_orderkey", "l_partkey")).alias("first_part"), F.bool_and(F.col("l_quantity") >= 2).alias("all_large"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))


def _square(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("long")


def _square_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = placed(_read(spark, sf_dir, "customer"), "c_custkey")
    return p.select("id", (_square(F.col("lon"), CELL_DEGREES) * 100_000 + _square(F.col("lat"), CELL_DEGREES)).alias("cell"))


_AROUND = [a * 100_000 + b for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]


def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupied square cells and the smallest cell that they reach over neighbours."""
    cells = _square_cells(spark, sf_dir).select(F.col("cell").alias("node")).distinct()
    edges = cells.select(F.col("node").alias("a"), F.explode(F.array(*(F.col("node") + d for d in _AROUND))).alias("b")).join(cells.withColumnRenamed("node", "b"), "b", "left_semi")
    return graph.connected_components(cells, edges)


def grid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of at least two points in neighbouring cells."""
    clusters, _ = graph.cell_clusters(_square_cells(spark, sf_dir), "id", "cell", F.array(*(F.col("cell") + d for d in _AROUND)))
    return clusters.select("component", "member_count", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


_CELLS_SQL = f"SELECT id, CAST(floor(lon / {CELL_DEGREES}) AS BIGINT) * 100000 + CAST(floor(lat / {CELL_DEGREES}) AS BIGINT) AS cell FROM ({_points_sql('customer', 'c_custkey')})"
_COMPONENTS_SQL = f"""
    cells AS (SELECT DISTINCT cell FROM occupied),
    steps AS (SELECT a.cell AS a, b.cell AS b FROM cells a JOIN cells b ON b.cell - a.cell IN ({', '.join(map(str, _AROUND))})),
    reach AS (SELECT cell AS node, cell AS other FROM cells UNION SELECT r.node, s.b FROM reach r JOIN steps s ON s.a = r.other),
    labels AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""


def h3_parent_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ancestors of cells made from keys, by bit operations."""
    cell = F.expr("CAST(c_custkey AS BIGINT)").alias("k")
    made = (F.lit((1 << 59) | (9 << 52) | ((1 << 18) - 1)) + F.shiftleft(F.col("k") % 122, 45) + F.shiftleft(F.pmod(F.col("k") * 7919, F.lit(1 << 27)), 18)).alias("cell")
    c = _read(spark, sf_dir, "customer").select(cell).select("k", made)
    return c.select("k", hexgrid.h3_text(F.col("cell")).alias("cell"), hexgrid.h3_text(hexgrid.h3_parent(F.col("cell"), 8)).alias("r8"), hexgrid.h3_text(hexgrid.h3_parent(F.col("cell"), 5)).alias("r5"), hexgrid.h3_base_cell(F.col("cell")).alias("base"))


def _hex_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(_read(spark, sf_dir, "supplier"), "s_suppkey").withColumn("cell", hexgrid.cell_of(F.col("lon"), F.col("lat"), 5))


def hex_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of points, their centres and parents on the planar grid."""
    p = _hex_points(spark, sf_dir)
    x, y = hexgrid.center(F.col("cell"), 5)
    return p.select("id", "cell", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), hexgrid.parent(F.col("cell"), 5, 3).alias("parent"))


def hex_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells within two steps of suppliers, with the smallest ring: a proximity proxy."""
    around = _hex_points(spark, sf_dir).select(F.explode(hexgrid.disk(F.col("cell"), 2, 5)).alias("d"))
    return around.groupBy(F.col("d.cell").alias("cell")).agg(F.min("d.ring").alias("ring"), F.count("*").alias("n"))


def _axial_sql(resolution: int, points: str, given: str = "fixed") -> str:
    """CTEs that find the axial coordinates q and r (in ``given``) of points (id, lon, lat)."""
    size = hexgrid.radius(resolution)
    return f"""
    {given}_axial AS (SELECT id, lon, lat, (lon * {math.sqrt(3) / 3!r}E0 - lat / 3.0E0) / {size!r}E0 AS q, lat * 2.0E0 / 3.0E0 / {size!r}E0 AS r FROM ({points})),
    {given}_near AS (SELECT *, floor(q + 0.5E0) AS nq, floor(r + 0.5E0) AS nr, floor(-q - r + 0.5E0) AS ns FROM {given}_axial),
    {given} AS (SELECT id,
        CAST(CASE WHEN abs(nq - q) > abs(nr - r) AND abs(nq - q) > abs(ns + q + r) THEN -nr - ns ELSE nq END AS BIGINT) AS q,
        CAST(CASE WHEN NOT (abs(nq - q) > abs(nr - r) AND abs(nq - q) > abs(ns + q + r)) AND abs(nr - r) > abs(ns + q + r) THEN -nq - ns ELSE nr END AS BIGINT) AS r FROM {given}_near)"""


_AXIAL = _axial_sql(5, _points_sql("supplier", "s_suppkey"))
_CENTERS = f"SELECT id, {hexgrid.radius(5) * math.sqrt(3)!r}E0 * (q + r / 2.0E0) AS lon, {hexgrid.radius(5) * 1.5!r}E0 * r AS lat FROM fixed"
_TEXT = "printf('%015x', (({res}::BIGINT << 56) | (({q} + 134217728) << 28) | ({r} + 134217728)))"


def multires_zonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pixels: masked values averaged in cells of two sizes in one pass, with coverage."""
    e = placed(_read(spark, sf_dir, "events"), "event_id", "value").withColumn("valid", F.when(F.col("id") % 7 != 0, F.col("value")))
    both = e.select("valid", F.explode(F.array(*(F.struct(F.lit(size).alias("size"), (_square(F.col("lon"), float(size)) * 1000 + _square(F.col("lat"), float(size))).alias("cell")) for size in (1, 4)))).alias("z"))
    return both.groupBy("z.size", "z.cell").agg(F.round(F.avg("valid"), 6).alias("mean"), F.round(F.count("valid") / F.count("*"), 6).alias("coverage"))


_HEX_SIDES = [(math.cos(math.radians(60 * i)), math.sin(math.radians(60 * i))) for i in range(7)]


def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers inside hexagons around nation points: bucketed candidates, then ray casting on WKB."""
    from meridia.functions import geometry

    n = placed(_read(spark, sf_dir, "nation"), "n_nationkey")
    ring = F.array(*(F.struct((F.col("lon") + 3 * c).alias("lon"), (F.col("lat") + 3 * s).alias("lat")) for c, s in _HEX_SIDES))
    shapes = n.select(F.col("id").alias("code"), geometry.polygon_wkb(ring).alias("shape"), (F.col("lon") - 3).alias("west"), (F.col("lat") - 3).alias("south"), (F.col("lon") + 3).alias("east"), (F.col("lat") + 3).alias("north"))
    s = placed(_read(spark, sf_dir, "supplier"), "s_suppkey")
    pairs = spatial.box_candidates(s, shapes, 2.0)
    return pairs.where(geometry.contains_point("shape", "lon", "lat")).groupBy("code").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def _hexagon_sql() -> str:
    edges = ", ".join(f"({a[0]!r}E0, {a[1]!r}E0, {b[0]!r}E0, {b[1]!r}E0)" for a, b in zip(_HEX_SIDES, _HEX_SIDES[1:], strict=False)).replace("e-", "E-")
    edges = ", ".join("(" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in (*a, *b)) + ")" for a, b in zip(_HEX_SIDES, _HEX_SIDES[1:], strict=False))
    return f"""
    WITH n AS ({_points_sql('nation', 'n_nationkey')}), s AS ({_points_sql('supplier', 's_suppkey')}),
    e AS (SELECT id AS code, lon + 3 * x1 AS x1, lat + 3 * y1 AS y1, lon + 3 * x2 AS x2, lat + 3 * y2 AS y2 FROM n, (VALUES {edges}) t(x1, y1, x2, y2)),
    hits AS (SELECT code, s.id, count(*) FILTER (WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) AS n FROM e, s GROUP BY code, s.id)
    SELECT code, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM hits WHERE n % 2 = 1 GROUP BY code"""


def dedup_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event for each user: the first by precedence of its type, then the smallest id."""
    e = _read(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return dedup.first_by_precedence(e, ["user_id"], "event_type", ["purchase", "error", "click"], ["event_id"])


def dedup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_counts(_read(spark, sf_dir, "events"), ["user_id"], "event_type")


def priority_union_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of rich suppliers first; customers' nations where there is none."""
    s = _read(spark, sf_dir, "supplier").where("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.min("s_name").alias("name"))
    c = _read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.min("c_name").alias("name"))
    return dedup.priority_union(s, c, "nation")


QUERIES = {
    f.__name__: f
    for f in (region_assignment, points_in_bbox_regions, inside_filter, dwithin_nearest, dwithin_pairs, nearest_unbounded, haversine_length, edges_from_sequences, hub_stations, connected_components, grid_clusters, h3_parent_bits, hex_index, hex_disk, multires_zonal, point_in_polygon, dedup_precedence, dedup_counters, priority_union_fallback)
}

_STOPS = "SELECT l_orderkey, l_suppkey AS a, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem"
_CELL9 = "((1::BIGINT << 59) | (9::BIGINT << 52) | 262143) + ((k % 122) << 45) + (((k * 7919) % 134217728) << 18)"
ORACLE_SQL = {
    "region_assignment": f"SELECT method, code, count(*) AS n FROM ({_assign_sql('customer', 'c_custkey')}) GROUP BY method, code",
    "points_in_bbox_regions": _assign_sql("supplier", "s_suppkey"),
    "inside_filter": f"SELECT id FROM ({_points_sql('customer', 'c_custkey')}) WHERE NOT (lon BETWEEN 125 AND 150 AND lat BETWEEN 25 AND 40)",
    "dwithin_nearest": f"""WITH c AS ({_points_sql('customer', 'c_custkey')}), s AS ({_points_sql('supplier', 's_suppkey')}),
        m AS (SELECT c.id, s.id AS s_id, {HAVERSINE.format(a='c.', b='s.')} AS d FROM c, s WHERE sqrt(pow(s.lon - c.lon, 2) + pow(s.lat - c.lat, 2)) <= 0.5)
        SELECT id, s_id, round(d, 3) AS distance_m FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, s_id) = 1""",
    "dwithin_pairs": f"""WITH c AS ({_points_sql('customer', 'c_custkey')}), s AS ({_points_sql('supplier', 's_suppkey')})
        SELECT c.id, count(*) AS n, min(s.id) AS first FROM c, s WHERE sqrt(pow(s.lon - c.lon, 2) + pow(s.lat - c.lat, 2)) <= 0.1 GROUP BY c.id""",
    "nearest_unbounded": f"""WITH n AS ({_points_sql('nation', 'n_nationkey')}), s AS ({_points_sql('supplier', 's_suppkey')}),
        m AS (SELECT s.id, n.id AS n_id, {HAVERSINE.format(a='s.', b='n.')} AS d FROM n, s)
        SELECT id, n_id, round(d, 3) AS distance_m FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, n_id) = 1""",
    "haversine_length": f"""WITH p AS ({_points_sql('lineitem', 'l_suppkey', 'l_orderkey', 'l_linenumber', 'l_partkey')}),
        a AS (SELECT l_orderkey, lon, lat, lead(lon) OVER w AS blon, lead(lat) OVER w AS blat FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, id))
        SELECT l_orderkey, round(coalesce(sum({HAVERSINE.format(a='', b='b')}), 0) / 1000, 3) AS km FROM a GROUP BY l_orderkey""",
    "edges_from_sequences": f"SELECT least(a, b) AS from_key, greatest(a, b) AS to_key, count(DISTINCT l_orderkey) AS n_lines, min(l_orderkey) AS first_line FROM ({_STOPS}) WHERE b IS NOT NULL AND a <> b GROUP BY 1, 2",
    "hub_stations": "SELECT l_suppkey, arg_min(l_partkey, row(l_orderkey, l_partkey)) AS first_part, bool_and(l_quantity >= 2) AS all_large, array_to_string(list(DISTINCT l_returnflag ORDER BY l_returnflag), ',') AS flags FROM lineitem GROUP BY l_suppkey",
    "connected_components": f"WITH RECURSIVE occupied AS ({_CELLS_SQL}), {_COMPONENTS_SQL} SELECT node, component FROM labels",
    "grid_clusters": f"WITH RECURSIVE occupied AS ({_CELLS_SQL}), {_COMPONENTS_SQL} SELECT component, count(*) AS member_count, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS members FROM occupied JOIN labels ON cell = node GROUP BY component HAVING count(*) >= 2",
    "h3_parent_bits": f"""WITH c AS (SELECT k, {_CELL9} AS cell FROM (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer))
        SELECT k, printf('%x', cell) AS cell, printf('%x', (cell & ~(15::BIGINT << 52)) | (8::BIGINT << 52) | ((1::BIGINT << 21) - 1)) AS r8,
        printf('%x', (cell & ~(15::BIGINT << 52)) | (5::BIGINT << 52) | ((1::BIGINT << 30) - 1)) AS r5, CAST((cell >> 45) & 127 AS INTEGER) AS base FROM c""",
    "hex_index": f"""WITH {_AXIAL}, centers AS ({_CENTERS}), {_axial_sql(3, "SELECT * FROM centers", "coarse")}
        SELECT f.id, {_TEXT.format(res=5, q='f.q', r='f.r')} AS cell, round(c.lon, 6) AS x, round(c.lat, 6) AS y, {_TEXT.format(res=3, q='p.q', r='p.r')} AS parent FROM fixed f JOIN centers c USING (id) JOIN coarse p USING (id)""",
    "hex_disk": f"""WITH {_AXIAL}, around AS (SELECT q + a AS q, r + b AS r, (abs(a) + abs(b) + abs(a + b)) // 2 AS ring FROM fixed, (SELECT unnest(range(-2, 3)) AS a), (SELECT unnest(range(-2, 3)) AS b) WHERE abs(a + b) <= 2)
        SELECT {_TEXT.format(res=5, q='q', r='r')} AS cell, CAST(min(ring) AS INTEGER) AS ring, count(*) AS n FROM around GROUP BY 1""",
    "multires_zonal": f"""WITH e AS ({_points_sql('events', 'event_id', 'value')}), z AS (SELECT CASE WHEN id % 7 <> 0 THEN value END AS valid, size, lon, lat FROM e, (VALUES (1), (4)) t(size))
        SELECT CAST(size AS INTEGER) AS size, CAST(floor(lon / size) AS BIGINT) * 1000 + CAST(floor(lat / size) AS BIGINT) AS cell, round(avg(valid), 6) AS mean, round(count(valid) / count(*), 6) AS coverage FROM z GROUP BY 1, 2""",
    "point_in_polygon": _hexagon_sql(),
    "dedup_precedence": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 ELSE 4 END, event_type, event_id) = 1",
    "dedup_counters": """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
        SELECT CAST(sum(n) AS BIGINT) AS raw, count(DISTINCT user_id) AS unique_rows, CAST(sum(n - 1) AS BIGINT) AS same_category, CAST(sum(n) - count(DISTINCT user_id) - sum(n - 1) AS BIGINT) AS across_categories FROM c""",
    "priority_union_fallback": """WITH s AS (SELECT s_nationkey AS nation, min(s_name) AS name FROM supplier WHERE s_acctbal > 8000 GROUP BY 1)
        SELECT * FROM s UNION ALL SELECT c_nationkey, min(c_name) FROM customer WHERE c_nationkey NOT IN (SELECT nation FROM s) GROUP BY 1""",
}
