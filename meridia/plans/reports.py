"""Quality, text, raster and matching queries over the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.functions import text
from meridia.operators import matching, writer
from meridia.operators.storage import shared_folder
from meridia.quality import checks, contracts
from meridia.raster import relief


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _contract(entity: str, key: list[str], columns: list[dict], count: dict, by: dict | None = None) -> contracts.Contract:
    told = {"entity": entity, "primary_key": key, "count": count, "columns": [*columns, {"name": "license", "type": "VARCHAR"}], **({"count_by": by} if by else {})}
    found = contracts.problems(told, entity)
    if found:
        raise contracts.ContractError("; ".join(found))
    return contracts.build(told)


SUPPLIER = _contract("supplier", ["s_suppkey"], [{"name": "s_suppkey", "type": "BIGINT"}, {"name": "s_name", "type": "VARCHAR", "pattern": "^Supplier#[0-9]+$"}, {"name": "s_nationkey", "type": "INTEGER", "range": [0, 24]}, {"name": "s_acctbal", "type": "DOUBLE", "nullable": True}], {"min": 1})
ORDERS = _contract("orders", ["o_orderkey"], [{"name": "o_orderkey", "type": "BIGINT"}, {"name": "o_orderstatus", "type": "VARCHAR", "allowed": ["F", "O"]}, {"name": "o_totalprice", "type": "DOUBLE", "range": [1000, 200000]}, {"name": "o_orderpriority", "type": "VARCHAR", "pattern": "^[1-3]-"}], {"min": 1, "max": 1000}, {"column": "o_orderstatus", "min": {"F": 10_000_000, "O": 1}})


def contract_cast_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers cast to a contract, written sorted, published and read back."""
    root = f"{shared_folder(spark)}/contract_cast_write"
    done = writer.write_entity(_read(spark, sf_dir, "supplier").withColumn("license", F.lit("public")), SUPPLIER, root)
    return spark.read.parquet(done["path"])


def dq_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing rows of each check of orders' contract, in one pass."""
    df = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.lit("public").alias("license"))
    return spark.createDataFrame([(c.entity, c.check, c.failing) for c in checks.run(df, ORDERS)], "entity string, check string, failing bigint")


def null_rates_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _read(spark, sf_dir, "documents").select("doc_id", "lang").join(_read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    return checks.null_rates(joined, ["quality", "toxic"], "lang")


def count_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each year, and the change from the year before."""
    years = _read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    before = years.select((F.col("year") + 1).alias("year"), F.col("n").alias("previous"))
    return years.join(before, "year", "left").select("year", "n", "previous", F.round((F.col("n") - F.col("previous")) / F.col("previous"), 4).alias("change"))


def region_rollup_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as roll-ups of nations: names joined, the lowest rank wins."""
    ranks = {"official": 3, "accepted": 2, "theory": 1}
    n = _read(spark, sf_dir, "nation").withColumn("confidence", F.when(F.col("n_nationkey") % 7 == 0, "theory").when(F.col("n_nationkey") % 2 == 0, "accepted").otherwise("official"))
    rolled = n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), " + ").alias("nations"), F.min(text.lookup(F.col("confidence"), ranks)).alias("rank"))
    return rolled.join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "nations", text.lookup(F.col("rank"), {v: k for k, v in ranks.items()}).alias("confidence"))


def list_explode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by region through lists of nations, exploded rather than searched."""
    lists = _read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_set("n_nationkey").alias("members"))
    return lists.select("n_regionkey", F.explode("members").alias("c_nationkey")).join(_read(spark, sf_dir, "customer"), "c_nationkey").groupBy("n_regionkey").agg(F.count("*").alias("customers"))


def anti_semi_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    with_orders, without = c.join(o, "c_custkey", "left_semi"), c.join(o, "c_custkey", "left_anti")
    return with_orders.select("c_custkey", F.lit(True).alias("has_orders")).union(without.select("c_custkey", F.lit(False)))


def unit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with units read from made texts."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    p = _read(spark, sf_dir, "part").withColumn("height", F.when(key == 0, F.concat(size, F.lit(" m"))).when(key == 1, size).otherwise(F.concat(size, F.lit(" ft")))).withColumn("power", F.when(key == 0, F.concat(size, F.lit(" GW"))).when(key == 1, F.concat(size, F.lit(".5MWp"))).when(key == 2, F.concat(size, F.lit(" kw"))).otherwise(size))
    return p.select("p_partkey", text.height_m(F.col("height")).alias("height_m"), text.power_mw(F.col("power")).alias("power_mw"))


def regex_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by name, size or both, with the reason."""
    by_name = F.coalesce(F.col("p_name").rlike(r"(^|\s)(red|blue)(\s|$)"), F.lit(False))
    by_size = F.coalesce(F.col("p_size") >= 40, F.lit(False))
    return _read(spark, sf_dir, "part").where(by_name | by_size).select("p_partkey", F.when(by_name & by_size, "name+size").when(by_name, "name").otherwise("size").alias("reason"))


def json_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return _read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"), F.min(k).alias("low"))


def posexplode_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents in order, by length."""
    lines = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.max_by(F.col("pos") + 1, F.struct(F.length("line"), -F.col("pos"))).alias("longest"))


def union_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layers in one schema."""
    r = _read(spark, sf_dir, "region").select(F.lit("region").alias("layer"), F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("double").alias("value"))
    n = _read(spark, sf_dir, "nation").select(F.lit("nation"), F.col("n_nationkey").cast("bigint"), "n_name", F.lit(None).cast("double"))
    s = _read(spark, sf_dir, "supplier").select(F.lit("supplier"), F.col("s_suppkey").cast("bigint"), "s_name", "s_acctbal")
    return r.union(n).union(s)


def publisher_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the publisher of their host."""
    return _read(spark, sf_dir, "pages").groupBy(text.publisher_group(F.col("url"), {"example.com": "com group", "example.org": "org group"}).alias("publisher")).agg(F.count("*").alias("n"))


_SIDE, _DEGREES = 60, 0.01


def hillshade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shading of a made relief whose cells are the parts."""
    p = _read(spark, sf_dir, "part").select((F.col("p_partkey") / _SIDE).cast("int").alias("row"), (F.col("p_partkey") % _SIDE).cast("int").alias("col"), (F.col("p_size") * 20.0).alias("value"))
    return relief.hillshade_pixels(p.withColumn("lat", F.lit(36.0) - F.col("row") * F.lit(_DEGREES)), _DEGREES, _DEGREES).select("row", "col", "shade")


def sequential_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' lines matched in sequence to one of several suppliers with the part's colour."""
    stops = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    stops = stops.select(F.col("l_orderkey").cast("string").alias("line_id"), F.col("l_linenumber").alias("seq"), F.when(F.col("l_orderkey") % 2 == 0, "full").otherwise("mini").alias("kind"), (F.col("p") % 97).cast("string").alias("name"))
    found = _read(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 97).cast("string").alias("name"), F.col("s_name").alias("station_id"), (F.col("s_suppkey") * 1.0).alias("lon"), (F.col("s_suppkey") * F.col("s_suppkey") % 11 * 1.0).alias("lat"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey") * 10.0).alias("track_m"))
    return matching.match_stops(stops, found)


QUERIES = {f.__name__: f for f in (contract_cast_write, dq_column_checks, null_rates_by_group, count_variation, region_rollup_confidence, list_explode_join, anti_semi_joins, unit_parse, regex_source_filter, json_tags, posexplode_order, union_views, publisher_groups, hillshade, sequential_match)}

_M = relief.METRES_PER_DEGREE
_ZENITH, _LIGHT = relief._light(relief.AZIMUTH, relief.ALTITUDE)
ORACLE_SQL = {
    "contract_cast_write": "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, s_nationkey, s_acctbal, 'public' AS license FROM supplier",
    "dq_column_checks": """SELECT 'orders' AS entity, c.check, CAST(c.failing AS BIGINT) AS failing FROM (
        SELECT 'schema' AS check, 0 AS failing UNION ALL SELECT 'not_null.o_orderkey', count(*) FROM orders WHERE o_orderkey IS NULL UNION ALL SELECT 'not_null.o_orderstatus', count(*) FROM orders WHERE o_orderstatus IS NULL
        UNION ALL SELECT 'allowed.o_orderstatus', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'not_null.o_totalprice', count(*) FROM orders WHERE o_totalprice IS NULL
        UNION ALL SELECT 'range.o_totalprice', count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 200000 UNION ALL SELECT 'not_null.o_orderpriority', count(*) FROM orders WHERE o_orderpriority IS NULL
        UNION ALL SELECT 'pattern.o_orderpriority', count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-') UNION ALL SELECT 'not_null.license', 0 UNION ALL SELECT 'primary_key_unique', count(*) - count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'count', greatest(0, count(*) - 1000) FROM orders UNION ALL SELECT 'count_by.F', greatest(0, 10000000 - count(*)) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'count_by.O', greatest(0, 1 - count(*)) FROM orders WHERE o_orderstatus = 'O') c""",
    "null_rates_by_group": """WITH j AS (SELECT lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)), s AS (SELECT lang, 'quality' AS column_name, quality AS v FROM j UNION ALL SELECT lang, 'toxic', toxic FROM j)
        SELECT column_name, grp, count(*) AS row_count, CAST(count(*) - count(v) AS BIGINT) AS null_count, round_even((count(*) - count(v)) / count(*), 4) AS rate FROM (SELECT column_name, lang AS grp, v FROM s UNION ALL SELECT column_name, NULL, v FROM s) GROUP BY column_name, grp""",
    "count_variation": "WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1) SELECT a.year, a.n, b.n AS previous, round((a.n - b.n) / b.n, 4) AS change FROM y a LEFT JOIN y b ON a.year = b.year + 1",
    "region_rollup_confidence": """WITH n AS (SELECT n_regionkey, n_name, CASE WHEN n_nationkey % 7 = 0 THEN 1 WHEN n_nationkey % 2 = 0 THEN 2 ELSE 3 END AS rank FROM nation)
        SELECT r_name, string_agg(DISTINCT n_name, ' + ' ORDER BY n_name) AS nations, CASE min(rank) WHEN 1 THEN 'theory' WHEN 2 THEN 'accepted' ELSE 'official' END AS confidence FROM n JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
    "list_explode_join": "WITH l AS (SELECT n_regionkey, list(n_nationkey) AS members FROM nation GROUP BY 1) SELECT n_regionkey, count(*) AS customers FROM l JOIN customer ON list_contains(members, c_nationkey) GROUP BY 1",
    "anti_semi_joins": "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer",
    "unit_parse": """SELECT p_partkey, CASE WHEN p_partkey % 4 IN (0, 1) THEN CAST(p_size AS DOUBLE) END AS height_m,
        CASE p_partkey % 4 WHEN 0 THEN p_size * 1000.0E0 WHEN 1 THEN p_size + 0.5E0 WHEN 2 THEN p_size * 0.001E0 END AS power_mw FROM part""",
    "regex_source_filter": r"""WITH p AS (SELECT p_partkey, regexp_matches(p_name, '(^|\s)(red|blue)(\s|$)') AS a, p_size >= 40 AS b FROM part)
        SELECT p_partkey, CASE WHEN a AND b THEN 'name+size' WHEN a THEN 'name' ELSE 'size' END AS reason FROM p WHERE a OR b""",
    "json_tags": "WITH k AS (SELECT event_type, CAST(props ->> '$.k' AS BIGINT) AS k FROM events) SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, min(k) AS low FROM k GROUP BY event_type",
    "posexplode_order": "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) SELECT doc_id, count(*) AS n_lines, CAST(arg_max(pos, row(length(line), -pos)) AS INTEGER) AS longest FROM l GROUP BY doc_id",
    "union_views": "SELECT 'region' AS layer, CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(NULL AS DOUBLE) AS value FROM region UNION ALL SELECT 'nation', n_nationkey, n_name, NULL FROM nation UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier",
    "publisher_groups": """WITH h AS (SELECT lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages)
        SELECT CASE WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'com group' WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 'org group' ELSE host END AS publisher, count(*) AS n FROM h GROUP BY 1""",
    "hillshade": f"""WITH p AS (SELECT CAST(p_partkey // {_SIDE} AS INTEGER) AS r, CAST(p_partkey % {_SIDE} AS INTEGER) AS c, p_size * 20.0E0 AS v FROM part),
        s AS (SELECT r, c, v, coalesce(lag(v) OVER a, v) AS w, coalesce(lead(v) OVER a, v) AS e FROM p WINDOW a AS (PARTITION BY r ORDER BY c)),
        t AS (SELECT r, c, e - w AS x, w + 2 * v + e AS y FROM s),
        u AS (SELECT r, c, (coalesce(lag(x) OVER b, x) + 2 * x + coalesce(lead(x) OVER b, x)) / (8E0 * {_DEGREES} * {_M} * cos(radians(36.0E0 - r * {_DEGREES}))) AS gx, (coalesce(lead(y) OVER b, y) - coalesce(lag(y) OVER b, y)) / (8E0 * {_DEGREES} * {_M}) AS gy FROM t WINDOW b AS (PARTITION BY c ORDER BY r)),
        f AS (SELECT r, c, atan(sqrt(gx * gx + gy * gy)) AS slope, atan2(gy, -gx) AS aspect FROM u)
        SELECT r AS row, c AS col, CAST(greatest(1, least(255, round_even(1 + 254 * greatest(0, least(1, cos(slope) * {math.cos(_ZENITH)!r} + sin(slope) * {math.sin(_ZENITH)!r} * cos({_LIGHT!r} - aspect))), 0))) AS INTEGER) AS shade FROM f""",
    "sequential_match": """WITH RECURSIVE stops AS (SELECT CAST(l_orderkey AS VARCHAR) AS line_id, CAST(l_linenumber AS INTEGER) AS seq, CASE WHEN l_orderkey % 2 = 0 THEN 'full' ELSE 'mini' END AS kind, CAST(min(l_partkey) % 97 AS VARCHAR) AS name,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS i FROM lineitem GROUP BY l_orderkey, l_linenumber),
        found AS (SELECT CAST(s_suppkey % 97 AS VARCHAR) AS name, list(struct_pack(id := s_name, lon := s_suppkey * 1.0E0, lat := s_suppkey * s_suppkey % 11 * 1.0E0, track := CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 10.0E0 END)) AS c FROM supplier GROUP BY 1),
        listed AS (SELECT line_id, i, seq, kind, coalesce(c, []) AS c FROM stops LEFT JOIN found USING (name)),
        walk AS (SELECT line_id, CAST(0 AS BIGINT) AS i, 0 AS seq, CAST(NULL AS VARCHAR) AS station_id, 0 AS candidates, -1 AS tier, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat FROM stops WHERE i = 1
            UNION ALL SELECT line_id, i, seq, best.id, n, best.tier, coalesce(best.lon, lon), coalesce(best.lat, lat) FROM (SELECT w.line_id, l.i, l.seq, w.lon, w.lat, CAST(len(l.c) AS INTEGER) AS n, list_sort(list_transform(l.c, lambda x: struct_pack(
                tier := CASE WHEN (l.kind = 'full' OR w.lon IS NULL) AND x.track IS NOT NULL THEN 0 ELSE 1 END,
                metres := CASE WHEN (l.kind = 'full' OR w.lon IS NULL) AND x.track IS NOT NULL THEN x.track WHEN w.lon IS NULL THEN 0.0E0 ELSE (x.lon - w.lon) * (x.lon - w.lon) + (x.lat - w.lat) * (x.lat - w.lat) END,
                id := x.id, lon := x.lon, lat := x.lat)))[1] AS best FROM walk w JOIN listed l ON l.line_id = w.line_id AND l.i = w.i + 1))
        SELECT line_id, seq, station_id, candidates, CASE WHEN candidates = 1 THEN 'unique' WHEN candidates > 1 THEN CASE tier WHEN 0 THEN 'track' ELSE 'sequence' END END AS match_method FROM walk WHERE i > 0""",
}
