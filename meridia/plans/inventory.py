"""One query for each relational operator, in Spark SQL, with the DuckDB text that gives the same rows.

Tables are named in braces and bound to scans of ``sf_dir``; a single text
serves both engines where their dialects agree.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: key: Spark SQL, or (Spark SQL, DuckDB SQL).
_SQL: dict[str, str | tuple[str, str]] = {
    # projections and filters
    "prj_01_literals": "SELECT s_suppkey, s_name, 'public' AS license, 'seed' AS source FROM {supplier}",
    "prj_02_star_derived": "SELECT *, p_retailprice * 2 AS doubled, CAST(length(p_name) AS BIGINT) AS name_length FROM {part}",
    "prj_03_searched_case": "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 50000 THEN 'middle' ELSE 'low' END AS band FROM {orders}",
    "prj_04_simple_case": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'partial' END AS status FROM {orders}",
    "prj_06_conditional_update": "SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') AND p_name LIKE 'red%' THEN 'RECLASSIFIED' ELSE p_type END AS p_type FROM {part}",
    "prj_07_casts": "SELECT s_suppkey, CAST(CAST(s_suppkey AS VARCHAR(20)) AS BIGINT) AS as_long, CAST(s_acctbal AS DOUBLE) AS as_double, CAST('2020-03-01 10:00:00' AS TIMESTAMP) AS at FROM {supplier}",
    "prj_08_typed_nulls": ("SELECT r_regionkey, CAST(NULL AS INT) AS depth, CAST(NULL AS STRING) AS note FROM {region}", "SELECT r_regionkey, CAST(NULL AS INTEGER) AS depth, CAST(NULL AS VARCHAR) AS note FROM {region}"),
    "prj_09_boolean_columns": "SELECT n_nationkey, (n_regionkey = 2) AS highlighted FROM {nation}",
    "flt_01_in_list": "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "flt_02_null_tests": "SELECT d.doc_id, (l.quality IS NULL) AS unlabelled FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.quality = 1",
    "flt_03_out_of_range": "SELECT CAST(count(*) AS BIGINT) AS failing FROM {lineitem} WHERE l_discount < 0.02 OR l_discount > 0.08",
    "flt_04_regex": ("SELECT p_partkey, p_name FROM {part} WHERE p_name RLIKE '^(red|blue) .*[gt]$'", "SELECT p_partkey, p_name FROM {part} WHERE regexp_matches(p_name, '^(red|blue) .*[gt]$')"),
    "flt_05_like_suffix": "SELECT p_partkey FROM {part} WHERE p_name LIKE '%ring'",
    "flt_06_three_valued_guard": "SELECT d.doc_id, coalesce(l.toxic = 1, false) AS toxic FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE NOT coalesce(l.quality = 0, false)",
    "flt_10_scalar_subqueries": "SELECT CAST((SELECT count(*) FROM {orders}) AS BIGINT) AS n_orders, CAST((SELECT count(DISTINCT o_custkey) FROM {orders}) AS BIGINT) AS n_customers",
    # joins
    "join_01_inner_using": "SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
    "join_02_aggregate_key": "WITH least AS (SELECT s_nationkey, min(s_acctbal) AS low FROM {supplier} GROUP BY s_nationkey) SELECT s.s_suppkey, s.s_nationkey FROM {supplier} s JOIN least l ON s.s_nationkey = l.s_nationkey AND s.s_acctbal = l.low",
    "join_03_left_outer": "SELECT c.c_custkey, o.o_orderkey FROM {customer} c LEFT JOIN {orders} o ON c.c_custkey = o.o_custkey",
    "join_04_left_on_expression": (
        # two equi joins: an OR would be a nested loop over a broadcast of any size
        "WITH m AS (SELECT n_nationkey, r_name FROM {nation} JOIN {region} ON lower(r_name) = lower(n_name) UNION SELECT n_nationkey, r_name FROM {nation} JOIN {region} ON r_regionkey = n_regionkey - 1) SELECT n.n_name, m.r_name FROM {nation} n LEFT JOIN m USING (n_nationkey)",
        "SELECT n.n_name, r.r_name FROM {nation} n LEFT JOIN {region} r ON lower(r.r_name) = lower(n.n_name) OR r.r_regionkey = n.n_regionkey - 1",
    ),
    "join_05_multi_column": "SELECT a.l_orderkey, a.l_linenumber, b.n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) a LEFT JOIN (SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM {lineitem} WHERE l_quantity > 25 GROUP BY l_orderkey, l_linenumber) b USING (l_orderkey, l_linenumber)",
    "join_06_not_in": (
        # keys are not null: an anti join, where NOT IN would broadcast the orders
        "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
        "SELECT c_custkey FROM {customer} WHERE c_custkey NOT IN (SELECT o_custkey FROM {orders} WHERE o_custkey IS NOT NULL AND o_totalprice > 300000)",
    ),
    "join_07_not_exists": "SELECT c_custkey FROM {customer} c WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')",
    "join_08_semi": "SELECT s_suppkey FROM {supplier} WHERE s_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey IN (1, 3))",
    "join_14_list_membership": ("WITH lists AS (SELECT n_regionkey, collect_list(n_nationkey) AS members FROM {nation} GROUP BY n_regionkey) SELECT c.c_custkey, m.n_regionkey FROM (SELECT n_regionkey, explode(members) AS nation FROM lists) m JOIN {customer} c ON c.c_nationkey = m.nation", "WITH lists AS (SELECT n_regionkey, list(n_nationkey) AS members FROM {nation} GROUP BY n_regionkey) SELECT c.c_custkey, m.n_regionkey FROM lists m JOIN {customer} c ON list_contains(m.members, c.c_nationkey)"),
    "join_15_lateral_unnest": ("SELECT p_partkey, word FROM {part} LATERAL VIEW explode(split(p_name, ' ')) t AS word", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM {part}"),
    "join_16_cast_keys": "SELECT n.n_name, r.r_name FROM {nation} n JOIN {region} r ON CAST(n.n_regionkey AS BIGINT) = CAST(CAST(r.r_regionkey AS VARCHAR(10)) AS BIGINT)",
    # aggregates
    "agg_01_count_by": "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM {orders} GROUP BY o_orderstatus",
    "agg_02_global_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM {lineitem}",
    "agg_03_ratio": "SELECT d.lang, CAST(count(l.quality) AS BIGINT) AS labelled, count(l.quality) / CAST(count(*) AS DOUBLE) AS coverage FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY d.lang",
    "agg_04_sum": "SELECT l_returnflag, CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS total FROM {lineitem} GROUP BY l_returnflag",
    "agg_05_avg": "SELECT d.lang, round(avg(l.quality), 9) AS quality FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY d.lang",
    "agg_06_min_max": "SELECT s_nationkey, min(s_acctbal) AS low, max(s_acctbal) AS high, min(s_name) AS first_name FROM {supplier} GROUP BY s_nationkey",
    "agg_07_arg_min": ("SELECT c_nationkey, min_by(c_custkey, struct(c_acctbal, c_custkey)) AS poorest FROM {customer} GROUP BY c_nationkey", "SELECT c_nationkey, arg_min(c_custkey, row(c_acctbal, c_custkey)) AS poorest FROM {customer} GROUP BY c_nationkey"),
    "agg_08_bool_and": "SELECT l_orderkey, bool_and(l_quantity >= 5) AS all_large FROM {lineitem} GROUP BY l_orderkey",
    "agg_09_any_value": ("SELECT n_regionkey, min_by(n_name, n_nationkey) AS any_name FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, arg_min(n_name, n_nationkey) AS any_name FROM {nation} GROUP BY n_regionkey"),
    "agg_10_filter": "SELECT o_orderpriority, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS filled, CAST(count(*) FILTER (WHERE o_totalprice > 100000) AS BIGINT) AS large FROM {orders} GROUP BY o_orderpriority",
    "agg_11_sorted_distinct_list": ("SELECT c_nationkey, array_join(array_sort(collect_set(c_mktsegment)), '|') AS segments FROM {customer} GROUP BY c_nationkey", "SELECT c_nationkey, array_to_string(list(DISTINCT c_mktsegment ORDER BY c_mktsegment), '|') AS segments FROM {customer} GROUP BY c_nationkey"),
    "agg_12_list_filter": ("SELECT n_regionkey, array_join(array_sort(collect_list(CASE WHEN n_nationkey % 2 = 0 THEN n_name END)), '|') AS even_names FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, coalesce(array_to_string(list(n_name ORDER BY n_name) FILTER (WHERE n_nationkey % 2 = 0), '|'), '') AS even_names FROM {nation} GROUP BY n_regionkey"),
    "agg_13_string_agg": ("SELECT n_regionkey, listagg(DISTINCT substr(n_name, 1, 1), ', ') WITHIN GROUP (ORDER BY substr(n_name, 1, 1)) AS initials FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(DISTINCT substr(n_name, 1, 1), ', ' ORDER BY substr(n_name, 1, 1)) AS initials FROM {nation} GROUP BY n_regionkey"),
    "agg_14_count_distinct": "SELECT l_returnflag, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers FROM {lineitem} GROUP BY l_returnflag",
    "agg_15_duplicate_keys": ("SELECT count(*) - count(DISTINCT struct(l_orderkey, l_linenumber)) AS duplicates FROM {lineitem}", "SELECT CAST(count(*) - count(DISTINCT row(l_orderkey, l_linenumber)) AS BIGINT) AS duplicates FROM {lineitem}"),
    "agg_16_distinct": "SELECT DISTINCT p_brand, p_type FROM {part}",
    "agg_17_group_by_all": "SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS total FROM {lineitem} GROUP BY ALL",
    "agg_18_labelled_null_group": "SELECT coalesce(CAST(l.quality AS VARCHAR(10)), '(none)') AS grp, CAST(count(*) AS BIGINT) AS n FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY 1",
    "agg_19_nested": "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeats FROM (SELECT count(*) AS n FROM {events} GROUP BY user_id, event_type) t",
    # windows
    "win_01_row_number_filter": ("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM {orders}) t WHERE rn = 1", "SELECT o_custkey, o_orderkey FROM {orders} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1"),
    "win_03_stable_dedup": ("SELECT user_id, min_by(event_id, struct(props, event_id)) AS event_id FROM {events} GROUP BY user_id", "SELECT user_id, event_id FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY props, event_id) = 1"),
    "win_04_ordinal": "SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INT) AS ordinal FROM {nation}",
    "win_06_lead": "SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_order, lead(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_status FROM {orders}",
    # order and sets
    "ord_03_top_k": "SELECT p_partkey, p_retailprice FROM {part} ORDER BY 2 DESC, 1 LIMIT 10",
    "ord_06_tuple_minimum": ("SELECT n_regionkey, array_min(collect_list(struct(length(n_name) AS size, n_name AS name))).name AS shortest FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, arg_min(n_name, row(length(n_name), n_name)) AS shortest FROM {nation} GROUP BY n_regionkey"),
    "ord_07_latest": "SELECT max(o_orderdate) AS latest FROM {orders} WHERE o_orderdate < (SELECT max(o_orderdate) FROM {orders})",
    "set_01_union_all": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, 'region' AS kind FROM {region} UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name, 'nation' FROM {nation}",
    "set_04_difference": "SELECT c_custkey FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_totalprice > 300000",
    # scalars
    "str_01_concat": "SELECT n_nationkey, n_name || '-' || CAST(n_regionkey AS VARCHAR(10)) AS label FROM {nation}",
    "str_02_05_trim_lower_coalesce": "SELECT n_nationkey, coalesce(nullif(trim('  ' || lower(substr(n_name, 1, n_nationkey % 3)) || ' '), ''), 'none') AS tag FROM {nation}",
    "str_06_regexp_extract": "SELECT p_partkey, regexp_extract(p_brand, '#([0-9]+)', 1) AS digits, regexp_extract(p_name, '^(x[a-z]+)', 1) AS no_match FROM {part}",
    "str_08_regexp_replace": "SELECT s_suppkey, regexp_replace(s_name, '#0*([0-9]+)$', '') AS base FROM {supplier}",
    "str_09_10_split_join": ("SELECT p_partkey, array_join(split(p_name, ' '), '/') AS path FROM {part}", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '/') AS path FROM {part}"),
    "math_01_scale": "SELECT p_partkey, p_retailprice / 1000 AS thousands, p_size * 111000 AS metres FROM {part}",
    "math_02_least_greatest": "SELECT l_orderkey, l_linenumber, least(CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS a, greatest(CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS b FROM {lineitem}",
    "date_01_year": "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS BIGINT) AS n FROM {orders} GROUP BY 1",
    "date_02_run_id": ("SELECT o_orderkey, date_format(o_orderdate, \"yyyyMMdd'T'HHmmss'Z'\") AS run_id FROM {orders}", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS run_id FROM {orders}"),
    "arr_02_posexplode": ("SELECT p_partkey, pos + 1 AS ordinal, word FROM {part} LATERAL VIEW posexplode(split(p_name, ' ')) t AS pos, word", "SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) AS INTEGER) AS ordinal, unnest(string_split(p_name, ' ')) AS word FROM {part}"),
    "arr_03_04_transform_filter": ("SELECT p_partkey, array_join(filter(transform(split(p_name, ' '), x -> upper(x)), x -> length(x) > 3), ',') AS words FROM {part}", "SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name, ' '), lambda x: upper(x)), lambda x: length(x) > 3), ',') AS words FROM {part}"),
    "arr_05_07_contains_index_size": ("SELECT p_partkey, array_contains(split(p_name, ' '), 'red') AS red, split(p_name, ' ')[0] AS head, CAST(size(split(p_name, ' ')) AS BIGINT) AS n FROM {part}", "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS red, string_split(p_name, ' ')[1] AS head, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n FROM {part}"),
    "json_01_extract": ("SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events}", "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM {events}"),
    "json_04_array_length": ("SELECT r_regionkey, json_array_length(concat('[', r_regionkey, ',2,3]')) AS n FROM {region}", "SELECT r_regionkey, CAST(json_array_length('[' || r_regionkey || ',2,3]') AS INTEGER) AS n FROM {region}"),
    "map_01_lookup": ("SELECT n_nationkey, element_at(map(0, 'I', 1, 'II', 2, 'III', 3, 'IV', 4, 'V'), n_regionkey) AS roman FROM {nation}", "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' WHEN 4 THEN 'V' END AS roman FROM {nation}"),
}


def tables_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def from_sql(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query of a Spark SQL text over the tables that it names in braces."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_in(sql)})

    return run


def for_duckdb(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


QUERIES = {key: from_sql(sql if isinstance(sql, str) else sql[0]) for key, sql in _SQL.items()}
ORACLE_SQL = {key: for_duckdb(sql if isinstance(sql, str) else sql[1]) for key, sql in _SQL.items()}
