"""The register of queries, and the graph that they share, derived from the star-schema tables by one SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftgraph.operators import graph
from weftgraph.session import tasks_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


def query(sql: str | None = None, name: str | None = None):
    """Register a query, with the SQL that gives the same rows where there is one."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, text: str, **instead: str) -> DataFrame:
    """SQL over the tables of a folder: {name} stands for a table, or for what is to be read ``instead``."""
    return spark.sql(text.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES} | instead))


#: subject, relation, object, source_url, seq, subject_type, object_type. ``seq`` is unique.
TRIPLES = """
SELECT s_name AS subject, 'located_in' AS relation, n_name AS object, concat('supplier://', CAST(s_suppkey AS STRING)) AS source_url, CAST(1000000000000 + s_suppkey AS BIGINT) AS seq, 'Supplier' AS subject_type, 'Nation' AS object_type FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT c_name, 'located_in', n_name, concat('customer://', CAST(c_custkey AS STRING)), CAST(2000000000000 + c_custkey AS BIGINT), 'Customer', 'Nation' FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT n_name, 'part_of', r_name, concat('nation://', CAST(n_nationkey AS STRING)), CAST(3000000000000 + n_nationkey AS BIGINT), 'Nation', 'Region' FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT r_name, 'includes', n_name, concat('nation://', CAST(n_nationkey AS STRING)), CAST(4000000000000 + n_nationkey AS BIGINT), 'Region', 'Nation' FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT n_name, 'hosts', s_name, concat('supplier://', CAST(s_suppkey AS STRING)), CAST(5000000000000 + s_suppkey AS BIGINT), 'Nation', 'Supplier' FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT p_name, 'made_by', p_brand, concat('part://', CAST(p_partkey AS STRING)), CAST(6000000000000 + p_partkey AS BIGINT), 'Part', 'Brand' FROM {part}
UNION ALL
SELECT p_name, 'has_type', p_type, concat('part://', CAST(p_partkey AS STRING)), CAST(7000000000000 + p_partkey AS BIGINT), 'Part', 'PartType' FROM {part}
UNION ALL
SELECT s_name, 'supplies', p_name, concat('lineitem://', CAST(l_suppkey AS STRING), '/', CAST(l_partkey AS STRING)), CAST(8000000000000000 + CAST(l_suppkey AS BIGINT) * 100000000 + l_partkey AS BIGINT), 'Supplier', 'Part'
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM {lineitem}) l JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey
UNION ALL
SELECT c_name, 'in_segment', c_mktsegment, concat('customer://', CAST(c_custkey AS STRING)), CAST(9000000000000 + c_custkey AS BIGINT), 'Customer', 'Segment' FROM {customer}
"""

NODES_SQL = """
SELECT name, arg_min(type, place) AS type FROM (
  SELECT subject AS name, subject_type AS type, seq * 2 AS place FROM triples UNION ALL SELECT object, object_type, seq * 2 + 1 FROM triples) GROUP BY name
"""
EDGES_SQL = "SELECT subject AS src, object AS dst, relation, arg_max(source_url, seq) AS source_url, min(seq) AS seq FROM triples GROUP BY ALL"
NEAR_SQL = "SELECT src, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS rank, dst FROM (SELECT DISTINCT src, dst FROM edges)"


def with_graph(body: str, recursive: bool = False) -> str:
    """SQL with triples, nodes, edges, near (numbered successors) and outs (their number) before ``body``."""
    plain = TRIPLES.format(**{t: t for t in TABLES})
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} triples AS ({plain}), nodes AS ({NODES_SQL}), edges AS ({EDGES_SQL}), near AS ({NEAR_SQL}), outs AS (SELECT src, count(*) AS n FROM near GROUP BY src) {body}"


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All triples. The pairs of lineitem, by far the most rows, are dealt to tasks whose number follows the table: two
    numbers each, they become wide rows in the same tasks, which sort them."""
    n = tasks_for(table(spark, sf_dir, "lineitem"))
    pairs = f"(SELECT /*+ REPARTITION({n}, l_suppkey, l_partkey) */ l_suppkey, l_partkey FROM parquet.`{sf_dir}/lineitem.parquet`)"
    return run(spark, sf_dir, TRIPLES, lineitem=pairs)


def graph_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = triples(spark, sf_dir)
    return graph.nodes(t), graph.edges(t)


def draw_sql(seed: str, *keys: str) -> str:
    """The same number as ``functions.text.draw`` in SQL."""
    return f"('0x' || md5(concat_ws('|', '{seed}', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))[1:8])::BIGINT"


def order_sql(seed: str, *keys: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def rules_sql(name: str, rules, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({name}, '{p}') THEN '{v}'" for p, v in rules) + f" ELSE '{otherwise}' END"
