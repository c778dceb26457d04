"""Queries over graph construction, statistics, storage and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftgraph.functions import vocab
from weftgraph.operators import extraction, graph
from weftgraph.plans.base import graph_of, query, table, triples, with_graph
from weftgraph.session import shared_dir
from weftgraph.sources import tables


def folder(spark, name: str) -> str:
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/weftgraph/{name}-{uuid.uuid4().hex}"


@query(with_graph("SELECT name, type, name AS aliases FROM nodes"))
def graph_nodes(spark, sf):
    return graph.nodes(triples(spark, sf)).select("name", "type", F.array_join("names", "|").alias("aliases"))


@query(with_graph("SELECT src, dst, relation, source_url FROM edges"))
def graph_edges(spark, sf):
    return graph.edges(triples(spark, sf)).select("src", "dst", "relation", "source_url")


@query(with_graph("SELECT (SELECT count(*) FROM nodes) AS total_nodes, (SELECT count(*) FROM edges) AS total_edges, round((SELECT count(*) FROM edges) / (SELECT count(*) FROM nodes), 6) AS average_degree"))
def graph_stats(spark, sf):
    return graph.size(*graph_of(spark, sf)).withColumn("average_degree", F.round("average_degree", 6))


@query(with_graph("SELECT count(*) >= 10 AS large_enough FROM nodes"))
def graph_size_gate(spark, sf):
    return graph.large_enough(graph_of(spark, sf)[0])


@query(with_graph(", b AS (SELECT src AS name, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) SELECT name, sum(i)::BIGINT AS n_in, sum(o)::BIGINT AS n_out, count(*) AS degree FROM b GROUP BY name"))
def graph_degrees(spark, sf):
    return graph.degrees(graph_of(spark, sf)[1])


@query(with_graph("SELECT src, rank::INT AS rank, dst FROM near"))
def graph_successors(spark, sf):
    return graph.neighbours(graph_of(spark, sf)[1])


@query(with_graph("SELECT DISTINCT dst AS name, src AS predecessor FROM edges"))
def graph_predecessors(spark, sf):
    return graph_of(spark, sf)[1].select(F.col("dst").alias("name"), F.col("src").alias("predecessor")).distinct()


@query(with_graph("SELECT src, string_agg(dst, '|' ORDER BY dst) AS successors FROM near GROUP BY src"))
def graph_adjacency_cache(spark, sf):
    return graph.adjacency(graph_of(spark, sf)[1]).select("src", F.array_join("successors", "|").alias("successors"))


_SPLIT = "seq % 2 = 0"


@query(with_graph(f", old AS (SELECT * FROM triples WHERE {_SPLIT}), on_ AS (SELECT subject AS name FROM old UNION SELECT object FROM old) SELECT name, type FROM (SELECT name, arg_min(type, place) AS type FROM (SELECT subject AS name, subject_type AS type, seq * 2 AS place FROM triples WHERE NOT ({_SPLIT}) UNION ALL SELECT object, object_type, seq * 2 + 1 FROM triples WHERE NOT ({_SPLIT})) GROUP BY name) WHERE name NOT IN (SELECT name FROM on_)"))
def graph_upsert_new_nodes(spark, sf):
    t = triples(spark, sf)
    old, new = t.where(_SPLIT), t.where(f"not ({_SPLIT})")
    return graph.upsert(graph.nodes(old), graph.edges(old), new)[2].select("name", "type")


@query(with_graph(f", o AS (SELECT subject, object, relation, arg_max(source_url, seq) AS u FROM triples WHERE {_SPLIT} GROUP BY ALL), n AS (SELECT subject, object, relation, arg_max(source_url, seq) AS u FROM triples WHERE NOT ({_SPLIT}) GROUP BY ALL) SELECT coalesce(o.subject, n.subject) AS src, coalesce(o.object, n.object) AS dst, coalesce(o.relation, n.relation) AS relation, coalesce(n.u, o.u) AS source_url FROM o FULL JOIN n USING (subject, object, relation)"))
def graph_upsert_edges(spark, sf):
    t = triples(spark, sf)
    old, new = t.where(_SPLIT), t.where(f"not ({_SPLIT})")
    return graph.upsert(graph.nodes(old), graph.edges(old), new)[1].select("src", "dst", "relation", "source_url")


@query(with_graph("SELECT count(*) AS rejected FROM triples WHERE seq % 7 = 0"))
def graph_rejects(spark, sf):
    t = triples(spark, sf).withColumn("subject", F.when(F.col("seq") % 7 != 0, F.col("subject")))
    return graph.rejected(t).agg(F.count("*").alias("rejected"))


_ALIAS = "SELECT name, arg_min_c AS canonical FROM (SELECT name, min(name) OVER (PARTITION BY type, left(name, 3)) AS arg_min_c FROM nodes WHERE type IN ('Brand', 'PartType', 'Segment')) WHERE name <> arg_min_c OR true"


def _alias(nodes):
    from pyspark.sql import Window

    few = nodes.where(F.col("type").isin("Brand", "PartType", "Segment"))
    return few.select("name", F.min("name").over(Window.partitionBy("type", F.substr("name", F.lit(1), F.lit(3)))).alias("canonical"))


@query(with_graph(f", al AS ({_ALIAS}), m AS (SELECT coalesce(canonical, name) AS to_, nodes.name, type FROM nodes LEFT JOIN al USING (name)) SELECT to_ AS name, coalesce(max(CASE WHEN name = to_ THEN type END), min(type)) AS type, string_agg(name, '|' ORDER BY name) AS aliases FROM m GROUP BY to_"))
def graph_merge_nodes(spark, sf):
    n, e = graph_of(spark, sf)
    return graph.merged(n, e, _alias(n))[0].select("name", "type", F.array_join("names", "|").alias("aliases"))


@query(with_graph(f", al AS ({_ALIAS}) SELECT coalesce(s.canonical, src) AS src, coalesce(d.canonical, dst) AS dst, relation, arg_max(source_url, seq) AS source_url FROM edges LEFT JOIN al s ON s.name = src LEFT JOIN al d ON d.name = dst GROUP BY ALL"))
def graph_merge_edges(spark, sf):
    n, e = graph_of(spark, sf)
    return graph.merged(n, e, _alias(n))[1].select("src", "dst", "relation", "source_url")


@query(with_graph("SELECT type AS label, name, name AS aliases FROM nodes"))
def export_nodes(spark, sf):
    n = graph.export_tables(*graph_of(spark, sf))[0]
    return n.withColumn("aliases", F.array_join("aliases", "|"))


@query(with_graph('SELECT src AS "start", upper(relation) AS type, dst AS "end", source_url FROM edges'))
def export_edges(spark, sf):
    return graph.export_tables(*graph_of(spark, sf))[1]


@query(with_graph("SELECT src, dst, relation, source_url, seq FROM edges"))
def graph_save_load(spark, sf):
    path = folder(spark, "graph")
    tables.save_graph(*graph_of(spark, sf), path)
    return tables.load_graph(spark, path)[1]


@query(with_graph("SELECT 0 AS nodes, 0 AS edges"))
def graph_load_missing(spark, sf):
    n, e = tables.load_graph(spark, folder(spark, "none"))
    return n.agg(F.count("*").cast("int").alias("nodes")).crossJoin(e.agg(F.count("*").cast("int").alias("edges")))


_DAY = "concat('2024-01-', lpad(CAST(seq % 28 + 1 AS STRING), 2, '0'))"


def _log(spark, sf):
    path = folder(spark, "log")
    tables.append_log(tables.log_entries(triples(spark, sf), F.expr(_DAY)), path)
    return tables.read_log(spark, path)


@query(with_graph(f"SELECT {_DAY} AS timestamp, source_url, count(*)::INT AS triples_count FROM triples GROUP BY ALL".replace("STRING", "VARCHAR")))
def triple_log_append(spark, sf):
    return _log(spark, sf).select("timestamp", "source_url", "triples_count")


@query(with_graph(f"SELECT subject AS src, object AS dst, relation FROM triples WHERE {_DAY} >= '2024-01-15' GROUP BY ALL".replace("STRING", "VARCHAR")))
def triple_log_replay(spark, sf):
    return graph.edges(tables.replay(_log(spark, sf), "2024-01-15")).select("src", "dst", "relation")


@query("SELECT graph, path, modified FROM (SELECT user_id AS graph, event_type || '-' || event_id AS path, event_id AS modified, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, event_type || '-' || event_id DESC) AS n FROM events) WHERE n > 10")
def backup_prune(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("graph"), F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("path"), F.col("event_id").alias("modified"))
    return tables.surplus_backups(e)


@query(with_graph("SELECT (SELECT count(DISTINCT source_url) FROM triples) AS processed_files, (SELECT count(*) FROM nodes) AS total_nodes, (SELECT count(*) FROM edges) AS total_edges, true AS auto_save_enabled, 10 AS save_frequency"))
def progress_report(spark, sf):
    t = triples(spark, sf)
    return tables.progress(graph.nodes(t), graph.edges(t), t)


@query(with_graph("SELECT ['one', 'two', 'three'][seq % 3 + 1] AS session, subject, relation, object, source_url, seq FROM triples"))
def session_triples(spark, sf):
    """All triples, dealt among three sessions and read back session by session."""
    path = folder(spark, "session")
    t = triples(spark, sf).select("subject", "relation", "object", "source_url", "seq")
    names = ("one", "two", "three")
    for k, name in enumerate(names):
        tables.save_session(t.where(F.col("seq") % 3 == k), path, name)
    one, two, three = (tables.load_session(spark, path, name) for name in names)
    return one.unionByName(two).unionByName(three)


_PRE = "('located_in', 'part_of', 'made_by')"
_COUNTS = f"counts AS (SELECT relation, count(*) AS n, CASE WHEN relation IN {_PRE} THEN 'predefined' ELSE 'custom' END AS kind FROM triples GROUP BY relation)"
_NAMES = ("located_in", "part_of", "made_by")


@query(with_graph(f", {_COUNTS} SELECT relation, n, kind FROM counts"))
def relation_counts(spark, sf):
    return extraction.relation_counts(triples(spark, sf), _NAMES)


@query(with_graph(f", {_COUNTS} SELECT kind, count(*) AS relations, sum(n)::BIGINT AS uses, round(sum(n) * 100.0 / sum(sum(n)) OVER (), 6)::DOUBLE AS percentage FROM counts GROUP BY kind"))
def relation_statistics(spark, sf):
    return extraction.relation_statistics(extraction.relation_counts(triples(spark, sf), _NAMES))


@query(with_graph(f", {_COUNTS}, r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, relation) AS place FROM counts) SELECT kind, place::INT AS place, relation, n FROM r WHERE place <= 2 UNION ALL SELECT kind, 0, NULL, count(*) FROM r WHERE place > 2 GROUP BY kind"))
def relation_report(spark, sf):
    return extraction.relation_report(extraction.relation_counts(triples(spark, sf), _NAMES), 2, 2)


_VOCAB = ", ".join(f"('{r}')" for r in vocab.RELATIONS)


@query(with_graph(f", {_COUNTS} SELECT relation FROM counts WHERE kind = 'custom' AND n >= 100 UNION SELECT * FROM (VALUES {_VOCAB}) v(relation)"))
def relation_suggestions(spark, sf):
    return extraction.suggested_relations(extraction.relation_counts(triples(spark, sf), _NAMES), 100)


@query(with_graph(f""", {_COUNTS}, s AS (SELECT kind, count(*) AS relations, sum(n)::BIGINT AS uses FROM counts GROUP BY kind)
SELECT '[' || string_agg('{{"kind":"' || kind || '","relations":' || relations || ',"uses":' || uses || '}}', ',' ORDER BY kind) || ']' AS report FROM s"""))
def relation_report_json(spark, sf):
    s = extraction.relation_statistics(extraction.relation_counts(triples(spark, sf), _NAMES))
    return tables.report_json(s.select("kind", "relations", "uses"))
