"""Queries over path sampling. Random choices are hashes of a seed, so SQL finds the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftgraph.functions import vocab
from weftgraph.operators import graph, sampling
from weftgraph.plans.base import draw_sql, graph_of, order_sql, query, with_graph

_BAR = lambda c: F.array_join(c, "|")


def _walk(steps: int, seed: str, walkers: int) -> str:
    out = f", st AS (SELECT name, row_number() OVER (ORDER BY {order_sql(seed, 'name')}, name) - 1 AS walker FROM nodes), w0 AS (SELECT walker, [name] AS path, name AS node FROM st WHERE walker < {walkers})"
    for k in range(steps):
        out += f", w{k + 1} AS (SELECT walker, list_append(path, dst) AS path, dst AS node FROM w{k} JOIN outs ON outs.src = node JOIN near ON near.src = node AND near.rank = {draw_sql(f'{seed}.{k}', 'walker')} % outs.n)"
    return out


def _top(rows: str, n: int, seed: str, key: str) -> str:
    return f"SELECT * FROM {rows} ORDER BY {order_sql(seed, key)}, {key} LIMIT {n}"


def _pick(values, seed: str, key: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{draw_sql(seed, key)} % {len(values)} + 1]"


_CHAIN = with_graph(_walk(5, "chain", 1500) + f", k AS ({_top('w5', 15, 'chain.keep', 'walker')}) SELECT walker::INT AS walker, array_to_string(path, '|') AS path, node AS target_entity, {_pick(vocab.CHAIN_PAYLOADS, 'chain.type', 'walker')} AS question_payload_type FROM k")


@query(_CHAIN)
def chain_sampling(spark, sf):
    return sampling.chains(*graph_of(spark, sf)).withColumn("path", _BAR("path"))


_FIRST = "rel AS (SELECT src, dst, arg_min(relation, (seq, relation)) AS relation FROM edges GROUP BY ALL)"
_HOPS = "hops AS (SELECT walker, unnest(range(1, len(path))) AS hop, path[unnest(range(1, len(path)))] AS subject, path[unnest(range(1, len(path))) + 1] AS object FROM w3)"


def _walks3(spark, sf):
    n, e = graph_of(spark, sf)
    return sampling.walk(sampling.numbered(n, 200, "w"), graph.neighbours(e), 3, "w"), e


@query(with_graph(_walk(3, "w", 200) + f", {_FIRST}, {_HOPS} SELECT walker::INT AS walker, hop::INT AS hop, subject, coalesce(relation, '相关') AS relation, object FROM hops LEFT JOIN rel ON src = subject AND dst = object"))
def path_triples_first(spark, sf):
    w, e = _walks3(spark, sf)
    return sampling.path_triples(w, e, "walker")


@query(with_graph(_walk(3, "w", 200) + f", rel AS (SELECT src, dst, arg_min(relation, {order_sql('r', 'src', 'relation', 'dst')}) AS relation FROM edges GROUP BY ALL), {_HOPS} SELECT walker::INT AS walker, hop::INT AS hop, subject, coalesce(relation, '相关') AS relation, object FROM hops LEFT JOIN rel ON src = subject AND dst = object"))
def path_triples_random(spark, sf):
    w, e = _walks3(spark, sf)
    return sampling.path_triples(w, e, "walker", seed="r")


@query(with_graph(_walk(3, "w", 200) + f", {_FIRST}, {_HOPS}, rev AS (SELECT walker, hop, object AS subject, subject AS object FROM hops) SELECT walker::INT AS walker, hop::INT AS hop, subject, coalesce(f.relation, '被' || b.relation, '相关于') AS relation, object FROM rev LEFT JOIN rel f ON f.src = subject AND f.dst = object LEFT JOIN rel b ON b.src = object AND b.dst = subject"))
def path_triples_reverse(spark, sf):
    w, e = _walks3(spark, sf)
    h = sampling.hops(w, "walker").select("walker", F.col("hop").alias("at"), F.array("object", "subject").alias("path"))
    t = sampling.path_triples(h, e, "walker", "at", default="相关于", reverse=True)
    return t.select("walker", F.col("at").alias("hop"), "subject", "relation", "object")


@query(with_graph(f""", one AS (SELECT DISTINCT src, dst FROM edges), n AS (SELECT dst, count(*) AS sources FROM one GROUP BY dst), k AS (SELECT CASE WHEN max(sources) >= 3 THEN 3 ELSE 2 END AS k FROM n),
few AS (SELECT dst FROM n, k WHERE sources >= k ORDER BY {order_sql('cross', 'dst')}, dst LIMIT 10), r AS (SELECT dst, src, row_number() OVER (PARTITION BY dst ORDER BY {order_sql('cross.source', 'dst', 'src')}) AS i FROM one JOIN few USING (dst))
SELECT dst AS convergence_node, string_agg(src, '|' ORDER BY i) AS clue_sources, count(*)::INT AS num_clues, arg_min(src, i) AS main_source, coalesce(string_agg(src, '|' ORDER BY i) FILTER (i BETWEEN 2 AND 3), '') AS auxiliary, {_pick(vocab.CROSS_PAYLOADS, 'cross.type', 'dst')} AS question_payload_type FROM r, k WHERE i <= k GROUP BY dst"""))
def cross_referencing(spark, sf):
    return sampling.crossings(graph_of(spark, sf)[1]).withColumn("clue_sources", _BAR("clue_sources")).withColumn("auxiliary", _BAR("auxiliary"))


_DEG = "deg AS (SELECT name, sum(i) AS n_in, sum(o) AS n_out, count(*) AS degree FROM (SELECT src AS name, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY name)"
_ANCH = f"{_DEG}, anchors AS (SELECT name FROM deg WHERE (n_in >= 2 AND n_out >= 2) OR regexp_matches(lower(name), '{vocab.ANCHOR_WORDS}') OR regexp_matches(name, '^[0-9]+$'))"


@query(with_graph(f", {_ANCH} SELECT name FROM anchors"))
def anchor_candidates(spark, sf):
    return sampling.anchors(graph.degrees(graph_of(spark, sf)[1]))


@query(with_graph("SELECT name, CASE " + " ".join(f"WHEN regexp_matches(lower(name), '{p}') THEN '{k}'" for k, p in vocab.ANCHOR_CLASSES) + " ELSE 'general' END AS class FROM nodes"))
def anchor_classes(spark, sf):
    return graph_of(spark, sf)[0].select("name", sampling.anchor_class(F.col("name")).alias("class"))


_P = lambda s: f"{draw_sql('anchor' + s, 'anchor')} < {int(0.6 * (1 << 32))}"


@query(with_graph(f""", {_ANCH}, few AS (SELECT name AS anchor FROM anchors ORDER BY {order_sql('anchor', 'name')}, name LIMIT 100), one AS (SELECT DISTINCT src, dst FROM edges),
i AS (SELECT dst AS anchor, arg_min(src, {order_sql('anchor.in', 'dst', 'src')}) AS source FROM one WHERE dst IN (SELECT anchor FROM few) AND src <> dst GROUP BY dst),
o AS (SELECT src AS anchor, arg_min(dst, {order_sql('anchor.out', 'src', 'dst')}) AS target FROM one JOIN i ON i.anchor = src WHERE dst <> source AND dst <> src GROUP BY src), b AS (SELECT * FROM i JOIN o USING (anchor)),
bf AS (SELECT dst AS source, arg_min(src, {order_sql('anchor.before', 'dst', 'src')}) AS b FROM one GROUP BY dst), af AS (SELECT src AS target, arg_min(dst, {order_sql('anchor.after', 'src', 'dst')}) AS a FROM one GROUP BY src),
p AS (SELECT anchor, a, CASE WHEN {_P('.left')} AND b IS NOT NULL AND NOT list_contains([source, anchor, target], b) THEN [b, source, anchor, target] ELSE [source, anchor, target] END AS path FROM b LEFT JOIN bf USING (source) LEFT JOIN af USING (target)),
q AS (SELECT anchor, CASE WHEN {_P('.right')} AND a IS NOT NULL AND NOT list_contains(path, a) AND len(path) < 4 THEN list_append(path, a) ELSE path END AS path FROM p)
SELECT anchor AS anchor_node, CASE {" ".join(f"WHEN regexp_matches(lower(anchor), '{p}') THEN '{k}'" for k, p in vocab.ANCHOR_CLASSES)} ELSE 'general' END AS pivot_type, array_to_string(path, '|') AS path FROM q ORDER BY {order_sql('anchor.keep', 'anchor')}, anchor LIMIT 10"""))
def anchor_pivots(spark, sf):
    return sampling.pivots(graph_of(spark, sf)[1]).withColumn("path", _BAR("path"))


@query("SELECT * FROM (VALUES ('chain', 12), ('cross', 5), ('anchor', 3)) t(strategy, n)")
def mix_distribution(spark, sf):
    """Samples of each strategy of a mixture of twenty."""
    return sampling.mixture(*graph_of(spark, sf), 20).groupBy("architecture").agg(F.count("*").cast("int").alias("n")).select(
        F.when(F.col("architecture") == "Chain Reasoning", "chain").when(F.col("architecture") == "Cross Referencing", "cross").otherwise("anchor").alias("strategy"), "n")


@query(with_graph("SELECT CASE WHEN count(*) / (SELECT count(*) FROM nodes) > 10 THEN 0.4 WHEN count(*) / (SELECT count(*) FROM nodes) < 3 THEN 0.8 ELSE 0.6 END::DOUBLE AS chain FROM edges"))
def adaptive_mix(spark, sf):
    n, e = graph_of(spark, sf)
    average = graph.size(n, e).first()["average_degree"]
    return spark.createDataFrame([(round(sampling.adaptive_weights("medium", average)["chain"], 6),)], "chain double")


def _long(seed: str, walkers: int, most: int) -> str:
    out = f", st AS (SELECT name, row_number() OVER (ORDER BY {order_sql(seed, 'name')}, name) - 1 AS walker FROM nodes), w0 AS (SELECT walker, [name] AS path, true AS going FROM st WHERE walker < {walkers})"
    for k in range(most - 1):
        out += f""", c{k} AS (SELECT w.walker, w.path, i, near.dst, CASE WHEN near.dst IS NULL THEN NULL WHEN NOT list_contains(w.path[-least(3, len(w.path)):], near.dst) THEN 0 WHEN NOT list_contains(w.path[-least(2, len(w.path)):], near.dst) THEN 1 END AS choice
FROM w{k} w LEFT JOIN outs ON w.going AND outs.src = w.path[-1] LEFT JOIN (SELECT unnest(range(4)) AS i) tries ON i < least(outs.n, 4) LEFT JOIN near ON near.src = w.path[-1] AND near.rank = ({draw_sql(f'{seed}.{k}', 'w.walker')} + i) % outs.n AND w.going),
w{k + 1} AS (SELECT walker, CASE WHEN count(choice) > 0 THEN list_append(any_value(path), arg_min(dst, choice * 10 + i) FILTER (choice IS NOT NULL)) ELSE any_value(path) END AS path, count(choice) > 0 AS going FROM c{k} GROUP BY walker)"""
    return out


_LONG = _long("long", 60, 8)


@query(with_graph(_LONG + " SELECT walker::INT AS walker, array_to_string(path, '|') AS path FROM w7 WHERE len(path) >= 4"))
def long_walks(spark, sf):
    n, e = graph_of(spark, sf)
    return sampling.long_walk(sampling.numbered(n, 60, "long"), graph.neighbours(e), 8, 4, "long").withColumn("path", _BAR("path"))


@query()
def path_novelty(spark, sf):
    """Of several long walks from each start, those unlike the accepted earlier ones."""
    n, e = graph_of(spark, sf)
    few = sampling.numbered(n, 20, "novel").select(F.explode(F.array(*(F.col("walker") * 3 + k for k in range(3)))).alias("walker"), "name")
    w = sampling.long_walk(few, graph.neighbours(e), 8, 4, "novel").withColumn("start", F.element_at("path", 1))
    return sampling.novel(w, "start").withColumn("path", _BAR("path"))


_CLUE = f"""one AS (SELECT DISTINCT src, dst FROM edges WHERE src <> dst), many AS (SELECT dst AS answer FROM one GROUP BY dst HAVING count(*) >= 2),
i AS (SELECT dst AS answer, [src, dst] AS path, row_number() OVER (PARTITION BY dst ORDER BY {order_sql('clue', 'dst', 'src')}, src) AS k FROM one WHERE dst IN (SELECT answer FROM many)),
o AS (SELECT src AS answer, [src, dst] AS path, row_number() OVER (PARTITION BY src ORDER BY {order_sql('clue', 'src', 'dst')}, dst) AS k FROM one WHERE src NOT IN (SELECT answer FROM many)),
clues AS (SELECT * FROM i WHERE k <= 4 UNION ALL SELECT * FROM o WHERE k <= 4)"""


@query(with_graph(f", {_CLUE} SELECT answer, k::INT AS k, array_to_string(path, '|') AS path FROM clues"))
def clue_paths(spark, sf):
    return sampling.clue_paths(*graph_of(spark, sf)).withColumn("path", _BAR("path"))


@query()
def clue_paths_three_stage(spark, sf):
    return sampling.clue_paths(*graph_of(spark, sf), strategy="three_stage").withColumn("path", _BAR("path"))


_PACK = f"""{_CLUE}, g AS (SELECT answer, list(path ORDER BY k) AS paths FROM clues GROUP BY answer HAVING count(*) >= 2), packs AS (SELECT 'multi_clue_' || substr(md5(answer), 1, 8) || '_' || len(paths) AS sample_id, answer AS answer_entity, paths,
list_transform(paths, lambda p: CASE WHEN p[-1] <> answer THEN p[-1] ELSE p[-2] END) AS clue_entities, len(paths) AS num_clue_paths FROM g ORDER BY {order_sql('package', 'answer')}, answer LIMIT 40)"""


@query(with_graph(f", {_PACK} SELECT sample_id, answer_entity, array_to_string(clue_entities, '|') AS clue_entities, num_clue_paths::INT AS num_clue_paths FROM packs"))
def clue_packages(spark, sf):
    return sampling.clue_packages(sampling.clue_paths(*graph_of(spark, sf)), 40).select("sample_id", "answer_entity", _BAR("clue_entities").alias("clue_entities"), "num_clue_paths")


@query(with_graph(f", {_CLUE} SELECT count(DISTINCT answer) AS answers FROM (SELECT answer FROM clues GROUP BY answer HAVING count(*) >= 2)"))
def clue_aggregation(spark, sf):
    c = sampling.clue_paths(*graph_of(spark, sf)).groupBy("answer").agg(F.count("*").alias("c")).where("c >= 2")
    return c.agg(F.count("*").alias("answers"))


@query(with_graph(""", one AS (SELECT DISTINCT src, dst FROM edges), pairs AS (SELECT c.name AS source, r.name AS target FROM nodes c, nodes r WHERE c.type = 'Supplier' AND r.type = 'Region'),
h1 AS (SELECT source, target, dst AS node, [source, dst] AS path FROM pairs JOIN one ON src = source),
h2 AS (SELECT source, target, dst AS node, min(list_append(path, dst)) AS path FROM h1 JOIN one ON src = node GROUP BY ALL), h3 AS (SELECT source, target, dst AS node, min(list_append(path, dst)) AS path FROM h2 JOIN one ON src = node GROUP BY ALL),
f AS (SELECT *, 1 AS n FROM h1 UNION ALL SELECT *, 2 FROM h2 UNION ALL SELECT *, 3 FROM h3)
SELECT source, target, min(n)::INT AS n, array_to_string(arg_min(path, n), '|') AS path FROM f WHERE node = target GROUP BY ALL"""))
def node_to_node(spark, sf):
    n, e = graph_of(spark, sf)
    regions = n.where("type = 'Region'").select(F.col("name").alias("target"))  # five names
    pairs = n.where("type = 'Supplier'").select(F.col("name").alias("source")).join(F.broadcast(regions), F.lit(True))
    return sampling.shortest(e, pairs).withColumn("path", _BAR("path"))


@query()
def adaptive_mixture(spark, sf):
    return sampling.adaptive_mixture(*graph_of(spark, sf), 50, "medium").withColumn("path", _BAR("path"))


def samples(spark, sf):
    """Chain paths as triples: (sample_id, triples)."""
    n, e = graph_of(spark, sf)
    w = sampling.walk(sampling.numbered(n, 200, "w"), graph.neighbours(e), 3, "w")
    t = sampling.path_triples(w, e, "walker")
    g = t.groupBy("walker").agg(F.sort_array(F.collect_list(F.struct("hop", "subject", "relation", "object"))).alias("t"))
    return g.select(F.concat(F.lit("s"), F.col("walker").cast("string")).alias("sample_id"), F.transform("t", lambda x: F.struct(x["subject"].alias("subject"), x["relation"].alias("relation"), x["object"].alias("object"))).alias("triples"))


SAMPLES = _walk(3, "w", 200) + f", {_FIRST}, {_HOPS}, tr AS (SELECT walker, hop, subject, coalesce(relation, '相关') AS relation, object FROM hops LEFT JOIN rel ON src = subject AND dst = object), smp AS (SELECT 's' || walker AS sample_id, list({{'subject': subject, 'relation': relation, 'object': object}} ORDER BY hop) AS triples FROM tr GROUP BY walker)"


@query(with_graph(SAMPLES + f""", en AS (SELECT sample_id, triples, unnest(list_distinct(flatten(list_transform(triples, lambda t: [t.subject, t.object])))) AS e FROM smp), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY {order_sql('expand', 'sample_id', 'e')}, e) AS i FROM en),
k AS (SELECT *, list_filter(triples, lambda t: t.object = e) AS hit FROM r WHERE i <= 2)
SELECT sample_id || '_' || i AS sample_id, CASE WHEN len(hit) > 0 THEN e ELSE triples[-1].object END AS target_entity, CASE WHEN len(hit) > 0 THEN hit[-1].relation ELSE triples[-1].relation END AS target_relation,
(CASE WHEN len(hit) > 0 THEN len(triples) - len(hit) ELSE len(triples) - 1 END)::INT AS clue_count, array_to_string(list_transform(triples, lambda t: '(' || t.subject || ',' || t.relation || ',' || t.object || ')'), ' -> ') AS reasoning_chain_raw FROM k"""))
def path_expansion(spark, sf):
    return sampling.expanded(samples(spark, sf)).select("sample_id", "target_entity", "target_relation", "clue_count", "reasoning_chain_raw")
