"""Whole runs: graph from triples, question sets from the graph, by the three strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.text import leaks
from weftgraph.operators import graph, resolve, sampling, synthesis, validation
from weftgraph.session import materialise


def build_graph(triples: DataFrame, merge: bool = True) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of triples, with names resolved."""
    n, e = materialise(graph.nodes(triples), "nodes"), materialise(graph.edges(triples), "edges")
    if merge:
        n, e, _ = resolve.resolve(n, e)
    return n, e


def three_stage(nodes: DataFrame, edges: DataFrame, num: int, batch: int = 10) -> DataFrame:
    """Clue packages, described and woven into stories, with plain questions and verdicts of the fixed branches."""
    p = materialise(sampling.clue_packages(sampling.clue_paths(nodes, edges, strategy="three_stage"), num), "packages")
    p = synthesis.obfuscated(p, synthesis.descriptions(p, "fixed"))
    p = p.withColumn("narrative_story", synthesis.woven(F.map_values("obfuscated_entities"), strategy="three_stage"))
    p = p.withColumn("generated_question", synthesis.plain_question(F.lit(None).cast("string"), F.col("narrative_story").isNotNull()))
    said, final = validation.verdict(F.lit(None).cast("string"), F.col("generated_question") != "")
    return synthesis.batched(p.withColumn("validation_status", said).withColumn("final_status", final), batch)


def integrated(nodes: DataFrame, edges: DataFrame, num: int, chain_ratio: float = 0.5, seed: str = "integrated") -> DataFrame:
    """(sample_id, strategy, question, answer, final_status): chain questions from long walks and entity questions from clues."""
    n = synthesis.split_counts(num, "combined", chain_ratio)
    walks = sampling.long_walk(sampling.numbered(nodes, 20 * n["chain"], seed), graph.neighbours(edges), 8, 4, seed)
    walks = sampling.top(walks, n["chain"], seed + ".keep", "walker")
    chain = walks.select(F.concat(F.lit("chain_"), F.substr(F.md5(F.array_join("path", "|")), F.lit(1), F.lit(8))).alias("sample_id"), "path")
    chain = chain.withColumn("question", synthesis.chain_question(F.col("path"), seed, "sample_id")).withColumn("answer", F.element_at("path", -1))
    _, final = validation.chain_status(F.col("question"), F.col("answer"), F.size("path"))
    chain = chain.select("sample_id", F.lit("chain_of_thought").alias("strategy"), "question", "answer", final.alias("final_status"))
    p = materialise(sampling.clue_packages(sampling.clue_paths(nodes, edges), n["entity"]), "packages")
    rows = p.select("sample_id", F.posexplode("independent_paths").alias("k", "path"))
    t = sampling.path_triples(rows, edges, "sample_id", "k", default="相关于", reverse=True)
    facts = t.groupBy("sample_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "hop", "subject", "relation", "object"))), lambda x: F.struct(x["subject"].alias("subject"), x["relation"].alias("relation"), x["object"].alias("object"))).alias("facts"))
    p = p.join(facts, "sample_id")
    p = p.withColumn("story", synthesis.story(synthesis.fact_statement(F.col("facts")), F.col("answer_entity")))
    p = p.withColumn("question", synthesis.structured_question(F.col("story"), F.col("clue_entities"), seed, "sample_id"))
    final = F.when(leaks(F.col("question"), F.col("answer_entity")), "failed").otherwise("validated")
    return chain.unionByName(p.select("sample_id", "strategy", "question", F.col("answer_entity").alias("answer"), final.alias("final_status")))


def legacy(paths: DataFrame) -> DataFrame:
    """Questions from triples of paths (sample_id, triples): a target of each, its clues as the story."""
    e = sampling.expanded(paths)
    story = synthesis.story(synthesis.fact_statement(F.col("clue_triples")), F.col("target_entity"))
    q = synthesis.with_background(synthesis.legacy_question(F.col("target_relation")), F.col("target_relation"), story)
    return e.select("sample_id", q.alias("question"), F.col("target_entity").alias("answer"), "target_relation", "clue_count")
