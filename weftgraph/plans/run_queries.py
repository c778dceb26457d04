"""Queries over whole runs and the streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftgraph.plans import generation
from weftgraph.plans.base import graph_of, query, triples, with_graph
from weftgraph.plans.graph_queries import folder
from weftgraph.plans.sample_queries import SAMPLES, samples
from weftgraph.session import materialise, tasks_for
from weftgraph.sources import tables
from weftgraph.streaming import ingest


@query(with_graph("SELECT src, dst, relation FROM edges"))
def streaming_ingest(spark, sf):
    """The graph after all log files have streamed in, in two batches: as the graph of all triples at once.

    The source of an edge is that of its last batch, which the order of arrival decides, so it is not compared.
    """
    log, out, state = folder(spark, "log"), folder(spark, "graph"), folder(spark, "state")
    days = F.concat(F.lit("day-"), F.lpad((F.col("seq") / 1000000000000).cast("int").cast("string"), 4, "0"))
    t = triples(spark, sf)
    half = -(-tasks_for(t) // 2)
    # in this order, as a shuffle by the entries' own keys would be taken for the one that made them, and its parts merged
    tables.append_log(tables.log_entries(t, days).repartition(2 * half, "source_url", "timestamp"), log)
    ingest.ingest(spark, log, out, state, files_per_batch=half).awaitTermination()
    return ingest.latest(spark, out)[1].select("src", "dst", "relation")


@query()
def run_three_stage(spark, sf):
    n, e = (materialise(x, "graph") for x in graph_of(spark, sf))
    return generation.three_stage(n, e, 30).select("sample_id", "answer_entity", "narrative_story", "generated_question", "final_status", "batch_id")


@query()
def run_integrated(spark, sf):
    n, e = (materialise(x, "graph") for x in graph_of(spark, sf))
    return generation.integrated(n, e, 30)


@query(with_graph(SAMPLES + " SELECT count(*) * 2 AS questions FROM smp"))
def run_legacy(spark, sf):
    q = generation.legacy(samples(spark, sf))
    return q.where(F.col("question").endswith("是什么吗？") & F.col("answer").isNotNull()).agg(F.count("*").alias("questions"))
