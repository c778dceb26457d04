"""Command line: crawl pages, build the graph, generate questions, export tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import graph, pages, sampling, validation
from weftgraph.plans import generation
from weftgraph.session import local_session, materialise
from weftgraph.sources import tables
from weftgraph.streaming import ingest


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m weftgraph", description=__doc__)
    p.add_argument("--work", required=True, help="folder of the log, the graph and the outputs")
    p.add_argument("--run-scraper", action="store_true", help="crawl from --seeds over --pages")
    p.add_argument("--seeds", help="text file of URLs")
    p.add_argument("--pages", help="Parquet table of (page_id, url, html)")
    p.add_argument("--build-graph", action="store_true", help="take the triple log, WORK/log, into the graph and resolve names")
    p.add_argument("--generate-questions", action="store_true")
    p.add_argument("--save-to-neo4j", action="store_true", help="write tables of nodes and edges for a graph database")
    p.add_argument("--save-frequency", type=int, default=1, help="log files between two saved versions of the graph")
    p.add_argument("--start-from", type=int, default=0, help="leave out as many source documents, in the order of their keys")
    p.add_argument("--num-questions", type=int, default=5000)
    p.add_argument("--batch-size", type=int, default=10)
    p.add_argument("--use-old-strategy", action="store_true", help="questions from triples of paths")
    return p


def legacy_paths(nodes, edges, num: int):
    """(sample_id, triples) of ``num`` walks."""
    walks = sampling.walk(sampling.numbered(nodes, num, "legacy"), graph.neighbours(edges), 3, "legacy")
    rows = sampling.path_triples(walks, edges, "walker").groupBy("walker").agg(F.sort_array(F.collect_list(F.struct("hop", "subject", "relation", "object"))).alias("t"))  # three hops
    return rows.select(F.concat(F.lit("s"), F.col("walker").cast("string")).alias("sample_id"), F.transform("t", lambda x: x.dropFields("hop")).alias("triples"))


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    log, store = f"{args.work}/log", f"{args.work}/graph"
    if args.start_from:
        entries = tables.read_log(spark, log).withColumns({"url": F.col("source_url"), "page_id": F.col("timestamp")})
        rest = pages.after_offset(entries, args.start_from).select(*tables.read_log(spark, log).columns)
        number = max(ingest.versions(spark, store), default=-1) + 1
        ingest.upsert_batch(rest, number, store, merge=True)
    else:
        ingest.ingest(spark, log, store, f"{args.work}/state", args.save_frequency, merge=True).awaitTermination()


def generate(spark: SparkSession, args: argparse.Namespace) -> None:
    n, e = (materialise(x, "graph") for x in ingest.latest(spark, f"{args.work}/graph"))
    if args.use_old_strategy:
        generation.legacy(legacy_paths(n, e, args.num_questions)).limit(args.num_questions).write.mode("overwrite").json(f"{args.work}/questions")
        return
    rows = materialise(generation.three_stage(n, e, args.num_questions, args.batch_size), "questions")
    good = rows.where("final_status = 'validated'").select(F.col("generated_question").alias("question"), F.col("answer_entity").alias("answer"))
    validation.detailed(rows).write.mode("overwrite").json(f"{args.work}/questions")
    validation.simple(good).write.mode("overwrite").json(f"{args.work}/simple")
    validation.conversion_summary(rows, rows.where("final_status = 'validated'"), good).write.mode("overwrite").json(f"{args.work}/summary")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.run_scraper and not (args.seeds and args.pages):
        parser().error("--run-scraper needs --seeds and --pages")
    spark = spark or local_session()
    if args.run_scraper:
        start = pages.seeds(spark.read.text(args.seeds))
        pages.crawl(spark, start, spark.read.parquet(args.pages)).write.mode("overwrite").parquet(f"{args.work}/crawl")
    if args.build_graph:
        build(spark, args)
    if args.generate_questions:
        generate(spark, args)
    if args.save_to_neo4j:
        for name, rows in zip(("nodes", "edges"), graph.export_tables(*ingest.latest(spark, f"{args.work}/graph"))):
            rows.write.mode("overwrite").parquet(f"{args.work}/export/{name}")


if __name__ == "__main__":
    main()
