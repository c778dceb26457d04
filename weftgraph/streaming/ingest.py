"""Incremental ingest: files of triple-log entries stream into the stored graph, a batch at a time.

Each batch is upserted into the graph of the batch before and stored under its own number, so a batch that is run again
after a failure overwrites its own output and nothing else. Old versions are pruned to a number that is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weftgraph.operators import graph, resolve
from weftgraph.session import checkpointed
from weftgraph.sources import tables


def version(path: str, number: int) -> str:
    return f"{path}/v{number:010d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the stored versions, through the file system that holds them."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v"))


def prune(spark: SparkSession, path: str, keep: int) -> None:
    jvm = spark.sparkContext._jvm
    for n in versions(spark, path)[:-keep]:
        p = jvm.org.apache.hadoop.fs.Path(version(path, n))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def upsert_batch(entries: DataFrame, number: int, path: str, keep: int = 10, merge: bool = False) -> None:
    """Put a batch of log entries into the graph as version ``number``; ``merge`` resolves the names new to the graph
    against all of it."""
    spark = entries.sparkSession
    older = [n for n in versions(spark, path) if n < number]
    nodes, edges = tables.load_graph(spark, version(path, older[-1]) if older else version(path, -1))
    new_nodes, new_edges, fresh = graph.upsert(nodes, edges, tables.replay(entries))
    if merge:
        comp = resolve.components(resolve.matches_of(new_nodes, fresh))
        alias = checkpointed(resolve.alias_map(comp, resolve.vetoed(comp)))
        new_nodes, new_edges = graph.merged(new_nodes, new_edges, alias)
    tables.save_graph(new_nodes, new_edges, version(path, number))
    prune(spark, path, keep)


def ingest(spark: SparkSession, log_path: str, graph_path: str, checkpoint: str, files_per_batch: int = 10, keep: int = 10, merge: bool = False) -> StreamingQuery:
    """A query that takes all log files there are, ``files_per_batch`` at a time, and stops."""
    entries = spark.readStream.schema(tables.LOG).option("maxFilesPerTrigger", files_per_batch).json(log_path)
    run = lambda batch, number: upsert_batch(batch, number, graph_path, keep, merge)
    return entries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    found = versions(spark, path)
    return tables.load_graph(spark, version(path, found[-1]) if found else version(path, -1))

