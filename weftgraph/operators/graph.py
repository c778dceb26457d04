"""The graph: nodes and edges from triples, degrees, neighbours, merging.

Triples are rows (subject, relation, object, source_url, seq, subject_type, object_type). Rows without a subject,
relation or object go to ``rejected``; they never reach the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def accepted(triples: DataFrame) -> DataFrame:
    return triples.where("subject is not null and relation is not null and object is not null and subject != '' and relation != '' and object != ''")


def rejected(triples: DataFrame) -> DataFrame:
    return triples.where("not coalesce(subject != '' and relation != '' and object != '', false)")


def nodes(triples: DataFrame) -> DataFrame:
    """(name, type, names): the first type seen counts.

    The first place of each (name, type, side) is a number, which a hash table holds; only those few rows are sorted for
    the text that ``min_by`` returns, so a task's memory follows its distinct names and not its triples.
    """
    side = lambda c, k: F.struct(F.col(c).alias("name"), F.coalesce(f"{c}_type", F.lit(UNKNOWN)).alias("type"), F.lit(k).alias("k"))
    both = accepted(triples).select("seq", F.explode(F.array(side("subject", 0), side("object", 1))).alias("n")).select("seq", "n.name", "n.type", "n.k")
    first = both.groupBy("name", "type", "k").agg(F.min("seq").alias("seq"))
    return first.groupBy("name").agg(F.min_by("type", F.struct("seq", "k", "type")).alias("type")).withColumn("names", F.array("name"))


def edges(triples: DataFrame) -> DataFrame:
    """(src, dst, relation, source_url, seq): one for each triple of names, the last source counts, ``seq`` is the first."""
    keys = [F.col("subject").alias("src"), F.col("object").alias("dst"), "relation"]
    return accepted(triples).groupBy(*keys).agg(F.max_by("source_url", "seq").alias("source_url"), F.min("seq").alias("seq"))


def upsert(old_nodes: DataFrame, old_edges: DataFrame, triples: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes and edges with new triples, and the nodes that are new. Types of known nodes stay; sources are replaced."""
    n, e = nodes(triples), edges(triples)
    fresh = n.join(old_nodes, "name", "left_anti")
    kept = old_edges.join(e, ["src", "dst", "relation"], "left_anti")
    first = old_edges.select("src", "dst", "relation", F.col("seq").alias("was"))
    new = e.join(first, ["src", "dst", "relation"], "left").select("src", "dst", "relation", "source_url", F.coalesce("was", "seq").alias("seq"))
    return old_nodes.unionByName(fresh), kept.unionByName(new), fresh


def degrees(edges: DataFrame) -> DataFrame:
    """(name, n_in, n_out, degree), parallel edges counted."""
    both = edges.select(F.col("src").alias("name"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("dst").alias("name"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return both.groupBy("name").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.count("*").alias("degree"))


def neighbours(edges: DataFrame) -> DataFrame:
    """(src, rank, dst): distinct successors, numbered from 0 in their order. A walker picks one by number."""
    d = edges.select("src", "dst").distinct()
    return d.select("src", (F.row_number().over(Window.partitionBy("src").orderBy("dst")) - 1).alias("rank"), "dst")


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, successors): distinct and sorted. For reports; walkers use ``neighbours``, whose rows stay small."""
    return edges.groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("successors"))


def size(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: total_nodes, total_edges, average_degree."""
    n, e = nodes.agg(F.count("*").alias("total_nodes")), edges.agg(F.count("*").alias("total_edges"))
    return n.crossJoin(e).withColumn("average_degree", F.coalesce(F.try_divide("total_edges", "total_nodes"), F.lit(0.0)))  # one row each


def large_enough(nodes: DataFrame, least: int = 10) -> DataFrame:
    """One row: whether the graph has the nodes that generation asks for."""
    return nodes.agg((F.count("*") >= least).alias("large_enough"))


def merged(nodes: DataFrame, edges: DataFrame, alias: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph with every name of ``alias`` (name, canonical) replaced; names are joined, equal edges become one."""
    n = nodes.join(alias, "name", "left").withColumn("to", F.coalesce("canonical", "name"))
    n = n.groupBy("to").agg(F.coalesce(F.max(F.when(F.col("name") == F.col("to"), F.col("type"))), F.min("type")).alias("type"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    e = edges.join(alias.select(F.col("name").alias("src"), F.col("canonical").alias("s")), "src", "left").join(alias.select(F.col("name").alias("dst"), F.col("canonical").alias("d")), "dst", "left")
    e = e.groupBy(F.coalesce("s", "src").alias("src"), F.coalesce("d", "dst").alias("dst"), "relation").agg(F.max_by("source_url", F.struct("seq", "source_url")).alias("source_url"), F.min("seq").alias("seq"))
    return n.withColumnRenamed("to", "name"), e


def export_tables(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables for a graph database: labelled nodes with aliases, edges with upper-case types."""
    n = nodes.select(F.col("type").alias("label"), "name", F.col("names").alias("aliases"))
    e = edges.select(F.col("src").alias("start"), F.upper(F.regexp_replace("relation", " ", "_")).alias("type"), F.col("dst").alias("end"), "source_url")
    return n, e
