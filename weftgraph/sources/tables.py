"""Stored forms of the graph and of datasets: tables, triple log, backups, reports, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TRIPLE = "struct<subject:string,relation:string,object:string,subject_type:string,object_type:string>"
LOG = f"timestamp string, source_url string, triples_count int, triples array<{TRIPLE}>"
NODES = "name string, type string, names array<string>"
EDGES = "src string, dst string, relation string, source_url string, seq bigint"


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a saved graph; empty tables where there is none."""
    from pyspark.errors import AnalysisException

    out = []
    for name, schema in (("nodes", NODES), ("edges", EDGES)):
        try:
            out.append(spark.read.schema(schema).parquet(f"{path}/{name}"))
        except AnalysisException:
            out.append(spark.createDataFrame([], schema))
    return tuple(out)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html, readable) of the html files below a folder; files that are no UTF-8 have no html."""
    text = F.col("content").cast("string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).load(path)
    readable = F.is_valid_utf8(text)
    return files.select("path", F.when(readable, text).alias("html"), readable.alias("readable"))


def scan_counts(scanned: DataFrame) -> DataFrame:
    """One row: files, readable ones, and files left out."""
    return scanned.agg(F.count("*").alias("files"), F.count_if("readable").alias("readable"), F.count_if(~F.col("readable")).alias("skipped"))


def log_entries(triples: DataFrame, timestamp: Column) -> DataFrame:
    """One entry for each source document: (timestamp, source_url, triples_count, triples)."""
    t = F.struct("seq", "subject", "relation", "object", "subject_type", "object_type")
    rows = triples.withColumn("timestamp", timestamp).groupBy("timestamp", "source_url").agg(F.sort_array(F.collect_list(t)).alias("t"))
    plain = F.transform("t", lambda x: F.struct(*(x[c].alias(c) for c in ("subject", "relation", "object", "subject_type", "object_type"))))
    return rows.select("timestamp", "source_url", F.size("t").alias("triples_count"), plain.alias("triples"))


def append_log(entries: DataFrame, path: str) -> None:
    """JSON lines, compressed: entries repeat their names, so plain lines are many times the size of what they hold."""
    entries.write.mode("append").option("compression", "gzip").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def replay(entries: DataFrame, start: str | None = None) -> DataFrame:
    """Triples of the entries from ``start`` on (compared as text), each with its entry's source."""
    rows = entries if start is None else entries.where(F.col("timestamp") >= start)
    rows = rows.select("timestamp", "source_url", F.posexplode("triples").alias("pos", "t"))
    seq = F.conv(F.substr(F.md5(F.concat_ws("|", "timestamp", "source_url", F.col("pos").cast("string"))), F.lit(1), F.lit(15)), 16, 10).cast("bigint")
    return rows.select("timestamp", "source_url", "t.*", seq.alias("seq"))


def surplus_backups(backups: DataFrame, keep: int = 10) -> DataFrame:
    """Backups beyond the newest ``keep`` of each graph: (graph, path, modified) to remove."""
    w = Window.partitionBy("graph").orderBy(F.desc("modified"), F.desc("path"))
    return backups.withColumn("n", F.row_number().over(w)).where(F.col("n") > keep).drop("n")


def progress(nodes: DataFrame, edges: DataFrame, processed: DataFrame, save_frequency: int = 10) -> DataFrame:
    """One row: documents, nodes, edges and settings of a run."""
    n = nodes.agg(F.count("*").alias("total_nodes"))
    e = edges.agg(F.count("*").alias("total_edges"))
    p = processed.agg(F.countDistinct("source_url").alias("processed_files"))
    return p.crossJoin(n).crossJoin(e).withColumn("auto_save_enabled", F.lit(True)).withColumn("save_frequency", F.lit(save_frequency))  # one row each


def save_session(triples: DataFrame, path: str, session: str) -> None:
    triples.withColumn("session", F.lit(session)).write.mode("append").partitionBy("session").json(path)


def load_session(spark: SparkSession, path: str, session: str) -> DataFrame:
    """Triples of one session; totals are counted from them, never from stored totals."""
    return spark.read.schema("subject string, relation string, object string, source_url string, seq bigint, session string").json(path).where(F.col("session") == session)


def save_stage(samples: DataFrame, path: str, stage: str) -> None:
    """A snapshot of samples after a stage, by stage and batch."""
    samples.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage", "batch_id").parquet(path)


def traditional(lines: DataFrame, column: str = "value") -> DataFrame:
    """Validated records in the older form; lines that are not JSON objects with a question are dropped.

    Ids count the kept lines by their place ``pos``.
    """
    r = F.from_json(F.col(column), "id string, question string, answer string, background_story string, validation_status string")
    rows = lines.withColumn("r", r).where("r.question is not null")
    place = F.row_number().over(Window.orderBy("pos")) - 1  # the records of one run
    return rows.select(
        F.concat(F.lit("traditional_"), place.cast("string")).alias("id"), "r.question", "r.answer", F.coalesce("r.background_story", F.lit("")).alias("context"),
        F.array().cast("array<string>").alias("reasoning_path"), F.struct(F.col("r.id").alias("source_id"), F.col("r.validation_status").alias("validation_status")).alias("metadata"),
    )


def report_json(statistics: DataFrame) -> DataFrame:
    """One row: all statistics as a JSON text."""
    fields = F.struct(*statistics.columns)
    return statistics.agg(F.to_json(F.sort_array(F.collect_list(fields))).alias("report"))  # a row for each kind of relation
