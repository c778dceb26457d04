"""A corpus pipeline: each stage reads what the one before it kept.

Every stage takes null, empty and very long texts, ties, repeated rows, empty tables and more columns than those of
documents (which it drops); an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import bpe, minhash, mixing, quality, secrets
from weftgraph.session import drop_written, materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject, as they are.

    Null text is scored as the empty text; without labels of both kinds none is rejected; repeated rows share their fate.
    """
    ranking = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(ranking, F.col("text")) >= 0.3).select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id. Groups are linked at 0.8, the bound for
    near duplicates where no contract says otherwise (op3's says 0.85).

    Null, empty and wordless texts are alike to nothing. Of several rows of one id the one of the smallest text stays;
    rows without an id stay.
    """
    docs = docs.select(COLUMNS)
    found = materialise(minhash.near_duplicates(docs, percent=80).select("doc_id", "kept"), "near-duplicates")
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    several = ids.where("kept and n > 1").select("doc_id")
    single = minhash.picked(docs, ids.where("not kept or n > 1").select("doc_id"), keep=False)
    rest = [c for c in COLUMNS if c != "doc_id"]
    least = minhash.picked(docs, several).groupBy("doc_id").agg(F.min(F.struct("text", *(c for c in rest if c != "text"))).alias("row"))
    return single.unionByName(least.select("doc_id", *(F.col(f"row.{c}").alias(c) for c in rest))).select(COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked and ``n_chars`` counted anew. Null text stays null, with null ``n_chars``."""
    text = secrets.masked(F.col("text"), F.col("secret_spans"))
    return secrets.scan(docs.select(COLUMNS)).withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target mixture of sources, languages and topics, as they are.

    Null sources and languages fall under the rest; texts without words follow their cell; repeated rows share their
    fate, and so do all rows without an id in a cell.
    """
    return mixing.documents_mix(docs.select(COLUMNS)).select(COLUMNS)


def encode_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and digest of the text that they decode to.

    Null text has no ids; every row has its own result, whatever its id.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoded_digests(docs, path)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", one_of_each),
    ("secrets", mask_secrets),
    ("mixture", to_target_weights),
    ("bpe", encode_round_trip),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it; what only a stage itself needed goes then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
            drop_written(spark, keep=docs)
    return docs
