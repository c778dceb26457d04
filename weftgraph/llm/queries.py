"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import bpe, lattice, minhash, mixing, quality, revisit, secrets, sketch, token_counts, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.held_out(F.col("doc_id"), 5)
    ranking = quality.fit(docs, table(spark, sf_dir, "labels").where(~out))
    scored = docs.select("doc_id", out.alias("held_out"), quality.score(ranking, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = revisit.resolve(revisit.captures(table(spark, sf_dir, "pages")))
    merged = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return rows.select("record_id", "url_key", "ts", "response_id", "status", merged.alias("merged_headers"), F.floor(F.col("body_id") / 2).alias("body_page_id"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sketch.with_next(table(spark, sf_dir, "documents"), "doc_id", "text", sketched=True)
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), sketch.half_edited(F.col("text"), F.col("next_text")).alias("edited"), "own", "next_own")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", sketch.sketch(F.col("edited")).alias("edited_own"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", sketch.fingerprint(F.col("own")).alias("fingerprint"), sketch.fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
        sketch.containment(F.col("own"), F.col("edited_own")).alias("near_edited"), sketch.containment(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.held_out(F.col("doc_id"), 10)
    rows = lattice.likelihood(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ~out)
    return rows.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "vocabulary_score", "adapted_score", "counted_score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"), secrets.listed(F.col("secret_spans")).alias("spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.measured_mix(mixing.measured(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", *(F.col(f"mix_cell.{d}").alias(f"mix_{d}") for d in ("source", "lang", "topic")), F.col("mix_tokens").alias("n_tokens"), F.round("mix_probability", 6).alias("probability"), F.round("mix_residual", 6).alias("residual"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), path)


def queries() -> dict:
    ops = (op1_quality, op2_vectors, op3_minhash, op4_revisits, op5_fingerprints, op6_lattice, op7_token_counts, op8_secrets, op9_bpe, op10_mixing)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op4_revisits": revisit.ORACLE_SQL, "op5_fingerprints": sketch.ORACLE_SQL, "op8_secrets": secrets.ORACLE_SQL, "op10_mixing": mixing.oracle_sql()}
