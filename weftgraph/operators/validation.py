"""Validation, scores, records and summaries of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.text import leaks

SPECIFICITY = 2.5


def chain_status(question: Column, answer: Column, length: Column) -> tuple[Column, Column]:
    """(validation_status, final_status) of chain questions."""
    has = (F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != "") & (F.coalesce(length, F.lit(0)) >= 4)
    held = F.contains(F.lower(question), F.lower(answer))
    said = F.when(~has, "失败：缺少必要字段").when(held, "失败：问题包含答案").otherwise("通过")
    return said, F.when(said == "通过", "validated").otherwise("failed")


def verdict(reply: Column, eligible: Column, compat: bool = False) -> tuple[Column, Column]:
    """(validation_status, final_status) from a verdict's text; null text is a failed call.

    ``compat`` takes every text that holds 通过 as passed, also 不通过.
    """
    passed = F.contains(reply, F.lit("通过")) & (F.lit(compat) | ~F.contains(reply, F.lit("不通过")))
    said = F.when(~eligible, "无效问题").when(reply.isNull(), "API失败").when(passed, "通过").otherwise("不通过")
    return said, F.when(~eligible, "invalid").when(said == "通过", "validated").otherwise("validation_failed")


def local_verdict(reply: Column, question: Column, answer: Column) -> Column:
    """The verdict, or where it is missing or negative whether the question leaks the answer."""
    ok = F.coalesce(F.contains(reply, F.lit("通过")) & ~F.contains(reply, F.lit("不通过")), F.lit(False))
    return F.when(ok | ~leaks(question, answer), "validated").otherwise("failed")


def sample_quality(samples: DataFrame) -> DataFrame:
    """One row: shares of samples whose clues do not hold the answer, whose target is not the path's end, and of valid ones."""
    clue = ~F.contains(F.lower("integrated_clue_statement"), F.lower("answer"))
    full = (F.coalesce("integrated_clue_statement", F.lit("")) != "") & (F.coalesce("final_question", F.lit("")) != "") & (F.coalesce("answer", F.lit("")) != "")
    share = lambda c: F.round(F.coalesce(F.avg(F.when(c, 1.0).otherwise(0.0)), F.lit(0.0)), 6)
    return samples.agg(share(full & clue).alias("valid"), share(full & clue).alias("clue_purity"), share(full & (F.col("target_entity") != F.col("path_end"))).alias("target_diversity"))


def complexity(paths: DataFrame, nodes: DataFrame, *keys: str) -> DataFrame:
    """(keys, path_length, domain_jumps, overall): hops, changes of type along the triples of a path, and their product."""
    ends = paths.select(*keys, F.col("subject").alias("name")).unionByName(paths.select(*keys, F.col("object").alias("name")))
    types = ends.join(nodes.select("name", "type"), "name", "left").groupBy(*keys).agg(F.countDistinct(F.coalesce("type", F.lit("Unknown"))).alias("types"))
    out = paths.groupBy(*keys).agg(F.count("*").alias("path_length")).join(types, list(keys))
    jumps = F.greatest(F.col("types") - 1, F.lit(0))
    return out.select(*keys, "path_length", jumps.alias("domain_jumps"), (F.col("path_length") * (1 + jumps) * SPECIFICITY).alias("overall"))


def evidence(paths: DataFrame, edges: DataFrame, *keys: str) -> DataFrame:
    """(keys, supporting_evidence): source URLs of a path's edges in order, each once."""
    e = edges.select(F.col("src").alias("subject"), F.col("dst").alias("object"), "relation", "source_url")
    rows = paths.join(e, ["subject", "object", "relation"], "left")
    urls = F.transform(F.sort_array(F.collect_list(F.when(F.col("source_url").isNotNull(), F.struct("hop", "source_url")))), lambda x: x["source_url"])
    return rows.groupBy(*keys).agg(F.array_distinct(urls).alias("supporting_evidence"))


def final_records(samples: DataFrame, scores: DataFrame, proof: DataFrame, key: str) -> DataFrame:
    """Records with an id, scores, evidence and flags; ids follow the order of the key."""
    place = F.row_number().over(Window.orderBy(key)) - 1  # the samples of one run
    rows = samples.join(scores, key).join(proof, key, "left").withColumn("id", F.format_string("mq_id_%05d", place))
    return rows.select(
        "id", "question", "answer", F.struct("path_length", "domain_jumps", F.lit(SPECIFICITY).alias("constraint_specificity"), "overall").alias("complexity_scores"),
        F.col("architecture").alias("reasoning_architecture"), "supporting_evidence", F.struct(F.lit(True).alias("is_factually_grounded"), F.lit(False).alias("passed_solver_llm"), F.lit(False).alias("passed_human_review")).alias("validation_flags"),
    )


def validated(samples: DataFrame) -> DataFrame:
    """The projection of validated samples with lengths and counts."""
    n = lambda c: F.char_length(F.coalesce(c, F.lit("")))
    return samples.where("final_status = 'validated'").select(
        F.col("sample_id").alias("id"), F.col("generated_question").alias("question"), F.col("answer_entity").alias("answer"), F.col("narrative_story").alias("background_story"), "clue_entities", "num_clue_paths", "validation_status",
        F.struct((n("narrative_story") > 0).alias("has_background"), n("generated_question").alias("question_length"), n("narrative_story").alias("story_length"), F.size("clue_entities").alias("clue_count")).alias("generation_metadata"),
    )


def simple(records: DataFrame) -> DataFrame:
    return records.select("question", "answer")


def detailed(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", "strategy", "answer_entity", "independent_paths", "clue_entities", "narrative_story", "generated_question", "validation_status", "final_status")


def summary(samples: DataFrame) -> DataFrame:
    """One row: totals, validation rate, and means over validated samples."""
    ok = F.col("final_status") == "validated"
    mean = lambda c: F.round(F.coalesce(F.avg(F.when(ok, c)), F.lit(0.0)), 6)
    rate = F.round(F.coalesce(F.avg(F.when(ok, 100.0).otherwise(0.0)), F.lit(0.0)), 6)
    return samples.agg(
        F.count("*").alias("total_samples"), F.count_if(ok).alias("validated_count"), rate.alias("validation_rate"),
        mean(F.char_length("generated_question")).alias("avg_question_len"), mean(F.char_length("narrative_story")).alias("avg_story_len"), mean(F.size("clue_entities")).alias("avg_clue_count"),
    )


def status_distribution(samples: DataFrame) -> DataFrame:
    return samples.groupBy(F.coalesce("final_status", F.lit("unknown")).alias("final_status")).agg(F.count("*").alias("n"))


def strategy_summary(samples: DataFrame) -> DataFrame:
    """One row: samples of each strategy, validated ones, rate."""
    ok = F.col("final_status") == "validated"
    return samples.agg(
        F.count("*").alias("total_samples"), F.count_if(F.col("strategy") == "chain_of_thought").alias("chain_samples"), F.count_if(F.col("strategy") == "multi_source_clue_aggregation").alias("entity_samples"),
        F.count_if(ok).alias("validated_count"), F.round(F.coalesce(F.avg(F.when(ok, 100.0).otherwise(0.0)), F.lit(0.0)), 6).alias("validation_rate"), F.count_if(ok).alias("simple_count"),
    )


def contextual_metrics(rows: DataFrame) -> DataFrame:
    """One row: share with background, mean length, share with answers, mean number of clues."""
    part = lambda c: F.round(F.coalesce(F.avg(F.when(c, 100.0).otherwise(0.0)), F.lit(0.0)), 6)
    return rows.agg(part(F.col("background") != "").alias("context_percentage"), F.round(F.avg(F.char_length("question")), 6).alias("avg_length"), part(F.coalesce("answer", F.lit("")) != "").alias("answer_percentage"), F.round(F.avg("clue_count"), 6).alias("avg_clue_count"))


def run_grade(rate: Column) -> Column:
    """Bucket of a run by its validation rate."""
    return F.when(rate < 60, "low").when(rate > 80, "high").otherwise("medium")


def conversion_summary(samples: DataFrame, contextual: DataFrame, plain: DataFrame) -> DataFrame:
    """One row: samples, contextual and plain questions made of them, their bytes as JSON lines, and the rate in percent
    (null without samples)."""
    of = lambda rows, n: rows.select(F.to_json(F.struct("*")).alias("line")).agg(F.count("*").alias(f"{n}_count"), F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0)).alias(f"{n}_bytes"))
    rows = samples.agg(F.count("*").alias("original_samples")).crossJoin(of(contextual, "contextual")).crossJoin(of(plain, "simple"))  # three rows of one
    return rows.withColumn("conversion_rate", F.round(F.when(F.col("original_samples") > 0, F.col("contextual_count") * 100 / F.col("original_samples")), 1))
