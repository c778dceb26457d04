"""Question synthesis: what is done without a model, and where a model's reply would go.

Every stage takes the reply of a model where there is one and otherwise its fixed branch. A reply is a struct
(ok, text, error), so the text of an error is never taken for an answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions import vocab
from weftgraph.functions.text import draw, general_description, generic_description, leaks


def numbered_lines(reply: Column, prefix: str, expected: Column) -> Column:
    """Contents of numbered lines, exactly ``expected`` of them: missing ones say so, further ones are cut off."""
    lines = F.filter(F.transform(F.split(reply, "\n"), lambda x: F.trim(x)), lambda x: x != "")

    def content(x: Column) -> Column:
        after = F.when(F.contains(x, F.lit(":")), F.regexp_extract(x, "^[^:]*:(.*)$", 1)).otherwise(F.regexp_extract(x, "^[^：]*：(.*)$", 1))
        labelled = F.contains(x, F.lit(prefix + " ")) & x.rlike("[:：]")
        number = x.rlike(r"^[0-9]") & F.contains(x, F.lit(". "))
        bare = F.regexp_replace(F.replace(x, F.lit(prefix), F.lit("")), "^[0-9: ：.]+", "")
        return F.when(labelled, F.trim(after)).when(number, F.trim(F.regexp_extract(x, r"^.*?\. (.*)$", 1))).when(x.startswith(prefix), F.trim(bare))

    got = F.filter(F.transform(lines, content), lambda x: x.isNotNull() & (x != ""))
    got = F.transform(got, lambda x: F.regexp_replace(x, "^[\\[\\]\"']+|[\\[\\]\"']+$", ""))
    return F.slice(F.concat(got, F.array_repeat(F.lit("Error: 解析失败"), expected)), F.lit(1), expected)


def pattern_lines(reply: Column, prefix: str, expected: Column, separator: str | None = None) -> Column:
    """Contents of more than five characters by the first pattern that gives any: labelled, numbered, what follows the
    ``separator`` (a pattern without groups) if one is given, or whole lines."""
    lines = F.filter(F.transform(F.split(F.trim(reply), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    by = lambda p, g: F.filter(F.transform(lines, lambda x: F.trim(F.regexp_extract(x, p, g))), lambda x: F.char_length(x) > 5)
    a, b, c = by(rf"{prefix}\s*([0-9]+)\s*[:：]\s*(.+)", 2), by(r"([0-9]+)[.)]\s*(.+)", 2), by("(.+)", 1)
    d = by(f".+?(?:{separator})(.+)", 1) if separator else F.array().cast("array<string>")
    return F.slice(F.when(F.size(a) > 0, a).when(F.size(b) > 0, b).when(F.size(d) > 0, d).otherwise(c), F.lit(1), expected)


def batched(samples: DataFrame, size: int = 10, key: str = "sample_id") -> DataFrame:
    """``samples`` with the batch and place of each: ceil(n / size) batches, in the order of a hash of the key."""
    # a global rank from ranks within hash ranges and the sizes of the 4,096 ranges
    ranged = samples.withColumn("range", F.substr(F.md5(F.col(key)), F.lit(1), F.lit(3)))
    sizes = ranged.groupBy("range").agg(F.count("*").alias("c"))
    before = sizes.select("range", (F.sum("c").over(Window.orderBy("range")) - F.col("c")).alias("before"))
    i = F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(key)) - 1
    rows = ranged.join(F.broadcast(before), "range").withColumn("i", i)
    return rows.withColumn("batch_id", F.floor(F.col("i") / size)).withColumn("place", (F.col("i") % size).cast("int")).drop("range", "before", "i")


def fact_statement(facts: Column) -> Column:
    """Subject, relation and object of each fact, as sentences; a fixed one without facts."""
    said = F.array_join(F.transform(facts, lambda f: F.concat_ws(" ", f["subject"], f["relation"], f["object"])), "。")
    return F.when(F.coalesce(F.size(facts), F.lit(0)) > 0, F.concat(said, F.lit("。"))).otherwise(vocab.NO_FACTS)


def entity_context(entity: Column, facts: Column, most: int = 3) -> Column:
    """What the facts say of an entity, three at most."""
    said = F.transform(facts, lambda f: F.when(f["subject"] == entity, F.concat(f["relation"], f["object"])).when(f["object"] == entity, F.concat(F.lit("被"), f["subject"], f["relation"])))
    return F.slice(F.filter(said, lambda x: x.isNotNull()), 1, most)


def descriptions(samples: DataFrame, variant: str = "rules") -> DataFrame:
    """(entity, description) of all clue entities, each once: by the rule table, or one fixed text. Names never leak."""
    e = samples.select(F.explode("clue_entities").alias("entity")).where("entity is not null").distinct()
    text = generic_description(F.col("entity")) if variant == "rules" else F.lit("一个相关实体")
    return e.select("entity", F.when(leaks(text, F.col("entity")), "一个相关实体").otherwise(text).alias("description"))


def obfuscated(samples: DataFrame, table: DataFrame) -> DataFrame:
    """``samples`` with a map from their clue entities to descriptions."""
    rows = samples.select("sample_id", F.posexplode("clue_entities").alias("i", "entity")).dropDuplicates(["sample_id", "entity"]).join(table, "entity")
    m = rows.groupBy("sample_id").agg(F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("i", "entity", "description"))), lambda x: F.struct(x["entity"], x["description"]))).alias("obfuscated_entities"))
    return samples.join(m, "sample_id", "left")


def generalised_from_story(statement: Column, story: Column, entities: Column) -> Column:
    """Descriptions of entities that the statement names and the story does not."""
    gone = F.array_distinct(F.filter(entities, lambda e: F.contains(statement, e) & ~F.contains(story, e)))
    return F.map_from_entries(F.transform(gone, lambda e: F.struct(e, general_description(e))))


def story(statement: Column, target: Column) -> Column:
    """The fixed branch of the rewrite: the target's name becomes a general one."""
    return F.when(F.coalesce(target, F.lit("")) != "", F.replace(statement, target, F.lit(vocab.SOME_ENTITY))).otherwise(statement)


def woven(said: Column, facts: Column | None = None, strategy: str = "integrated") -> Column:
    """The fixed branch of weaving descriptions into a story."""
    if strategy == "three_stage":
        return F.concat(F.lit("这里涉及"), F.array_join(said, "，"), F.lit("等相关信息。"))
    linked = F.concat(F.lit("根据相关线索，"), said[0], F.lit("通过"), facts[0]["relation"], F.lit("等关系与"), said[1], F.lit("等内容相互关联，这些关系线索共同指向一个特定的目标。"))
    listed = F.concat(F.lit("根据相关线索，涉及"), F.array_join(F.slice(said, 1, 3), ", "), F.lit("等内容，这些线索共同指向一个特定的目标。"))
    return F.when(F.size(said) == 0, "存在一些相关的线索和关系").when((F.size(facts) > 0) & (F.size(said) > 1), linked).otherwise(listed)


def plain_question(reply: Column, has_story: Column) -> Column:
    """A reply without its label, else a fixed question."""
    text = F.regexp_replace(F.trim(reply), "^(问题|问)：", "")
    return F.when(reply.isNotNull(), F.trim(text)).when(has_story, "这是什么？").otherwise("这个实体是什么？")


def stem(stems, seed: str, *keys) -> Column:
    return F.element_at(F.array(*map(F.lit, stems)), (draw(seed, *keys) % len(stems) + 1).cast("int"))


def structured_question(text: Column, clues: Column, seed: str, *keys) -> Column:
    """Story, a stem by hash, and three lines of analysis."""
    n = F.size(clues).cast("string")
    lines = [F.replace(F.lit(x), F.lit("{n}"), n) for x in vocab.ANALYSIS]
    told = F.when(F.coalesce(text, F.lit("")) == "", vocab.NO_STORY).otherwise(text)
    return F.concat(F.lit("**问题：**  \n"), told, stem(vocab.QUESTION_STEMS, seed, *keys), F.lit("  \n\n**解析：**  \n"), F.concat_ws("\n", *lines))


def safe_question(reply: Column, text: Column, answer: Column, clues: Column, seed: str, *keys) -> Column:
    """A reply that does not leak the answer, else the structured question."""
    ok = reply.isNotNull() & ~leaks(reply, answer)
    return F.when(ok, F.trim(reply)).otherwise(structured_question(text, clues, seed, *keys))


def legacy_question(relation: Column) -> Column:
    return F.concat(F.lit("根据这段描述，你能推断出"), F.coalesce(relation, F.lit("相关信息")), F.lit("是什么吗？"))


def chain_question(path: Column, seed: str, *keys) -> Column:
    """Story, stem and analysis of a long path; null below four nodes."""
    inner = F.slice(path, F.lit(2), F.size(path) - 2)
    lines = F.concat(
        F.lit("1. 根据路径关系，"), path[0], F.lit("通过"), F.size(inner).cast("string"), F.lit("步关联。  \n2. 关键中间实体包括"), inner[0], F.lit("等。  \n3. 需要整合路径中的所有关系信息来推理最终答案。"),
    )
    return F.when(F.size(path) >= 4, F.concat(F.lit("**问题：**  \n" + vocab.CHAIN_STORY), stem(vocab.CHAIN_STEMS, seed, *keys), F.lit("  \n\n**解析：**  \n"), lines))


def reasoning_steps(triples: Column) -> Column:
    """Step, entities, relation and description of each triple of a path."""
    return F.transform(
        triples,
        lambda t, i: F.struct((i + 1).alias("step"), t["subject"].alias("from_entity"), t["relation"].alias("relation"), t["object"].alias("to_entity"), F.concat_ws(" ", t["subject"], t["relation"], t["object"]).alias("description")),
    )


def split_counts(total: int, strategy: str, chain_ratio: float = 0.5) -> dict[str, int]:
    """Samples of the chain and the entity branch."""
    chain = {"chain_of_thought": total, "entity_centric": 0}.get(strategy, int(total * chain_ratio))
    return {"chain": chain, "entity": total - chain}


def with_background(question: Column, relation: Column, *stories: Column) -> Column:
    """The first story that is not blank before the question, parted by a space or a full stop."""
    b = F.coalesce(*(F.nullif(F.trim(s), F.lit("")) for s in stories), F.lit(""))
    q = F.trim(F.coalesce(question, F.lit("")))
    joined = F.when(b.rlike("[。.！!？?]$"), F.concat(b, F.lit(" "), q)).otherwise(F.concat(b, F.lit("。"), q))
    return F.when((b != "") & (q != ""), joined).when(q != "", q).otherwise(F.concat(F.lit("根据相关信息，请问"), F.coalesce(relation, F.lit("答案")), F.lit("是什么？")))
