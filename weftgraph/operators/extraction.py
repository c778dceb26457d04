"""Triple extraction: prompts, the model call, recovery of triples from its replies, relation statistics."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weftgraph.functions import vocab

REPLY = "array<struct<block_id:int,triples:array<struct<subject:string,relation:string,object:string>>>>"
INSTRUCTION = "Extract facts from the numbered text blocks as a JSON array of {block_id, triples:[{subject, relation, object}]}. Prefer these relations: "
EXAMPLE = '[{"block_id": 1, "triples": [{"subject": "A", "relation": "位于", "object": "B"}]}]'


def prompt(blocks: Column) -> Column:
    """Instruction, relations, an example, and the blocks of a chunk, numbered, each as a JSON string."""
    quoted = F.transform(blocks, lambda b: F.concat(b["id"].cast("string"), F.lit(". "), F.regexp_extract(F.to_json(F.struct(b["text"].alias("t"))), r'^\{"t":(.*)\}$', 1)))
    return F.concat(F.lit(INSTRUCTION + ", ".join(vocab.RELATIONS) + "\n" + EXAMPLE + "\n"), F.array_join(quoted, "\n"))


def stub_model(prompts: pd.Series) -> pd.Series:
    """Offline model: no triples for any block."""
    return prompts.map(lambda _: "[]")


class RateLimited(Exception):
    """The service asks for fewer calls: the next one waits longer."""


class Refused(Exception):
    """The service rejects the call for good: it is not made again."""


def call_model(rows: DataFrame, model: Callable[[pd.Series], pd.Series] = stub_model, column: str = "prompt", at_once: int = 8, attempts: int = 3, waits: tuple[float, float] = (10.0, 60.0)) -> DataFrame:
    """``rows`` with a struct ``reply`` (ok, text, error); ``at_once`` tasks call the model.

    Rows without a text (null or empty) are asked again, up to ``attempts`` times in all: after the first of ``waits``
    in seconds, or after a multiple of the second that grows with the attempts where the service limits its rate.
    What other rows of a batch got is kept.
    """
    schema = rows.withColumn("reply", F.lit(None).cast("struct<ok:boolean,text:string,error:string>")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got: list[str | None] = [None] * len(b)
            error, wait = "", 0.0
            for k in range(attempts):
                todo = [i for i, t in enumerate(got) if not t]
                if not todo:
                    break
                time.sleep(wait)
                try:
                    texts = list(model(b[column].iloc[todo]))
                    if len(texts) != len(todo):
                        raise ValueError(f"{len(texts)} replies to {len(todo)} prompts")
                    for i, t in zip(todo, texts):
                        got[i] = t
                    error, wait = "empty reply", waits[0]
                except Refused as e:
                    error = str(e)
                    break
                except RateLimited as e:
                    error, wait = str(e), waits[1] * (k + 1)
                except Exception as e:  # the service's failures become rows
                    error, wait = str(e), waits[0]
            yield b.assign(reply=[{"ok": bool(t), "text": t or None, "error": None if t else error} for t in got])

    return rows.repartition(at_once).mapInPandas(run, schema)


def assemble_events(body: str) -> str:
    """The text of a stream of server-sent events: contents of deltas or messages until the end mark."""
    out = []
    for line in body.splitlines():
        if not line.startswith("data:"):
            continue
        data = line[5:].strip()
        if data == "[DONE]":
            break
        try:
            c = json.loads(data)["choices"][0]
        except (ValueError, KeyError, IndexError):
            continue
        out.append((c.get("delta") or c.get("message") or {}).get("content") or "")
    return "".join(out)


def unfenced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(json)?\s*", ""), r"\s*```$", ""))


def without_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",(\s*[}\]])", "$1")


def complete_triples(text: Column) -> Column:
    """What a cut reply still holds: its complete triples, under its first block id."""
    # fixed value: the form of a complete triple
    lit = r'\{"subject":\s*"[^"]*",\s*"relation":\s*"[^"]*",\s*"object":\s*"[^"]*"\}'
    got = F.regexp_extract_all(text, F.lit(lit), F.lit(0))
    block = F.regexp_extract(text, r'"block_id":\s*(\d+)', 1)
    return F.when(F.size(got) > 0, F.concat(F.lit('[{"block_id": '), F.when(block != "", block).otherwise("1"), F.lit(', "triples": ['), F.array_join(got, ", "), F.lit("]}]")))


def _repair(text: str) -> str | None:
    """The last resort: the first balanced array, else the text with its brackets closed, else fields line by line."""
    for m in re.finditer(r"\[", text):
        depth, quoted, escaped = 0, False, False
        for k in range(m.start(), len(text)):
            c = text[k]
            if quoted:
                escaped, quoted = (not escaped and c == "\\"), escaped or c != '"'
            elif c == '"':
                quoted = True
            elif c in "[{":
                depth += 1
            elif c in "]}":
                depth -= 1
                if not depth:
                    try:
                        got = json.loads(text[m.start() : k + 1])
                    except ValueError:
                        break
                    if isinstance(got, list) and got and all(isinstance(x, dict) for x in got):
                        return json.dumps(got, ensure_ascii=False)
                    break
    start = text.find("[")
    for tail in ("]", "}]", "]}]", '"}]}]') if start >= 0 else ():
        try:
            return json.dumps(json.loads(text[start:] + tail), ensure_ascii=False)
        except ValueError:
            continue
    triples, now = [], {}
    for field, value in re.findall(r'"(subject|relation|object)":\s*"([^"]*)"', text):
        now = {field: value} if field == "subject" else now | {field: value}
        if len(now) == 3:
            triples.append(now)
            now = {}
    return json.dumps([{"block_id": 1, "triples": triples}], ensure_ascii=False) if triples else None


@F.pandas_udf(StringType())
def repair_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _repair(t) if isinstance(t, str) else None)


def recovered(text: Column) -> Column:
    """A reply as blocks of triples: parsed as it is, from its first to its last bracket, without trailing commas, from
    its complete triples, repaired; an empty array if nothing helps. Extra fields are dropped."""
    t = unfenced(text)
    whole = F.when(t.startswith("{"), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)
    inner = F.regexp_extract(t, r"(?s)\[.*\]", 0)

    def parsed(c: Column) -> Column:
        ok = F.try_parse_json(c).isNotNull() & F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("ARRAY<OBJECT"), F.lit(False))
        return F.when(ok, F.from_json(c, REPLY))

    repaired = F.when(F.coalesce(text, F.lit("")) != "", F.from_json(repair_udf(t), REPLY))
    return F.coalesce(parsed(whole), parsed(inner), parsed(without_trailing_commas(inner)), F.from_json(complete_triples(t), REPLY), repaired, F.array().cast(REPLY))


def flattened(replies: DataFrame, sizes: bool = True) -> DataFrame:
    """Triples of replies (key, url, n, reply): of blocks with a number from 1 to n, or of all blocks without ``sizes``."""
    b = replies.select("key", "url", "n", F.explode("reply").alias("b"))
    if sizes:
        b = b.where((F.col("b.block_id") >= 1) & (F.col("b.block_id") <= F.col("n")))
    t = b.select("key", F.col("url").alias("source_url"), F.col("b.block_id").alias("block_id"), F.explode("b.triples").alias("t"))
    return t.select("key", "source_url", "block_id", "t.subject", "t.relation", "t.object")


def relation_counts(triples: DataFrame, relations=vocab.RELATIONS) -> DataFrame:
    """(relation, kind, n): uses of each relation, predefined or custom."""
    kind = F.when(F.col("relation").isin(*relations), "predefined").otherwise("custom")
    return triples.where("relation is not null and relation != ''").groupBy("relation").agg(F.count("*").alias("n")).withColumn("kind", kind)


def relation_statistics(counts: DataFrame) -> DataFrame:
    """(kind, relations, uses, percentage)."""
    g = counts.groupBy("kind").agg(F.count("*").alias("relations"), F.sum("n").alias("uses"))
    return g.withColumn("percentage", F.round(F.col("uses") * 100.0 / F.sum("uses").over(Window.partitionBy()), 6))  # two rows


def relation_report(counts: DataFrame, predefined: int = 10, custom: int = 15) -> DataFrame:
    """(kind, place, relation, n) of the most used relations, and a row of what remains of each kind."""
    w = Window.partitionBy("kind").orderBy(F.desc("n"), "relation")
    limit = F.when(F.col("kind") == "predefined", predefined).otherwise(custom)
    rows = counts.withColumn("place", F.row_number().over(w))  # a row for each relation of the vocabulary
    rest = rows.where(F.col("place") > limit).groupBy("kind").agg(F.lit(None).cast("string").alias("relation"), F.count("*").alias("n"), F.lit(0).alias("place"))
    return rows.where(F.col("place") <= limit).select("kind", "place", "relation", "n").unionByName(rest.select("kind", "place", "relation", "n"))


def suggested_relations(counts: DataFrame, least: int = 2, relations=vocab.RELATIONS) -> DataFrame:
    """The vocabulary with the custom relations that are used ``least`` times or more."""
    spark = counts.sparkSession
    base = spark.createDataFrame([(r,) for r in relations], "relation string")
    return counts.where((F.col("kind") == "custom") & (F.col("n") >= least)).select("relation").unionByName(base).distinct()


def filled(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """(block_id, triples) of every block, an empty array where the reply has none."""
    got = replies.select("b.block_id", "b.triples") if "b" in replies.columns else replies
    return blocks.join(got, "block_id", "left").select("block_id", F.coalesce("triples", F.array().cast("array<struct<subject:string,relation:string,object:string>>")).alias("triples"))
