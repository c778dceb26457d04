"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source x language x topic) are raked: each step scales the cells so that the totals of one
dimension meet its target shares, in turn, for a fixed number of rounds. A document of a cell is then sampled with
probability kappa * raked weight / tokens of the cell, kappa such that the expected tokens are ``share`` of all, or the
largest smaller share at which no probability exceeds one: so the expected tokens meet the targets, up to the residual
of the raking, which is returned. Sampling is by a hash of the id, so it is repeatable.

Targets list the values of each dimension; every other value, and null, falls under "*". The cells are therefore at
most the product of the targets' sizes plus one, whatever the data hold: only they reach the driver. Targets of values
that do not occur are shared out among those that do, in proportion.

Defined results: documents without tokens weigh nothing and take their cell's probability, which is one for a cell
without any tokens; a null id is sampled as the empty text; ties and repeated rows are sampled alike; an empty table
gives an empty table; extra columns stay, and those that are named as one of the columns made here get "_" behind
their name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.session import materialise

REST = "*"
#: The mixture that the registered query and the pipeline aim at.
SOURCES = {f"src{k}": 0.049 for k in range(20)} | {REST: 0.02}
LANGS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.11, REST: 0.02}
TOPICS = {"legal": 0.03, "contact": 0.02, "prose": 0.95}
SHARE, ROUNDS, SEED = 0.85, 40, "mix-2"
MADE = ("mix_cell", "mix_tokens", "mix_probability", "mix_residual")


def topic(text: Column) -> Column:
    """A rule for the topic: licence and rights lines, addresses, other prose."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("(?i)licensed under|all rights reserved"), "legal").when(t.contains("@"), "contact").otherwise("prose")


def n_words(text: Column) -> Column:
    """Words between ASCII white space: the tokens that are weighed."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), ""))


def rake(tokens: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray], rounds: int) -> np.ndarray:
    """Weights of the cells whose totals per value of each dimension meet the target shares of all tokens."""
    w = tokens.astype(np.float64).copy()
    for _ in range(rounds):
        for at, shares in zip(members, targets):
            have = np.bincount(at, weights=w, minlength=len(shares))
            goal = np.where(have > 0, shares, 0.0)
            goal = goal / goal.sum() * tokens.sum()
            w *= np.divide(goal, have, out=np.zeros_like(have), where=have > 0)[at]
    return w


def goals(members: list[np.ndarray], targets: list[np.ndarray]) -> list[np.ndarray]:
    """The target shares, scaled to the values that occur."""
    there = [np.where(np.bincount(at, minlength=len(shares)) > 0, shares, 0.0) for at, shares in zip(members, targets)]
    return [x / x.sum() for x in there]


def residual(w: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray]) -> float:
    """The largest distance of a dimension's shares from their targets."""
    return max(float(np.abs(np.bincount(at, weights=w, minlength=len(g)) / w.sum() - g).max()) for at, g in zip(members, goals(members, targets)))


def calibrate(w: np.ndarray, tokens: np.ndarray, share: float) -> np.ndarray:
    """kappa * w / tokens: expected tokens of ``share`` of all, or of less, so that the highest is one at most."""
    ratio = w / tokens
    return ratio * min(share * tokens.sum() / w.sum(), 1 / ratio.max())


def mix(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]], tokens: Column, key: str = "doc_id", share: float = SHARE, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """The sampled rows of ``docs`` with ``mix_cell`` (a struct of the dimensions), ``mix_tokens``, ``mix_probability``
    and ``mix_residual``, the largest distance of an expected share from its target."""
    spark = docs.sparkSession
    names = sorted(dims)

    def group(name: str) -> Column:
        listed = [v for v in targets[name] if v != REST]
        return F.when(dims[name].isin(listed), dims[name]).otherwise(F.lit(REST))

    def free(name: str) -> str:
        while name in MADE or name in docs.columns:
            name += "_"
        return name

    u = F.conv(F.substr(F.md5(F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.lit(seed)).cast("binary")), F.lit(1), F.lit(13)), 16, 10).cast("double") / float(1 << 52)
    cell = F.struct(*(group(n).alias(n) for n in names))
    rows = docs.select(*(F.col(f"`{c}`").alias(free(c) if c in MADE else c) for c in docs.columns), cell.alias("mix_cell"), tokens.cast("long").alias("mix_tokens"), u.alias("_mix_u"))
    # bounded by the targets: a row for each cell
    cells = rows.groupBy(*(F.col(f"mix_cell.{n}").alias(n) for n in names)).agg(F.sum("mix_tokens").alias("tokens")).collect()
    cells = sorted(cells, key=lambda r: tuple(r[n] for n in names))
    have = [r for r in cells if r["tokens"]]
    p, off = {tuple(r[n] for n in names): 1.0 for r in cells}, 0.0
    if have:
        t = np.asarray([r["tokens"] for r in have], dtype=np.float64)
        values = [sorted({*targets[n], REST}) for n in names]
        members = [np.asarray([v.index(r[n]) for r in have]) for n, v in zip(names, values)]
        shares = [np.asarray([targets[n].get(x, 1e-6) for x in v]) for n, v in zip(names, values)]
        w = rake(t, members, shares, rounds)
        off = residual(w, members, shares)
        p |= {tuple(r[n] for n in names): float(x) for r, x in zip(have, calibrate(w, t, share))}
    table = spark.createDataFrame([(*k, v) for k, v in p.items()], ", ".join(f"`{n}` string" for n in names) + ", mix_probability double")
    table = F.broadcast(table.select(F.struct(*names).alias("mix_cell"), "mix_probability"))
    return rows.join(table, "mix_cell").where(F.col("_mix_u") < F.col("mix_probability")).withColumn("mix_residual", F.lit(off)).drop("_mix_u")


def measured(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, source, lang, topic, n_tokens), written: texts are read once, whatever is done with these."""
    return materialise(docs.select(F.col(f"`{key}`"), "source", "lang", topic(F.col("text")).alias("topic"), n_words(F.col("text")).cast("long").alias("n_tokens")), "mix-rows")


def measured_mix(rows: DataFrame) -> DataFrame:
    """``mix`` with the mixture above, over the rows of ``measured``."""
    dims = {n: F.col(n) for n in ("source", "lang", "topic")}
    return mix(rows, dims, {"source": SOURCES, "lang": LANGS, "topic": TOPICS}, F.col("n_tokens"))


def documents_mix(docs: DataFrame) -> DataFrame:
    """``mix`` with the mixture above, over the columns of documents."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}
    return mix(docs, dims, {"source": SOURCES, "lang": LANGS, "topic": TOPICS}, n_words(F.col("text")))


def _values(shares: dict[str, float]) -> str:
    return ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in shares.items())


_STEP = """(SELECT k, source, lang, topic, tokens, w * goal / sum(goal_once) OVER () * total / have AS w FROM (
  SELECT q.*, {t}.share AS goal, sum(q.w) OVER (PARTITION BY q.{d}) AS have, sum(q.tokens) OVER () AS total,
         CASE WHEN row_number() OVER (PARTITION BY q.{d} ORDER BY q.source, q.lang, q.topic) = 1 THEN {t}.share ELSE 0 END AS goal_once
  FROM {q} q JOIN {t} ON {t}.v = q.{d}))"""


def oracle_sql() -> str:
    step = "raked"
    for d, t in (("lang", "lt"), ("source", "st"), ("topic", "tt")):
        step = _STEP.format(d=d, t=t, q=step)
    offs = " UNION ALL ".join(f"SELECT h / sum(h) OVER () AS have, share / sum(share) OVER () AS goal FROM (SELECT {d} AS v, sum(w) AS h FROM raked WHERE k = {ROUNDS} GROUP BY {d}) JOIN {t} USING (v)" for d, t in (("lang", "lt"), ("source", "st"), ("topic", "tt")))
    listed = lambda shares: ", ".join(f"'{k}'" for k in shares if k != REST)
    return f"""
WITH RECURSIVE st(v, share) AS (VALUES {_values(SOURCES)}), lt(v, share) AS (VALUES {_values(LANGS)}), tt(v, share) AS (VALUES {_values(TOPICS)}),
d AS (SELECT doc_id, CASE WHEN source IN ({listed(SOURCES)}) THEN source ELSE '*' END AS source,
  CASE WHEN lang IN ({listed(LANGS)}) THEN lang ELSE '*' END AS lang,
  CASE WHEN regexp_matches(coalesce(text, ''), '(?i)licensed under|all rights reserved') THEN 'legal' WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS topic,
  len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n FROM documents),
cells AS (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n) > 0),
raked AS (SELECT 0 AS k, source, lang, topic, tokens, tokens AS w FROM cells
  UNION ALL SELECT k + 1, source, lang, topic, tokens, w FROM {step} WHERE k < {ROUNDS}),
r AS (SELECT *, w / tokens AS ratio, sum(tokens) OVER () AS total FROM raked WHERE k = {ROUNDS}),
kp AS (SELECT least({SHARE} * any_value(total) / sum(w), 1 / max(ratio)) AS kappa FROM r),
off AS (SELECT max(abs(have - goal)) AS residual FROM ({offs})),
p AS (SELECT source, lang, topic, kp.kappa * ratio AS p FROM r, kp)
SELECT d.doc_id, d.source AS mix_source, d.lang AS mix_lang, d.topic AS mix_topic, d.n::BIGINT AS n_tokens, round(coalesce(p.p, 1.0), 6) AS probability, round(coalesce(residual, 0.0), 6) AS residual
FROM d LEFT JOIN p USING (source, lang, topic) CROSS JOIN off
WHERE ('0x' || md5(coalesce(d.doc_id::VARCHAR, '') || '{SEED}')[1:13])::BIGINT::DOUBLE / 4503599627370496.0 < coalesce(p.p, 1.0)
"""
