"""Secret scans with DataFrame functions only.

Base spans come from three patterns, leftmost and without overlap per kind; matches that are too short are dropped.
Beside them, candidate strings are walked with a sliding window: the counts of a character class are updated by the
character that enters and the one that leaves, and with them the sum of c*log2(c), so each step costs the same whatever
the window. A candidate whose highest window entropy reaches the bound of its class is a secret, unless an entry of the
allow-list matches it or a base span holds it.

Places are code points from 0, the end exclusive. Defined results: null text has no spans and stays null when masked;
empty text has none; repeated rows keep their rows; an empty table gives an empty table; extra columns stay, and those
named base_spans or secret_spans get "_" behind their name. Many matches in one text cost little more than in many texts.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftgraph.llm.words import free

#: Kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", r"([0-9a-f]{32,})", 1, 32),  # runs are maximal, so shorter ones cannot hide longer ones
)
#: Candidates, their window, and for each class its pattern, alphabet and least entropy in bits.
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
WINDOW = 20
CLASSES = (
    ("hex", "^[0-9a-fA-F]+$", "0123456789abcdefABCDEF", 3.0),
    ("base64", "^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
)
#: Candidates that are no secrets: digits only, letters only, words joined by marks, UUIDs, placeholders.
ALLOWED = ("^[0-9]+$", "^[A-Za-z]+$", "^[A-Za-z]+([/_=+-]+[A-Za-z]*)+$", "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", "(?i)example|sample|placeholder|dummy")
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a one-element array gives it a name."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, op, zero: Column) -> Column:
    """What ``op`` makes of all elements before each one, in blocks of about the root of their number: no array grows,
    and n elements cost n ** 1.5 small steps."""

    def of(v: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / step).cast("int"))
        part = lambda b, n: F.aggregate(F.slice(v, b * step + 1, n), zero, op)

        def heads(totals: Column) -> Column:
            def block(b: Column) -> Column:
                inside = F.sequence(F.lit(0), F.least(step, F.size(v) - b * step) - 1)
                return bound(F.aggregate(F.slice(totals, F.lit(1), b), zero, op), lambda head: F.transform(inside, lambda j: op(head, part(b, j))))

            return F.flatten(F.transform(blocks, block))

        return bound(F.transform(blocks, lambda b: part(b, step)), heads)

    return F.when(F.size(values) > 0, bound(values, of)).otherwise(F.array().cast("array<int>"))


def found(text: Column, pattern: str, group: int, least: int, rank: int, kind: str, keep=None) -> Column:
    """Spans of the matches of ``pattern``: the lengths of what lies between matches and of the matches give the places."""
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length).alias("part"),
    )

    def spans(z: Column) -> Column:
        lengths = F.transform(z, lambda x: x["between"] + F.coalesce(F.char_length(x["match"]), F.lit(0)))

        def placed(before: Column) -> Column:
            start = lambda x, i: before[i] + x["between"]
            return F.transform(z, lambda x, i: F.struct(start(x, i).alias("start"), F.lit(rank).alias("rank"), (start(x, i) + F.char_length(x["match"])).alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match"), x["part"].alias("part")))

        return bound(running(lengths, lambda a, b: a + b, F.lit(0)), placed)

    def ok(x: Column) -> Column:
        fits = x["match"].isNotNull() & (x["part"] >= least)
        return fits & keep(x["match"]) if keep is not None else fits

    none = F.array().cast(SPAN)
    kept = F.transform(F.filter(bound(zipped, spans), ok), lambda x: F.struct(*(x[c].alias(c) for c in ("start", "rank", "end", "kind"))))
    return F.when(text.rlike(pattern), kept).otherwise(none)


def window_entropy(chars: Column, alphabet: str, window: int) -> Column:
    """The highest Shannon entropy of any window over an array of characters, by incremental counts."""
    size = len(alphabet)
    term = F.array(*(F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)))
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c) - 1)

    def walk(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            code, full = codes[i], i >= window
            gone = F.when(full, codes[i - window]).otherwise(F.lit(-1))
            c = acc["counts"][code]
            entered = acc["sum"] + term[c + 1] - term[c]
            g = F.when(full, acc["counts"][F.greatest(gone, F.lit(0))] + (gone == code).cast("int")).otherwise(F.lit(1))
            left = entered - F.when(full, term[g] - term[g - 1]).otherwise(F.lit(0.0))
            counts = F.transform(acc["counts"], lambda x, j: x + (j == code).cast("int") - (j == gone).cast("int"))
            best = F.when(i >= window - 1, F.greatest(acc["best"], F.lit(log2(window)) - left / window)).otherwise(acc["best"])
            return F.struct(counts.alias("counts"), left.alias("sum"), best.alias("best"))

        start = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda acc: acc["best"])

    return F.transform(F.array(codes), walk)[0]


def entropic(candidate: Column, window: int = WINDOW, classes=CLASSES, allowed=ALLOWED) -> Column:
    """Whether a candidate is not allowed and reaches the entropy bound of the first class that it belongs to."""
    chars = F.split(candidate, "", -1)
    chars = F.filter(chars, lambda c: c != "")
    out = F.lit(False)
    for _, pattern, alphabet, bound in reversed(classes):
        out = F.when(candidate.rlike(pattern), F.round(window_entropy(chars, alphabet, window), 6) >= bound).otherwise(out)
    return F.when(candidate.rlike("|".join(f"(?:{a})" for a in allowed)), False).otherwise(out)


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*(found(text, p, g, n, k, kind) for k, (kind, p, g, n) in enumerate(BASE))))


def furthest(spans: Column, counts=None) -> Column:
    """The furthest end of all spans before each one, or of those that ``counts`` says."""
    ends = F.transform(spans, lambda s: s["end"] if counts is None else F.when(counts(s), s["end"]).otherwise(0))
    return running(ends, lambda a, b: F.greatest(a, b), F.lit(0))


def with_entropy(text: Column, base: Column) -> Column:
    """``base`` and the spans of secrets by entropy that no base span holds, by start. At one start base spans come first."""
    every = F.array_sort(F.concat(base, found(text, CANDIDATE, 1, WINDOW, len(BASE), "entropy", entropic)))
    is_base = lambda s: s["rank"] < len(BASE)
    return bound(every, lambda e: bound(furthest(e, is_base), lambda far: F.filter(e, lambda s, i: is_base(s) | (far[i] < s["end"]))))


def scan(docs, text: str = "text"):
    """``docs`` with ``base_spans`` and ``secret_spans`` (all of them), arrays of (start, rank, end, kind) by start."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = free(docs, "base_spans", "secret_spans")
    docs = docs.withColumn("base_spans", base_spans(t))
    return docs.withColumn("secret_spans", with_entropy(t, F.col("base_spans")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]", few: int = 64) -> Column:
    """``text`` with every span, or overlapping spans together, replaced by ``mask``.

    ``spans`` are sorted by start. Up to ``few`` spans cut the text where they lie; for more, it is taken apart once.
    """

    def pieces(cut, s: Column) -> Column:
        def of(far: Column) -> Column:
            each = F.transform(s, lambda x, i: F.when(x["start"] >= far[i], F.concat(cut(far[i], x["start"] - far[i]), F.lit(mask))).otherwise(""))
            last = F.greatest(F.array_max(F.transform(s, lambda x: x["end"])), F.lit(0))
            return F.concat(F.array_join(each, ""), bound(last, lambda end: cut(end, F.greatest(F.char_length(text) - end, F.lit(0)))))

        return bound(furthest(s), of)

    by_place = lambda at, n: F.substr(text, at + 1, n)
    of_chars = lambda chars: pieces(lambda at, n: F.array_join(F.slice(chars, at + 1, n), ""), spans)
    many = bound(F.filter(F.split(text, "", -1), lambda c: c != ""), of_chars)
    return F.when(text.isNull() | (F.size(spans) == 0), text).when(F.size(spans) <= few, pieces(by_place, spans)).otherwise(many)


ORACLE_SQL = r"""
WITH pats(kind, rank, pat, grp, least, opt) AS (VALUES
  ('assign', 0, '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8, 'i'),
  ('access', 1, '(AKIA[A-Z0-9]+)', 1, 16, 'c'),
  ('hex', 2, '([0-9a-f]+)', 1, 32, 'c'),
  ('entropy', 3, '([A-Za-z0-9+/_=-]{20,})', 1, 20, 'c')),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, kind, rank, least,
         CASE opt WHEN 'i' THEN regexp_extract_all(t, '(?i)' || '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
                  ELSE CASE kind WHEN 'access' THEN regexp_extract_all(t, '(AKIA[A-Z0-9]+)', 0) WHEN 'hex' THEN regexp_extract_all(t, '([0-9a-f]+)', 0) ELSE regexp_extract_all(t, '([A-Za-z0-9+/_=-]{20,})', 0) END END AS ms,
         CASE opt WHEN 'i' THEN regexp_extract_all(t, '(?i)' || '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
                  ELSE CASE kind WHEN 'access' THEN regexp_extract_all(t, '(AKIA[A-Z0-9]+)', 0) WHEN 'hex' THEN regexp_extract_all(t, '([0-9a-f]+)', 0) ELSE regexp_extract_all(t, '([A-Za-z0-9+/_=-]{20,})', 0) END END AS gs,
         CASE opt WHEN 'i' THEN string_split_regex(t, '(?i)' || '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
                  ELSE CASE kind WHEN 'access' THEN string_split_regex(t, '(AKIA[A-Z0-9]+)') WHEN 'hex' THEN string_split_regex(t, '([0-9a-f]+)') ELSE string_split_regex(t, '([A-Za-z0-9+/_=-]{20,})') END END AS bs
  FROM d CROSS JOIN pats),
u AS (SELECT doc_id, kind, rank, least, unnest(ms) AS s, unnest(gs) AS g, unnest(bs[1:len(ms)]) AS b, unnest(range(len(ms))) AS k FROM m WHERE len(ms) > 0),
p AS (SELECT *, sum(length(b) + length(s)) OVER (PARTITION BY doc_id, kind ORDER BY k) - length(s) AS a FROM u),
spans AS (SELECT doc_id, kind, rank, s, a::BIGINT AS a, (a + length(s))::BIGINT AS e FROM p WHERE length(g) >= least),
base AS (SELECT * FROM spans WHERE rank < 3),
cand AS (
  SELECT *, CASE WHEN regexp_matches(s, '^[0-9a-fA-F]+$') THEN 3.0 ELSE 3.8 END AS bound FROM spans x
  WHERE rank = 3
    AND NOT regexp_matches(s, '^[0-9]+$') AND NOT regexp_matches(s, '^[A-Za-z]+$') AND NOT regexp_matches(s, '^[A-Za-z]+([/_=+-]+[A-Za-z]*)+$')
    AND NOT regexp_matches(s, '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$') AND NOT regexp_matches(s, '(?i)example|sample|placeholder|dummy')
    AND NOT EXISTS (SELECT 1 FROM base y WHERE y.doc_id = x.doc_id AND y.a <= x.a AND y.e >= x.e)),
extra AS (
  SELECT doc_id, kind, rank, s, a, e FROM cand
  WHERE round(list_max(list_transform(range(1, length(s) - 18), lambda q: list_aggregate(string_split(substr(s, q, 20), ''), 'entropy'))), 6) >= bound),
every AS (SELECT * FROM base UNION ALL SELECT * FROM extra),
agg AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) FILTER (rank < 3), '') AS base,
         string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) AS spans
  FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""
