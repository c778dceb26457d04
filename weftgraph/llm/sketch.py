"""Threshold-scaled document fingerprints with DataFrame functions only.

A text's shingles of five words (the whole sequence where there are fewer words) are hashed by MD5, and every hash
below a fixed fraction of the range is kept: the first 16 hexadecimal digits, sorted, joined. As the bound does not
depend on the text, the sketch of a union is the union of sketches, and the share of a small document's sketch that a
large one's holds estimates containment, however unequal they are. A text none of whose hashes lies below the bound
keeps its smallest one, which ``merged`` drops as soon as the other side has one below the bound. So the containment of
texts of fewer than some 20 shingles is unreliable: a short text that lies whole within a long one may get 0.

Defined results: null text counts as the empty text, whose fingerprint is empty; two empty fingerprints are alike (1),
an empty and another one are not (0); texts are read whole; rows with equal or null keys follow each other in the order
of a hash of their text; repeated rows keep their rows; an empty table gives an empty table; of the columns, the key
and those made here are returned.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.words import cuts_of, range_of

BLANK = r"[\x20\x09-\x0D]+"
DIGITS = 16
WIDTH = 5
#: One hash in eight is kept: hexadecimal digits below this one.
BOUND = "2000000000000000"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK, -1), "")


def sketch(text: Column, width: int = WIDTH, bound: str = BOUND) -> Column:
    """The sorted array of kept hashes."""

    def of_words(w: Column) -> Column:
        shingle = lambda i: F.concat_ws(" ", *(w[i + j] for j in range(width)))
        some = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.substr(F.md5(shingle(i)), F.lit(1), F.lit(DIGITS)))
        one = F.array(F.substr(F.md5(F.array_join(w, " ")), F.lit(1), F.lit(DIGITS)))
        return F.when(F.size(w) >= width, some).when(F.size(w) > 0, one).otherwise(F.array().cast("array<string>"))

    def kept(hashes: Column) -> Column:
        below = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < bound)))
        return F.when(F.size(below) > 0, below).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(below)

    # one-element arrays bind the words and the hashes to a name, so neither is computed twice
    return F.transform(F.transform(F.array(words(text)), of_words), kept)[0]


def fingerprint(kept: Column) -> Column:
    return F.array_join(kept, "")


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller sketch that the other one holds."""
    least = F.least(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def merged(a: Column, b: Column, bound: str = BOUND) -> Column:
    """The sketch of two texts' shingles together: all hashes below the bound, or else the smallest one."""
    both = F.sort_array(F.array_union(a, b))
    below = F.filter(both, lambda h: h < bound)
    return F.when(F.size(below) > 0, below).otherwise(F.slice(both, F.lit(1), F.lit(1)))


def with_next(docs: DataFrame, key: str, text: str, sketched: bool, ranges: int | None = None) -> DataFrame:
    """(key, text, next_text[, own, next_own]): each row with the next one by descending key, the last with the first.

    Rows are dealt into ranges of the key by quantiles, ordered within each, and each range's last row gets the first
    row of the next range: a row for each range carries over, so no task holds more than its ranges. The rows of a key
    that several quantiles name (nulls, say) are dealt into as many ranges more, by a hash of their text.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    base = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(low)).alias("ord"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    often = Counter(cuts_of(base, "ord", ranges))
    cuts = sorted(often)
    base = base.withColumn("h", F.xxhash64("t")).withColumn("range", range_of(cuts, F.col("ord")))
    sub = F.lit(0)
    for value, n in often.items():
        if n > 1:  # at most ranges / 2 such keys, of which each holds more than one range's rows
            share = F.least(F.floor((F.col("h") / float(1 << 64) + 0.5) * n).cast("int"), F.lit(n - 1))
            sub = F.when(F.col("ord") == value, share + 1).otherwise(sub)
    base = base.withColumn("sub", sub)
    # a row for each range reaches the driver: its first one
    tops = base.groupBy("range", "sub").agg(F.max(F.struct("ord", (-F.col("h").cast("decimal(20,0)")).alias("h"))).alias("top")).collect()
    tops = sorted(((-r["range"], r["sub"], r["top"]["ord"], -int(r["top"]["h"])) for r in tops))
    follow = [(-a, b, *tops[(k + 1) % len(tops)][2:]) for k, (a, b, _, _) in enumerate(tops)]
    follow = F.broadcast(spark.createDataFrame(follow, "`range` int, sub int, ord long, h long"))
    firsts = base.join(follow.select("ord", "h").distinct(), ["ord", "h"], "left_semi").groupBy("ord", "h").agg(F.min("t").alias("t"))
    firsts = firsts.join(follow, ["ord", "h"]).select("range", "sub", F.col("t").alias("first_t"))
    w = Window.partitionBy("range", "sub").orderBy(F.desc("ord"), "h", "t")
    rows = base.withColumn("next_t", F.lead("t").over(w))
    if sketched:
        rows = rows.withColumn("own", sketch(F.col("t")))
        rows = rows.withColumn("next_own", F.lead("own").over(w))
        firsts = firsts.withColumn("first_own", sketch(F.col("first_t")))
    rows = rows.join(F.broadcast(firsts), ["range", "sub"], "left")  # one row for each range
    out = [F.col("key").alias(key), F.col("t").alias("text"), F.coalesce("next_t", "first_t").alias("next_text")]
    if sketched:
        out += ["own", F.when(F.col("next_t").isNull(), F.col("first_own")).otherwise(F.col("next_own")).alias("next_own")]
    return rows.select(out)


def half_edited(text: Column, other: Column) -> Column:
    """``text`` whose last floor(n/2) code points are replaced by the first as many of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(other, F.lit(1), half))


ORACLE_SQL = r"""
WITH o AS (
  SELECT doc_id, coalesce(text, '') AS t,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS nt
  FROM documents),
e AS (SELECT *, substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2) AS et FROM o),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS tw,
             list_filter(string_split_regex(nt, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS nw,
             list_filter(string_split_regex(et, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ew FROM e),
h AS (SELECT *,
  CASE WHEN len(tw) >= 5 THEN list_transform(range(1, len(tw) - 3), lambda i: md5(array_to_string(tw[i:i+4], ' '))[1:16]) WHEN len(tw) > 0 THEN [md5(array_to_string(tw, ' '))[1:16]] ELSE [] END AS th,
  CASE WHEN len(nw) >= 5 THEN list_transform(range(1, len(nw) - 3), lambda i: md5(array_to_string(nw[i:i+4], ' '))[1:16]) WHEN len(nw) > 0 THEN [md5(array_to_string(nw, ' '))[1:16]] ELSE [] END AS nh,
  CASE WHEN len(ew) >= 5 THEN list_transform(range(1, len(ew) - 3), lambda i: md5(array_to_string(ew[i:i+4], ' '))[1:16]) WHEN len(ew) > 0 THEN [md5(array_to_string(ew, ' '))[1:16]] ELSE [] END AS eh
  FROM w),
f AS (SELECT *,
  CASE WHEN list_min(th) < '2000000000000000' THEN list_sort(list_distinct(list_filter(th, lambda x: x < '2000000000000000'))) WHEN len(th) > 0 THEN [list_min(th)] ELSE [] END AS tf,
  CASE WHEN list_min(nh) < '2000000000000000' THEN list_sort(list_distinct(list_filter(nh, lambda x: x < '2000000000000000'))) WHEN len(nh) > 0 THEN [list_min(nh)] ELSE [] END AS nf,
  CASE WHEN list_min(eh) < '2000000000000000' THEN list_sort(list_distinct(list_filter(eh, lambda x: x < '2000000000000000'))) WHEN len(eh) > 0 THEN [list_min(eh)] ELSE [] END AS ef
  FROM h)
SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256, array_to_string(tf, '') AS fingerprint, array_to_string(ef, '') AS edited_fingerprint,
  CASE WHEN len(tf) = 0 AND len(ef) = 0 THEN 1.0 WHEN least(len(tf), len(ef)) = 0 THEN 0.0 ELSE len(list_intersect(tf, ef)) / least(len(tf), len(ef)) END::DOUBLE AS near_edited,
  CASE WHEN len(tf) = 0 AND len(nf) = 0 THEN 1.0 WHEN least(len(tf), len(nf)) = 0 THEN 0.0 ELSE len(list_intersect(tf, nf)) / least(len(tf), len(nf)) END::DOUBLE AS near_next
FROM f
"""
