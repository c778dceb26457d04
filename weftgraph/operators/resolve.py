"""Entity resolution: blocking, Jaro-Winkler, components, vetoes, canonical names.

A match needs a similarity of 0.90. With a common prefix of p characters the similarity is at most
J + 0.1 p (1 - J), so J is at least 5/6 whatever the prefix, and J <= (2 + shorter / longer) / 3 and
J <= (m / n1 + m / n2 + 1) / 3 for m common characters. From these follow the blocks: the shorter name has half the
longer one's length at least, and the names share a large part of their characters. Pairs are made only within
(type, character) blocks of characters that are rare within their type, so no type is compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weftgraph.functions import vocab
from weftgraph.functions.text import jaro_winkler_table, jaro_winklers
from weftgraph.session import checkpointed


def grams(name: Column) -> Column:
    """The distinct characters of a name, each with its occurrence number, so that repeated ones differ."""
    chars = F.filter(F.split(name, "", -1), lambda c: c != "")
    numbered = F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x == c)).cast("string")))
    return F.array_distinct(numbered)


def blocks(nodes: DataFrame) -> DataFrame:
    """(type, gram, name): the blocks of a name, such that any two names that can match share one.

    With J >= 5/6 a pair has m/n1 + m/n2 >= 3/2 for m common characters, so m is half of each name's length at least. In
    an order of characters from rare to frequent, two such names share one of the first n - ceil(n/2) + 1 of each, hence
    the pairs within blocks of those find every match.
    """
    n = nodes.select("type", "name").distinct().withColumn("gram", F.explode(grams(F.col("name"))))
    often = n.groupBy("type", "gram").agg(F.count("*").alias("often"))
    length = F.char_length("name")
    w = Window.partitionBy("type", "name").orderBy("often", "gram")
    return n.join(often, ["type", "gram"]).withColumn("k", F.row_number().over(w)).where(F.col("k") <= length - F.ceil(length / 2).cast("int") + 1).select("type", "gram", "name")


def pairs_within(members: DataFrame, keep: Column, columns: tuple[str, ...], side: int = 4096) -> DataFrame:
    """(columns, a, b): pairs a < b of names of one (type, gram) block for which ``keep`` of the columns of both sides,
    suffixed _a and _b, holds, each once.

    A block of more than ``side`` names is split: one side of its pairs is dealt over the parts and the other repeated
    for each. Names are few bytes and their pairs much work, so the parts go to as many tasks as a shuffle may have.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.ceil(F.count("*") / side).cast("int").alias("parts")
    rows = members.join(members.groupBy("type", "gram").agg(parts), ["type", "gram"])
    others = [c for c in members.columns if c not in ("type", "gram", "name")]
    as_ = lambda x: [F.col("name").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in others)]
    a = rows.select("type", "gram", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part_no"), *as_("a"))
    b = rows.select("type", "gram", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part_no"), *as_("b"))
    keys = ["type", "gram", "part_no"]
    la, lb = F.char_length("a"), F.char_length("b")
    both = a.repartition(n, *keys).join(b.repartition(n, *keys), keys).where((F.col("a") < F.col("b")) & (2 * F.least(la, lb) >= F.greatest(la, lb)) & keep)
    return both.select(*columns, "a", "b").distinct()


def similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` whose names a and b reach the threshold, with the similarity.

    The function is opaque to the planner: as a condition it would move below the distinct and the join that thin the
    pairs, and run once for each block that two names share.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([*pairs.schema.fields, StructField("similarity", DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            s = jaro_winklers(x.column("a").to_pylist(), x.column("b").to_pylist())
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(s)], names=[*x.schema.names, "similarity"]).filter(pa.array(s >= threshold))

    return pairs.repartition(n, "a", "b").mapInArrow(scored, schema)


def tiles(names: DataFrame, side: int = 512, most: int = 200) -> DataFrame:
    """(type, size, place, names, others_size, others_place, others): all pairs of tiles of the names of a type, whose
    lengths allow a match. A tile holds ``side`` names of one length that follow each other in order; large types have
    ``most`` tiles of a length, so the tiles repeated for the pairs are few times the names."""
    n = max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * names.sparkSession.sparkContext.defaultParallelism)
    size = F.char_length("name")
    w = Window.partitionBy("type", "size")
    rows = names.withColumn("size", size).withColumn("no", F.row_number().over(w.orderBy("name")) - 1).withColumn("all", F.count("*").over(w))
    side_of = F.greatest(F.lit(side), F.ceil(F.col("all") / most))
    t = rows.groupBy("type", "size", F.floor(F.col("no") / side_of).cast("int").alias("place")).agg(F.array_sort(F.collect_list("name")).alias("names"))
    t = checkpointed(t)
    o = t.select("type", F.col("size").alias("others_size"), F.col("place").alias("others_place"), F.col("names").alias("others"))
    ahead = (F.col("others_size") > F.col("size")) | ((F.col("others_size") == F.col("size")) & (F.col("others_place") >= F.col("place")))
    keys = ("type", "size", "place", "others_size", "others_place")
    return t.join(o, "type").where(ahead & (2 * F.col("size") >= F.col("others_size"))).repartition(n, *keys)


def tabled(names: list[str], others: list[str], threshold: float, step: int = 512) -> Iterator[tuple[list, list, np.ndarray, np.ndarray, np.ndarray]]:
    """(first names, second names, places in either, similarities) of the matches a < b of two tiles; of one with itself
    each pair once."""
    for p in range(0, len(names), step):
        x = names[p : p + step]
        for q in range(0, len(others), step):
            y = others[q : q + step]
            if len(x[0]) == len(y[0]) and x[-1] > y[-1]:
                continue  # of one tile, met the other way round
            for a, b in ((x, y), (y, x)):
                if a[0] >= b[-1]:
                    continue
                s = jaro_winkler_table(a, b)
                i, j = np.nonzero(s >= threshold)
                if a[-1] >= b[0]:  # the similarity is taken from the smaller name's side
                    rank = {w: k for k, w in enumerate(sorted({*a, *b}))}
                    r, t = np.asarray([rank[w] for w in a]), np.asarray([rank[w] for w in b])
                    ok = r[i] < t[j]
                    i, j = i[ok], j[ok]
                yield a, b, i, j, s[i, j]
                if x is y or x == y:
                    break


def dense(names: DataFrame, first: DataFrame) -> DataFrame:
    """(type): those whose blocks ``first`` pair so many names, again and again, that all pairs of the type are less work.

    A pair in a table takes about a tenth of what a pair from a block does.
    """
    held = first.groupBy("type", "gram").agg(F.count("*").cast("double").alias("c")).groupBy("type").agg(F.sum(F.col("c") * F.col("c")).alias("in_blocks"))
    return held.join(names.groupBy("type").agg(F.count("*").cast("double").alias("n")), "type").where(F.col("n") * F.col("n") <= 10 * F.col("in_blocks")).select("type")


def _either(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The tiles of the dense types, and the matches of the others from their blocks."""
    names = checkpointed(nodes.select("type", "name").where(F.char_length("name") > 0).distinct())
    first = checkpointed(blocks(names))
    types = checkpointed(dense(names, first))
    rest = similar(pairs_within(first.join(types, "type", "left_anti"), F.lit(True), ("type",)), threshold)
    return tiles(names.join(types, "type", "left_semi")), rest


def matches(nodes: DataFrame, threshold: float = vocab.SIMILARITY) -> DataFrame:
    """(type, a, b, similarity) of pairs at the threshold or above."""
    schema = "type string, a string, b string, similarity double"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for kind, names, others in zip(*(x.column(c).to_pylist() for c in ("type", "names", "others"))):
                for a, b, i, j, s in tabled(names, others, threshold):
                    for k in range(0, len(i), 65536):
                        p, q = (pa.array(z).take(pa.array(at[k : k + 65536])) for z, at in ((a, i), (b, j)))
                        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(kind, pa.string()), len(p)), p, q, pa.array(s[k : k + 65536])], ["type", "a", "b", "similarity"])

    tiled, rest = _either(nodes, threshold)
    return tiled.select("type", "names", "others").mapInArrow(scored, schema).unionByName(rest)


def matching(nodes: DataFrame, threshold: float = vocab.SIMILARITY) -> DataFrame:
    """One row: the number of ``matches``, counted where they are found."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n = sum(len(i) for names, others in zip(*(x.column(c).to_pylist() for c in ("names", "others"))) for _, _, i, _, _ in tabled(names, others, threshold))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    tiled, rest = _either(nodes, threshold)
    return tiled.select("names", "others").mapInArrow(counted, "n long").unionByName(rest.agg(F.count("*").alias("n"))).agg(F.sum("n").alias("pairs"))


def matches_of(nodes: DataFrame, fresh: DataFrame, threshold: float = vocab.SIMILARITY) -> DataFrame:
    """(type, a, b, similarity) of the matches that hold a name of ``fresh``: blocks without one are never paired."""
    names = checkpointed(nodes.select("type", "name").distinct())
    new = fresh.select("name", F.lit(True).alias("fresh")).distinct()
    first = blocks(names).join(new, "name", "left").select("type", "gram", "name", F.coalesce("fresh", F.lit(False)).alias("fresh"))
    first = checkpointed(first)
    first = first.join(first.where("fresh").select("type", "gram").distinct(), ["type", "gram"], "left_semi")
    return similar(pairs_within(first, F.col("fresh_a") | F.col("fresh_b"), ("type",)), threshold)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(name, component): the smallest name that links reach, by rounds of least labels with shortcuts."""
    e = checkpointed(links.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct())
    label = checkpointed(e.groupBy(F.col("x").alias("name")).agg(F.least(F.min("y"), F.first("x")).alias("component")))
    while True:
        seen = e.join(label.select(F.col("name").alias("y"), "component"), "y").groupBy(F.col("x").alias("name")).agg(F.min("component").alias("c"))
        step = label.join(seen, "name").select("name", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        jump = step.select(F.col("name").alias("component"), F.col("component").alias("next"))
        step = checkpointed(step.join(jump, "component", "left").select("name", "was", F.coalesce("next", "component").alias("component")))
        label = step.select("name", "component")
        if step.where("was != component").isEmpty():
            return label


def resolved_components(nodes: DataFrame, threshold: float = vocab.SIMILARITY) -> DataFrame:
    """``components`` of all matches of ``nodes``, without making the pairs within what is joined already.

    The names of a type form a tree of prefixes. Each prefix has at most as many longer ones as there are characters, so
    the pairs of the least names of a prefix and of its next longer ones are few, however alike the names. Those that
    match join most of a large group. Of the pairs in blocks, only those across the components so found are left.
    """
    names = checkpointed(nodes.select("type", "name").where(F.char_length("name") > 0).distinct())
    size = F.explode(F.sequence(F.lit(1), F.char_length("name"))).alias("size")
    heads = names.select("type", "name", size).groupBy("type", F.substr("name", F.lit(1), F.col("size")).alias("head")).agg(F.min("name").alias("least"))
    above = heads.select("type", F.col("head").alias("up"), F.col("least").alias("a"))
    below = heads.select("type", F.substr("head", F.lit(1), F.char_length("head") - 1).alias("up"), F.col("least").alias("b"))
    near = above.join(below, ["type", "up"]).where("a != b").select("a", "b").distinct()
    near = checkpointed(similar(near, threshold).select("a", "b"))
    found = components(near).withColumnRenamed("component", "part")
    first = blocks(names).join(found, "name", "left").withColumn("part", F.coalesce("part", "name"))
    mixed = first.groupBy("type", "gram").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high").select("type", "gram")
    first = first.join(mixed, ["type", "gram"], "left_semi")
    rest = pairs_within(first.select("type", "gram", "name", "part"), F.col("part_a") != F.col("part_b"), ())
    return components(near.unionByName(similar(rest, threshold).select("a", "b")))


def either_way(a: Column, b: Column, pairs) -> Column:
    """One name holds the one word of a pair and the other name the other."""
    c = lambda n, w: F.contains(n, F.lit(w))
    return reduce(lambda x, y: x | y, ((c(a, p) & c(b, q)) | (c(a, q) & c(b, p)) for p, q in pairs))


def types_of(name: Column, earlier: bool = False) -> Column:
    """The kinds whose words a name holds; ``earlier`` knows only the words listed before the first of one character."""
    words = {kind: list(takewhile(lambda w: len(w) > 1, ws) if earlier else ws) for kind, ws in vocab.TYPE_WORDS.items()}
    return F.filter(F.array(*(F.when(name.rlike("|".join(ws)), kind) for kind, ws in words.items())), lambda x: x.isNotNull())


def levels(name: Column) -> Column:
    """How many of year, month, day a date names."""
    return name.rlike("年").cast("int") + name.rlike("月").cast("int") + name.rlike("日|号").cast("int")


#: The rules of the earlier set.
EARLIER = ("keywords", "semantics", "types", "date_precision", "length")


def vetoed(components: DataFrame, earlier: bool = False) -> DataFrame:
    """(component, reasons): components of which some two names, or all being numbers, forbid the merge.

    ``earlier`` applies the earlier set of rules: none on numbers, containment or person and organization endings, and
    fewer words that tell a kind of name.

    The rules hold for any two names of a component, linked or not. None needs all pairs: words, suffixes, levels and
    lengths are aggregated, sets of types are compared once for each distinct set, and a shorter name within a longer
    one is found by the up to nine substrings that are one to three characters shorter.
    """
    c = components.select("component", "name").distinct()
    n = F.char_length("name")
    has = lambda w: F.contains("name", F.lit(w))
    ends = lambda words: F.bool_or(F.col("name").rlike("(" + "|".join(words) + ")$"))
    facts = {
        "numbers": F.bool_and(F.col("name").rlike(vocab.NUMBER)) & (F.count("*") > 1),
        "person_organization": ends(vocab.PERSON_ENDS) & ends(vocab.ORGANIZATION_ENDS),
        "date_precision": F.min(F.when(levels(F.col("name")) > 0, levels(F.col("name")))) < F.max(levels(F.col("name"))),
        "length": F.min(n) / F.max(n) < 0.5,
    }
    for kind, pairs in (("keywords", vocab.KEYWORD_CONFLICTS), ("semantics", vocab.SEMANTIC_CONFLICTS)):
        facts[kind] = reduce(lambda x, y: x | y, (F.bool_or(has(p)) & F.bool_or(has(q)) & (F.count_if(has(p) | has(q)) > 1) for p, q in pairs))
    wide = c.groupBy("component").agg(*(v.alias(k) for k, v in facts.items()))
    found = wide.select("component", F.explode(F.filter(F.array(*(F.when(F.col(k), k) for k in facts)), lambda x: x.isNotNull())).alias("reason"))

    kinds = c.select("component", types_of(F.col("name"), earlier).alias("t")).where(F.size("t") > 0).distinct()  # at most as many as subsets of the kinds
    clash = kinds.alias("x").join(kinds.alias("y"), "component").where(~F.arrays_overlap("x.t", "y.t")).select("component", F.lit("types").alias("reason"))
    cut = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.transform(F.sequence(F.lit(0), 3 - i), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    parts = c.withColumn("cut", F.explode(F.filter(cut, lambda x: (x["i"] + x["j"] > 0) & (x["i"] + x["j"] < n))))
    i, j = F.col("cut.i"), F.col("cut.j")
    short = F.substr("name", i + 1, n - i - j)
    # what the longer name adds, its first occurrence of the shorter one taken away
    at = F.instr("name", F.col("short"))
    parts = parts.withColumn("short", short).withColumn("extra", F.concat(F.substr("name", F.lit(1), at - 1), F.substr("name", at + F.char_length("short"))))
    parts = parts.where(F.col("extra").rlike(f"[{vocab.DISTINCT_PARTS}]")).select("component", "short")
    held = c.join(parts.withColumnRenamed("short", "name"), ["component", "name"], "left_semi").select("component", F.lit("containment").alias("reason"))
    found = found.unionByName(clash).unionByName(held)
    if earlier:
        found = found.where(F.col("reason").isin(*EARLIER))
    return found.groupBy("component").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def alias_map(components: DataFrame, forbidden: DataFrame) -> DataFrame:
    """(name, canonical) for the components that may merge: the longest name, the smallest among those."""
    ok = components.join(forbidden, "component", "left_anti")
    best = ok.groupBy("component").agg(F.max_by("name", F.struct(F.char_length("name"), "name")).alias("last"), F.max(F.char_length("name")).alias("longest"))
    names = ok.join(best, "component").where(F.char_length("name") == F.col("longest")).groupBy("component").agg(F.min("name").alias("canonical"), F.count("*").alias("c"))
    return ok.join(names, "component").select("name", "canonical")


def resolve(nodes: DataFrame, edges: DataFrame, threshold: float = vocab.SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes and edges after resolution, and the alias map."""
    from weftgraph.operators import graph

    comp = resolved_components(nodes, threshold)
    alias = checkpointed(alias_map(comp, vetoed(comp)))
    n, e = graph.merged(nodes, edges, alias)
    return n, e, alias
