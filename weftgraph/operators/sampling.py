"""Path samplers over the graph, seeded by hashes so that results repeat.

A walker takes a successor by number (``graph.neighbours``), so a step is an equi-join of walkers and numbered edges on
(node, number): a hub with many edges adds no rows to a walker. Attempts are a multiple of the samples asked for, as
some walks end early; the first samples in the order of a hash are kept.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions import vocab
from weftgraph.functions.text import draw, order_of
from weftgraph.operators import graph
from weftgraph.session import materialise

RELATED = "相关"


def top(rows: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """The first ``n`` rows in the order of a hash: a sample without replacement."""
    return rows.orderBy(order_of(seed, *keys), *keys).limit(n)


def numbered(names: DataFrame, n: int, seed: str) -> DataFrame:
    """(walker, name): ``n`` walkers at most, each on another node, in the order of a hash."""
    few = top(names.select("name"), n, seed, "name")
    return few.withColumn("walker", F.row_number().over(Window.orderBy(order_of(seed, "name"), "name")) - 1)  # n rows


def with_degree(near: DataFrame) -> DataFrame:
    return near.groupBy("src").agg(F.count("*").alias("n"))


def walk(starts: DataFrame, near: DataFrame, steps: int, seed: str) -> DataFrame:
    """(walker, path): walks of ``steps`` hops over uniform successors; walks that end early are left out."""
    n = with_degree(near)
    w = starts.select("walker", F.array("name").alias("path"))
    for k in range(steps):
        w = w.withColumn("src", F.element_at("path", -1)).join(n, "src")
        w = w.withColumn("rank", (draw(f"{seed}.{k}", "walker") % F.col("n")).cast("int"))
        w = w.join(near, ["src", "rank"]).select("walker", F.array_append("path", F.col("dst")).alias("path"))
    return w


def long_walk(starts: DataFrame, near: DataFrame, most: int, least: int, seed: str) -> DataFrame:
    """(walker, path) of ``least`` to ``most`` nodes, avoiding the last three nodes where it can, else the last two.

    Of four successors with numbers in a row one at least is none of three nodes, so four candidates are enough.
    """
    n = with_degree(near)
    w = starts.select("walker", F.array("name").alias("path"), F.lit(True).alias("on"))
    for k in range(most - 1):
        # walkers that go on have their node as the key; the others keep their path through the outer joins
        w = w.withColumn("src", F.when(F.col("on"), F.element_at("path", -1))).join(n, "src", "left")
        first = draw(f"{seed}.{k}", "walker")
        tries = F.when(F.col("n").isNotNull(), F.transform(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(4)).cast("int") - 1), lambda i: ((first + i) % F.col("n")).cast("int")))
        w = w.withColumn("try", F.explode_outer(F.arrays_zip(tries.alias("rank"), F.transform(tries, lambda x, i: i).alias("i"))))
        w = w.select("walker", "path", "src", F.col("try.rank").alias("rank"), F.col("try.i").alias("i")).join(near, ["src", "rank"], "left")
        last = lambda m: F.slice("path", -F.least(F.lit(m), F.size("path")), F.lit(m))
        choice = F.when(F.col("dst").isNull(), None).when(~F.array_contains(last(3), F.col("dst")), 0).when(~F.array_contains(last(2), F.col("dst")), 1)
        w = w.withColumn("choice", choice).groupBy("walker").agg(F.first("path").alias("path"), F.min(F.when(F.col("choice").isNotNull(), F.struct("choice", "i", "dst"))).alias("best"))
        w = w.select("walker", F.when(F.col("best").isNotNull(), F.array_append("path", F.col("best.dst"))).otherwise(F.col("path")).alias("path"), F.col("best").isNotNull().alias("on"))
    return w.where(F.size("path") >= least).select("walker", "path")


def hops(paths: DataFrame, *keys: str) -> DataFrame:
    """(keys, hop, subject, object): the pairs of nodes in a row."""
    pair = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.element_at("path", i).alias("subject"), F.element_at("path", i + 1).alias("object")))
    rows = paths.where(F.size("path") > 1).select(*keys, F.posexplode(pair).alias("hop", "p"))
    return rows.select(*keys, (F.col("hop") + 1).alias("hop"), "p.subject", "p.object")


def path_triples(paths: DataFrame, edges: DataFrame, *keys: str, default: str = RELATED, seed: str | None = None, reverse: bool = False) -> DataFrame:
    """(keys, hop, subject, relation, object): the first relation of each hop, or with a seed one by hash.

    Without an edge the relation is ``default``; with ``reverse`` an edge the other way gives its relation after 被.
    """
    h = hops(paths, *keys)
    if seed is None:
        r = edges.groupBy("src", "dst").agg(F.min_by("relation", F.struct("seq", "relation")).alias("relation"))
    else:
        w = Window.partitionBy("src", "dst").orderBy(order_of(seed, "src", "relation", "dst"))
        r = edges.withColumn("k", F.row_number().over(w)).where("k = 1").select("src", "dst", "relation")
    out = h.join(r.select(F.col("src").alias("subject"), F.col("dst").alias("object"), "relation"), ["subject", "object"], "left")
    if reverse:
        back = r.select(F.col("dst").alias("subject"), F.col("src").alias("object"), F.concat(F.lit("被"), "relation").alias("back"))
        out = out.join(back, ["subject", "object"], "left").withColumn("relation", F.coalesce("relation", "back"))
    return out.select(*keys, "hop", "subject", F.coalesce("relation", F.lit(default)).alias("relation"), "object")


def choice(values, seed: str, *keys: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (draw(seed, *keys) % len(values) + 1).cast("int"))


def chains(nodes: DataFrame, edges: DataFrame, length: int = 5, num: int = 15, seed: str = "chain", attempts: int = 100) -> DataFrame:
    """(walker, path, target_entity, question_payload_type): chain samples of exactly ``length`` hops."""
    paths = walk(numbered(nodes, num * attempts, seed), graph.neighbours(edges), length, seed)
    return top(paths, num, seed + ".keep", "walker").select("walker", "path", F.element_at("path", -1).alias("target_entity"), choice(vocab.CHAIN_PAYLOADS, seed + ".type", "walker").alias("question_payload_type"))


def crossings(edges: DataFrame, clues: int = 3, num: int = 10, seed: str = "cross") -> DataFrame:
    """(convergence_node, clue_sources, num_clues, main_source, auxiliary, payload): nodes that ``clues`` sources point to.

    Where no node has so many, two are enough.
    """
    near = edges.select("src", "dst").distinct()
    n = near.groupBy("dst").agg(F.count("*").alias("sources"))
    most = n.agg(F.max("sources").alias("most"))
    need = F.when(F.col("most") >= clues, clues).otherwise(F.lit(min(clues, 2)))
    ok = n.join(F.broadcast(most), F.lit(True)).where(F.col("sources") >= need).select(F.col("dst"), need.alias("k"))  # ``most`` is one row
    few = top(ok, num, seed, "dst")
    w = Window.partitionBy("dst").orderBy(order_of(seed + ".source", "dst", "src"))
    got = near.join(few, "dst").withColumn("i", F.row_number().over(w)).where("i <= k")
    got = got.groupBy("dst", "k").agg(F.sort_array(F.collect_list(F.struct("i", "src"))).alias("s"))
    return got.select(
        F.col("dst").alias("convergence_node"), F.col("s.src").alias("clue_sources"), F.size("s").alias("num_clues"), F.col("s")[0]["src"].alias("main_source"),
        F.slice(F.col("s.src"), 2, 2).alias("auxiliary"), choice(vocab.CROSS_PAYLOADS, seed + ".type", "dst").alias("question_payload_type"),
    )


def anchors(degrees: DataFrame) -> DataFrame:
    """Names with two edges in and two out at least, or of a telling form; else the twenty of highest degree."""
    telling = F.lower("name").rlike(vocab.ANCHOR_WORDS) | F.col("name").rlike("^[0-9]+$")
    rows = degrees.withColumn("ok", ((F.col("n_in") >= 2) & (F.col("n_out") >= 2)) | telling)
    some = rows.agg(F.max("ok").alias("some"))
    fallback = rows.orderBy(F.desc("degree"), "name").limit(20).join(F.broadcast(some), F.lit(True)).where("not some").select("name")
    return rows.where("ok").select("name").unionByName(fallback)


def anchor_class(name: Column) -> Column:
    out = F.lit("general")
    for kind, pattern in reversed(vocab.ANCHOR_CLASSES):
        out = F.when(F.lower(name).rlike(pattern), kind).otherwise(out)
    return out


def pivots(edges: DataFrame, longest: int = 4, num: int = 10, seed: str = "anchor", chance: float = 0.6) -> DataFrame:
    """(anchor_node, pivot_type, path): a source, the anchor, a target that differ, each end extended by chance."""
    edges = materialise(edges.select("src", "dst"), "edges")  # read many times below
    few = materialise(top(anchors(graph.degrees(edges)), num * 10, seed, "name").select(F.col("name").alias("anchor")), "anchors")
    one = edges.distinct()
    pick = lambda rows, key, other, s: rows.groupBy(key).agg(F.min_by(other, order_of(s, key, other)).alias(other))
    into = pick(one.join(few, F.col("dst") == F.col("anchor"), "left_semi").where("src != dst"), "dst", "src", seed + ".in").select(F.col("dst").alias("anchor"), F.col("src").alias("source"))
    out = one.join(few, F.col("src") == F.col("anchor"), "left_semi").join(into, F.col("src") == F.col("anchor")).where("dst != source and dst != src")
    out = pick(out.select("src", "dst"), "src", "dst", seed + ".out").select(F.col("src").alias("anchor"), F.col("dst").alias("target"))
    base = materialise(into.join(out, "anchor"), "pivots")
    before = pick(one.join(base.select(F.col("source").alias("dst")).distinct(), "dst"), "dst", "src", seed + ".before").select(F.col("dst").alias("source"), F.col("src").alias("b"))
    after = pick(one.join(base.select(F.col("target").alias("src")).distinct(), "src"), "src", "dst", seed + ".after").select(F.col("src").alias("target"), F.col("dst").alias("a"))
    rows = base.join(before, "source", "left").join(after, "target", "left")
    p = lambda s: draw(seed + s, "anchor") < int(chance * (1 << 32))
    core = F.array("source", "anchor", "target")
    left = F.when(p(".left") & F.col("b").isNotNull() & ~F.array_contains(core, F.col("b")) & F.lit(longest > 3), F.array("b")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("path", F.concat(left, core))
    right = p(".right") & F.col("a").isNotNull() & ~F.array_contains("path", F.col("a")) & (F.size("path") < longest)
    rows = rows.withColumn("path", F.when(right, F.array_append("path", F.col("a"))).otherwise(F.col("path")))
    return top(rows.select(F.col("anchor").alias("anchor_node"), anchor_class(F.col("anchor")).alias("pivot_type"), "path"), num, seed + ".keep", "anchor_node")


def mix_counts(total: int, weights: dict[str, float] | None = None) -> dict[str, int]:
    """Samples of each strategy: shares cut to whole numbers, the rest to anchors. Negative weights count as none."""
    weights = {k: max(0.0, v) for k, v in (weights or vocab.MIX_DEFAULT).items()}
    whole = sum(weights.values()) or 1.0
    chain, cross = int(total * weights.get("chain", 0) / whole + 1e-9), int(total * weights.get("cross", 0) / whole + 1e-9)
    return {"chain": chain, "cross": cross, "anchor": total - chain - cross}


def adaptive_weights(level: str, average_degree: float) -> dict[str, float]:
    """Weights by complexity, shifted to crossings and anchors in dense graphs and to chains in sparse ones."""
    w = dict(vocab.MIX_LEVELS.get(level, vocab.MIX_LEVELS["high"])[0])
    shift = {"cross": 0.1, "anchor": 0.1, "chain": -0.2} if average_degree > 10 else {"chain": 0.2, "cross": -0.1, "anchor": -0.1} if average_degree < 3 else {}
    return {k: max(0.0, v + shift.get(k, 0.0)) for k, v in w.items()}


def mixture(nodes: DataFrame, edges: DataFrame, total: int, weights: dict[str, float] | None = None, seed: str = "mix", length: int = 5, clues: int = 3, longest: int = 4) -> DataFrame:
    """(architecture, target_entity, path) of all strategies, in the order of a hash."""
    n = mix_counts(total, weights)
    a = chains(nodes, edges, length, n["chain"], seed + ".chain").select(F.lit("Chain Reasoning").alias("architecture"), "target_entity", "path")
    b = crossings(edges, clues, n["cross"], seed + ".cross").select(F.lit("Cross Referencing").alias("architecture"), F.col("convergence_node").alias("target_entity"), F.array("main_source", "convergence_node").alias("path"))
    c = pivots(edges, longest, n["anchor"], seed + ".anchor").select(F.lit("Anchor Pivot").alias("architecture"), F.element_at("path", -1).alias("target_entity"), "path")
    return a.unionByName(b).unionByName(c).orderBy(order_of(seed, "architecture", "target_entity"))


def lengths(n: int, low: int, high: int, seed: str) -> dict[int, int]:
    """How many of ``n`` samples have each length of a range, each sample's length taken by a hash."""
    return dict(sorted(Counter(low + zlib.crc32(f"{seed}.{i}".encode()) % (high - low + 1) for i in range(n)).items()))


def adaptive_mixture(nodes: DataFrame, edges: DataFrame, total: int = 50, level: str = "medium", seed: str = "adapt") -> DataFrame:
    """(architecture, size, target_entity, path): a mixture whose weights follow the density of the graph and whose
    lengths, numbers of clues and longest pivots (``size``) come from the ranges of a level of complexity."""
    n = mix_counts(total, adaptive_weights(level, graph.size(nodes, edges).first()["average_degree"]))
    _, chain, cross, anchor = vocab.MIX_LEVELS.get(level, vocab.MIX_LEVELS["high"])
    out = []
    for k, m in lengths(n["chain"], *chain, seed + ".chain").items():
        out.append(chains(nodes, edges, k, m, f"{seed}.chain{k}").select(F.lit("Chain Reasoning").alias("architecture"), F.lit(k).alias("size"), "target_entity", "path"))
    for k, m in lengths(n["cross"], *cross, seed + ".cross").items():
        out.append(crossings(edges, k, m, f"{seed}.cross{k}").select(F.lit("Cross Referencing").alias("architecture"), F.lit(k).alias("size"), F.col("convergence_node").alias("target_entity"), F.array("main_source", "convergence_node").alias("path")))
    for k, m in lengths(n["anchor"], *anchor, seed + ".anchor").items():
        out.append(pivots(edges, k, m, f"{seed}.anchor{k}").select(F.lit("Anchor Pivot").alias("architecture"), F.lit(k).alias("size"), F.element_at("path", -1).alias("target_entity"), "path"))
    empty = nodes.sparkSession.createDataFrame([], "architecture string, size int, target_entity string, path array<string>")
    rows = reduce(DataFrame.unionByName, out, empty)
    return rows.orderBy(order_of(seed, "architecture", "target_entity"), "size")


def novel(paths: DataFrame, group: str, most: float = 0.7) -> DataFrame:
    """Paths whose node set is like that of no accepted earlier path of the group, by Jaccard similarity.

    A group holds the few attempts of one start node, whose number is a parameter of the sampler.
    """
    ordered = paths.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("walker", "path"))).alias("all"))
    like = lambda a, b: F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    start = F.array().cast(ordered.schema["all"].dataType)
    kept = F.aggregate("all", start, lambda acc, p: F.when(F.exists(acc, lambda q: like(q["path"], p["path"]) > most), acc).otherwise(F.array_append(acc, p)))
    return ordered.select(group, F.explode(kept).alias("k")).select(group, "k.walker", "k.path")


def clue_paths(nodes: DataFrame, edges: DataFrame, most: int = 4, strategy: str = "integrated", seed: str = "clue") -> DataFrame:
    """(answer, k, path): independent one-hop clues of each node, from its predecessors, or outgoing ones where it has
    fewer than two. The three-stage strategy asks for two successors then and extends by a hop."""
    one = edges.select("src", "dst").distinct().where("src != dst")
    n = one.groupBy(F.col("dst").alias("answer")).agg(F.count("*").alias("c"))
    rank = lambda rows, other: rows.withColumn("k", F.row_number().over(Window.partitionBy("answer").orderBy(order_of(seed, "answer", other), other))).where(F.col("k") <= most)
    many = n.where("c >= 2").select("answer")
    into = rank(one.select(F.col("dst").alias("answer"), "src").join(many, "answer", "left_semi"), "src").select("answer", "k", F.array("src", "answer").alias("path"))
    rest = nodes.select(F.col("name").alias("answer")).join(many, "answer", "left_anti")
    out = rank(one.select(F.col("src").alias("answer"), "dst").join(rest, "answer", "left_semi"), "dst").select("answer", "k", F.array("answer", "dst").alias("path"))
    if strategy == "three_stage":
        two = out.groupBy("answer").agg(F.count("*").alias("c")).where("c >= 2").select("answer")
        more = one.groupBy("src").agg(F.min_by("dst", order_of(seed + ".more", "src", "dst")).alias("next"))
        out = out.join(two, "answer", "left_semi").withColumn("src", F.element_at("path", -1)).join(more, "src", "left")
        out = out.select("answer", "k", F.when(F.col("next").isNotNull() & ~F.array_contains("path", F.col("next")), F.array_append("path", F.col("next"))).otherwise(F.col("path")).alias("path"))
    return into.unionByName(out)


def clue_packages(clues: DataFrame, num: int, seed: str = "package") -> DataFrame:
    """(sample_id, answer_entity, independent_paths, clue_entities, num_clue_paths) of answers with two clues at least."""
    rows = clues.groupBy("answer").agg(F.sort_array(F.collect_list(F.struct("k", "path"))).alias("p")).where(F.size("p") >= 2)  # four at most
    few = top(rows, num, seed, "answer")
    ends = F.transform("p", lambda x: F.when(F.element_at(x["path"], -1) != F.col("answer"), F.element_at(x["path"], -1)).otherwise(F.element_at(x["path"], -2)))
    return few.select(
        F.concat(F.lit("multi_clue_"), F.substr(F.md5("answer"), F.lit(1), F.lit(8)), F.lit("_"), F.size("p").cast("string")).alias("sample_id"), F.lit("multi_source_clue_aggregation").alias("strategy"),
        F.col("answer").alias("answer_entity"), F.transform("p", lambda x: x["path"]).alias("independent_paths"), ends.alias("clue_entities"), F.size("p").alias("num_clue_paths"),
    )


def shortest(edges: DataFrame, pairs: DataFrame, longest: int = 3) -> DataFrame:
    """(source, target, n, path): the shortest path of each pair of up to ``longest`` hops, of several the first by names.

    Paths grow backwards from the targets. A state is a target and a node that reaches it, with the node's best path:
    whatever leads to the node goes on along that path, so states grow neither with the sources nor with the hubs
    between. The last hop is taken by sources only. A walk of as many hops finds no answer that this does not, so none
    is tried after it.
    """
    one = materialise(edges.select(F.col("src").alias("from"), F.col("dst").alias("node")).distinct(), "edges")  # read for every hop
    pairs = materialise(pairs.select("source", "target").distinct(), "pairs")
    found = front = pairs.select(F.col("target").alias("node"), "target", F.lit(0).alias("n"), F.array("target").alias("path")).distinct()
    for k in range(1, longest + 1):
        step = front.join(one, "node").select(F.col("from").alias("node"), "target", "path")
        if k == longest:
            step = step.join(pairs.select(F.col("source").alias("node"), "target"), ["node", "target"], "left_semi")
        step = step.join(found.select("node", "target"), ["node", "target"], "left_anti").groupBy("node", "target").agg(F.min("path").alias("path"))
        front = materialise(step.select("node", "target", F.lit(k).alias("n"), F.concat(F.array("node"), "path").alias("path")), "reach")
        found = found.unionByName(front)
    return pairs.join(found.withColumnRenamed("node", "source"), ["source", "target"]).select("source", "target", "n", "path")


def expanded(paths: DataFrame, per_path: int = 2, seed: str = "expand") -> DataFrame:
    """Samples from triples of a path (sample_id, triples): ``per_path`` target entities of each, the rest being clues."""
    entities = F.array_distinct(F.flatten(F.transform("triples", lambda t: F.array(t["subject"], t["object"]))))
    rows = paths.withColumn("entities", entities).withColumn("e", F.explode("entities"))
    w = Window.partitionBy("sample_id").orderBy(order_of(seed, "sample_id", "e"), "e")
    rows = rows.withColumn("i", F.row_number().over(w)).where(F.col("i") <= per_path)
    of = F.filter("triples", lambda t: t["object"] == F.col("e"))
    some = F.size(of) > 0
    last = F.element_at("triples", -1)
    target = F.when(some, F.element_at(of, -1)).otherwise(last)
    entity = F.when(some, F.col("e")).otherwise(last["object"])
    clues = F.when(some, F.filter("triples", lambda t: t["object"] != F.col("e"))).otherwise(F.slice("triples", F.lit(1), F.size("triples") - 1))
    out = rows.select("sample_id", "i", "triples", "entities", target.alias("t"), entity.alias("target_entity"), clues.alias("clue_triples"))
    chain = F.array_join(F.transform("triples", lambda t: F.concat(F.lit("("), t["subject"], F.lit(","), t["relation"], F.lit(","), t["object"], F.lit(")"))), " -> ")
    return out.select(F.concat_ws("_", "sample_id", F.col("i").cast("string")).alias("sample_id"), "target_entity", F.col("t.relation").alias("target_relation"), F.size("clue_triples").alias("clue_count"), chain.alias("reasoning_chain_raw"), F.array_except("entities", F.array("target_entity")).alias("clue_entities"), "clue_triples", F.col("triples").alias("original_path"))
