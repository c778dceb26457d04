"""Queries over all that their tables hold, against brute force and SQL."""

from itertools import combinations

import pytest
from oracle import same
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import graph, resolve
from weftgraph.plans import registry
from weftgraph.plans.base import graph_of

SF = "/root/testdata/sf0.001"


def reached(names, links):
    """(name, smallest name that links reach) of linked names."""
    comp = {n: n for n in names}
    for a, b in links:
        x, y = comp[a], comp[b]
        if x != y:
            comp = {n: min(x, y) if c in (x, y) else c for n, c in comp.items()}
    return {n: comp[n] for pair in links for n in pair}


def test_all_types_are_resolved(spark):
    nodes, edges = (x.toPandas() for x in graph_of(spark, SF))
    links = {(t, *p) for t, rows in nodes.groupby("type") for p in combinations(sorted(rows["name"]), 2) if text.jaro_winkler(*p) >= 0.9}
    assert {"Customer", "Supplier"} <= {t for t, _, _ in links}
    q = registry.queries()
    assert q["er_blocking"](spark, SF).first().pairs == len(links)
    assert {(r.type, r.a, r.b) for r in q["er_similarity"](spark, SF).collect()} == links
    comp = reached(nodes["name"], [p for _, *p in links])
    got = q["er_components"](spark, SF).collect()
    assert len(got) == len(comp) and {r.name: r.component for r in got} == comp
    no = {r.component for r in resolve.vetoed(spark.createDataFrame(list(comp.items()), "name string, component string")).collect()}
    best = {}
    for n, c in comp.items():
        best[c] = min(best.get(c, n), n, key=lambda x: (-len(x), x))
    alias = {n: best[c] for n, c in comp.items() if c not in no}
    assert {r.name: r.canonical for r in q["er_canonical"](spark, SF).collect()} == alias
    want = {(alias.get(e.src, e.src), alias.get(e.dst, e.dst), e.relation) for e in edges.itertuples()}
    got = q["er_resolved_edges"](spark, SF).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_components_without_the_pairs_within(spark):
    names = ["alpha one", "alpha onee", "alpah one", "xalpha one", "beta", "betta", "gamma", "gamma ray", "x", "xy", "aaaa", "aaaaa", "baaaa", "", "ünï", "ünïx", *(f"Item#{i:06}" for i in range(0, 4000, 37))]
    n = spark.createDataFrame([(x, t) for x in names for t in ("T", "U") if t == "T" or "a" in x], "name string, type string")
    links = [p for p in combinations(sorted(names), 2) if text.jaro_winkler(*p) >= 0.9]
    assert {r.name: r.component for r in resolve.resolved_components(n).collect()} == reached(names, links)


@pytest.mark.parametrize("name", ["er_jaro_winkler", "extraction_prompts", "session_triples", "stage_snapshots", "question_batches", "link_extraction", "url_normalisation", "noise_removal"])
def test_with_sql(spark, name):
    same(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF)


def test_every_turn_reaches_a_prompt(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").groupBy("conv_id").count().collect()
    got = {(r.conv_id, r.chunk) for r in registry.queries()["extraction_prompts"](spark, SF).collect()}
    assert got == {(r.conv_id, k) for r in turns for k in range(-(-r["count"] // 3))}
