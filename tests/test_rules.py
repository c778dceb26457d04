"""Rules on hand-written cases."""

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import extraction, graph, pages, resolve, sampling, synthesis
from weftgraph.plans.resolve_queries import GROUPS
from weftgraph.sources import tables


@pytest.mark.parametrize(("a", "b", "want"), [("约翰·麦卡锡", "约翰 麦卡锡", 0.9111), ("深度学习", "深度学习技术", 0.9333), ("特斯拉公司", "特斯拉", 0.9067), ("北京大学", "北大", 0.85), ("清华大学", "清华", 0.8667), ("", "a", 0.0), ("a", "a", 1.0)])
def test_jaro_winkler(a, b, want):
    assert round(text.jaro_winkler(a, b), 4) == want


def test_jaro_winkler_of_null():
    assert text.jaro_winkler(None, "a") is None


def test_jaro_winkler_of_many_pairs():
    draw = random.Random(3)
    name = lambda: "".join(draw.choice("ab#0é深𝒳") for _ in range(draw.choice((0, 1, 2, 3, 9, 18, 70))))
    a = [name() if draw.random() > 0.02 else None for _ in range(4000)]
    b = [x[:-1] + name()[:2] if x and draw.random() < 0.5 else name() for x in a]
    want = [text.jaro_winkler(x, y) for x, y in zip(a, b)]
    for cells in (100, 1 << 22):  # pairs one by one, and all at once
        assert [None if s != s else s for s in text.jaro_winklers(a, b, cells).tolist()] == want


def test_split_blocks_give_the_same_pairs(spark):
    rows = spark.createDataFrame([("T", g, f"name {i:02d}", i % 3) for g in ("x", "y") for i in range(30)], "type string, gram string, name string, part int")
    got = resolve.pairs_within(rows, F.col("part_a") != F.col("part_b"), ("type",), side=7).collect()
    assert sorted((r.a, r.b) for r in got) == [(f"name {i:02d}", f"name {j:02d}") for i in range(30) for j in range(i + 1, 30) if i % 3 != j % 3]


def test_vetoes(spark):
    rows = spark.createDataFrame([(g, n) for g, names in GROUPS for n in names], "component string, name string")
    blocked = {r.component for r in resolve.vetoed(rows).collect()}
    assert blocked == {"g1", "g2", "g3", "g4", "g5", "g8", "g9", "g10", "g11", "g12", "g13"}


def test_candidates_find_every_match(spark):
    names = ["alpha one", "alpha onee", "alpah one", "beta", "betta", "gamma", "gamma ray", "x", "xy", "aaaa", "aaaaa", "baaaa"]
    n = spark.createDataFrame([(x, "T", [x]) for x in names], "name string, type string, names array<string>")
    got = {(r.a, r.b) for r in resolve.matches(n).collect()}
    assert got == {(a, b) for a in names for b in names if a < b and text.jaro_winkler(a, b) >= 0.9}


def test_empty_graph(spark):
    t = spark.createDataFrame([], "subject string, relation string, object string, source_url string, seq bigint, subject_type string, object_type string")
    n, e = graph.nodes(t), graph.edges(t)
    assert graph.size(n, e).first().asDict() == {"total_nodes": 0, "total_edges": 0, "average_degree": 0.0}
    assert resolve.resolve(n, e)[1].count() == 0
    assert sampling.chains(n, e).count() == 0


def test_rejects(spark):
    t = spark.createDataFrame([("a", "r", "b", "u", 1, None, None), (None, "r", "b", "u", 2, None, None), ("a", "", "b", "u", 3, None, None)], "subject string, relation string, object string, source_url string, seq bigint, subject_type string, object_type string")
    assert graph.rejected(t).count() == 2
    assert [(r.name, r.type) for r in graph.nodes(t).orderBy("name").collect()] == [("a", "Unknown"), ("b", "Unknown")]


def test_last_source_wins(spark):
    t = spark.createDataFrame([("a", "r", "b", "u1", 1, "A", "B"), ("a", "r", "b", "u2", 2, "C", "D")], "subject string, relation string, object string, source_url string, seq bigint, subject_type string, object_type string")
    assert graph.edges(t).first().source_url == "u2"
    assert {r.name: r.type for r in graph.nodes(t).collect()} == {"a": "A", "b": "B"}


def test_blocks():
    html = '<body><div class="top-tool">no</div><p>main</p><table class="infobox"><tr><td>k</td><td>v</td></tr></table><p class="summary">sum</p><p class="summary">sum</p></body>'
    assert pages.parse_blocks(html) == [("main", "main k v sum sum"), ("bs4_infobox", "k\nv"), ("bs4_summary", "sum")]
    assert pages.parse_blocks(None) == []


def test_render_rule(spark):
    rows = spark.createDataFrame([(None,), ("x" * 600,), ("x" * 600 + "<NOSCRIPT>",), ("short",)], "html string")
    assert [r.n for r in rows.select(pages.needs_render(F.col("html")).alias("n")).collect()] == [True, False, True, True]


def test_failing_model_becomes_rows(spark):
    def broken(prompts):
        raise RuntimeError("429")

    got = extraction.call_model(spark.createDataFrame([("p",)], "prompt string"), broken, attempts=2).first()
    assert (got.reply.ok, got.reply.error) == (False, "429")


def test_leaks(spark):
    rows = spark.createDataFrame([("The Alpha team", "alpha", True), ("none", "alpha", False), ("has lph in it", "alpha", True), (None, "a", False), ("xy", "xy", True)], "t string, e string, want boolean")
    assert all(r.want == r.got for r in rows.withColumn("got", text.leaks(F.col("t"), F.col("e"))).collect())


def test_mix_counts():
    assert sampling.mix_counts(20) == {"chain": 12, "cross": 5, "anchor": 3}
    assert sampling.adaptive_weights("low", 2.0)["anchor"] == 0.0


def test_load_of_nothing(spark, tmp_path):
    n, e = tables.load_graph(spark, str(tmp_path / "none"))
    assert (n.count(), e.count()) == (0, 0)


def test_link_forms(spark):
    html = """<a class="x" href="/a">one</a> <A HREF='/b'>two</A> <a href=/c>three</a> <a href = "//o.org/d?q">four</a><a name="n">no</a>"""
    rows = spark.createDataFrame([(1, "https://h.org/p/q", html)], "page_id bigint, url string, html string")
    got = pages.links(rows).select("href", "link_text", pages.resolved(F.col("url"), F.col("href")).alias("to")).collect()
    assert [tuple(r) for r in got] == [("/a", "one", "https://h.org/a"), ("/b", "two", "https://h.org/b"), ("/c", "three", "https://h.org/c"), ("//o.org/d?q", "four", "https://o.org/d")]


WIKI = """<body><nav>n</nav><div id="mw-content-text"><p>text <b>bold</p><div class="navbox x">box<div>in</div></div><ol class="references"><li>r</ol><ul class="references"><li>kept</ul>
<h2>early</h2><p>one</p><h2><span class="mw-headline" id="外部链接">l</span></h2><ul><li>gone</li></ul><p>gone</p><h3>next</h3><p>two</p><h2><span id="参见">s</span></h2><p>gone</p></div><footer>f</footer></body>"""


def test_clean_wiki():
    got = pages.clean_html(WIKI, "https://w.org/x")
    assert got.startswith('<div id="mw-content-text">') and got.endswith("</div>")
    assert all(x in got for x in ("text <b>bold", "kept", "early", "one", "next", "two"))
    assert not any(x in got for x in ("box", "<li>r", "gone", "外部链接", "参见", "<nav>", "<footer>"))


@pytest.mark.parametrize(
    ("html", "url", "want"),
    [
        ('<body><div class="a main-content">x<div class="top-tool">t<div>u</div></div>y</div>z</body>', "https://baike.baidu.com/item/a", '<div class="a main-content">xy</div>'),
        ("<body>a<nav>b</nav></body>", "https://baike.baidu.com/item/a", "<body>a<nav>b</nav></body>"),
        ("<main>m</main><ARTICLE id=q>a &amp; <article>b</article></ARTICLE>c", "u", "<ARTICLE id=q>a &amp; <article>b</article></ARTICLE>"),
        ("<body>x<main>m<p>open</main>", "u", "<main>m<p>open</main>"),
        ("<html><body>a<nav>b<nav>c</nav></nav>d<script>if (a<b) '</p>'</script>e</body></html>", "u", "<body>ade</body>"),
        ("<p>only\n<br/>text", None, "<p>only\n<br/>text"),
        ("</div><body>never closed", "u", "<body>never closed"),
        (None, "u", ""),
        ("", None, ""),
    ],
)
def test_clean_regions(html, url, want):
    assert pages.clean_html(html, url) == want


def test_clean_of_many_elements():
    assert len(pages.clean_html("<body>" + "<div>" * 50_000 + "x" + "</p>" * 50_000, "u")) == 6 + 250_000 + 1 + 200_000


def test_crawl_of_a_site(spark):
    link = lambda *to: "".join(f'<a href="{t}">to {t}</a>' for t in to)
    rows = [(1, "https://h.org/a", link("/b", "/c", "/none")), (2, "https://h.org/b", link("/d", "/a")), (3, "https://h.org/c", link("/d", "https://o.org/x")), (4, "https://h.org/d", link("/e")), (5, "https://h.org/e", None), (6, "https://o.org/x", link("/y"))]
    p = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = pages.crawl(spark, p.where("page_id = 1").select("url"), p, max_depth=3).collect()
    assert [(r.url[-1], r.depth, [u[-1] for u in r.history]) for r in got] == [("a", 0, ["a"]), ("b", 1, ["a", "b"]), ("c", 1, ["a", "c"]), ("d", 2, ["a", "b", "d"]), ("e", 3, ["a", "b", "d", "e"])]
    assert [r.url[-1] for r in pages.crawl(spark, p.where("page_id = 1").select("url"), p, max_depth=3, max_pages=2).collect()] == ["a", "b"]


def test_shortest_paths(spark):
    e = spark.createDataFrame([(a, b) for a, b in ("ab", "ac", "bd", "cd", "de", "ef", "ba")], "src string, dst string")
    pairs = spark.createDataFrame([(a, b) for a, b in ("ad", "ae", "af", "aa", "da", "zz", "ad")], "source string, target string")
    got = {(r.source, r.target): "".join(r.path) for r in sampling.shortest(e, pairs).collect()}
    assert got == {("a", "d"): "abd", ("a", "e"): "abde", ("a", "a"): "a", ("z", "z"): "z"}


def test_adaptive_mixture(spark):
    names = [f"n{i:02d}" for i in range(60)]
    n = spark.createDataFrame([(x, "T", [x]) for x in names], "name string, type string, names array<string>")
    e = spark.createDataFrame([(names[i], names[(i * 7 + j) % 60], "r", "u", i * 10 + j) for i in range(60) for j in range(1, 6)], "src string, dst string, relation string, source_url string, seq bigint")
    got = sampling.adaptive_mixture(n, e, 12, "low").collect()
    low = {"Chain Reasoning": (2, 4), "Cross Referencing": (2, 3), "Anchor Pivot": (3, 4)}
    assert got and all(low[r.architecture][0] <= r["size"] <= low[r.architecture][1] for r in got)
    assert all(len(r.path) == r["size"] + 1 for r in got if r.architecture == "Chain Reasoning")
    assert sum(r.architecture == "Chain Reasoning" for r in got) == sampling.mix_counts(12, sampling.adaptive_weights("low", 5.0))["chain"]
    assert sampling.lengths(100, 2, 4, "s") == sampling.lengths(100, 2, 4, "s") and sum(sampling.lengths(100, 2, 4, "s").values()) == 100


def test_lines_with_a_separator(spark):
    rows = spark.createDataFrame([("first | some content\nnone\nsecond | more content",), ("plain line here",)], "r string")
    got = rows.select(synthesis.pattern_lines(F.col("r"), "描述", F.lit(5), r"\|").alias("x")).collect()
    assert [r.x for r in got] == [["some content", "more content"], ["plain line here"]]


def test_model_rows_are_asked_again(spark):
    seen = []

    def model(prompts):
        seen.append(len(prompts))
        if len(seen) == 1:
            return ["one", "", None]
        if len(seen) == 2:
            raise extraction.RateLimited("429")
        return ["two"] * len(prompts)

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string").coalesce(1)
    assert [(r.reply.ok, r.reply.text) for r in extraction.call_model(rows, model, at_once=1, waits=(0, 0)).collect()] == [(True, "one"), (True, "two"), (True, "two")]

    def refusing(prompts):
        raise extraction.Refused("401") if not seen else RuntimeError("called again")

    seen.clear()
    assert extraction.call_model(rows, refusing, at_once=1, waits=(0, 0)).first().reply.error == "401"


def test_scan_of_html_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.html").write_text("<p>深</p>", encoding="utf-8")
    (tmp_path / "in" / "b.html").write_bytes(b"\xff\xfe<p>")
    (tmp_path / "c.txt").write_text("no")
    got = tables.read_pages(spark, str(tmp_path))
    assert tables.scan_counts(got).first().asDict() == {"files": 2, "readable": 1, "skipped": 1}
    assert got.where("readable").first().html == "<p>深</p>"
