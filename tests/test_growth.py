"""Steps whose work or memory must not outgrow their tables."""

import threading

from pyspark.sql import functions as F

from weftgraph.operators import graph, sampling

TRIPLE = "subject string, relation string, object string, source_url string, seq bigint, subject_type string, object_type string"


def within(spark, seconds, run):
    """What ``run`` gives; its jobs fail after some time."""
    t = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    t.start()
    try:
        return run()
    finally:
        t.cancel()


def test_shortest_paths_pass_hubs(spark):
    """sources beside hubs; forwards, each source has a state for all 3,000 names that a hub leads to, and each of these leads to all."""
    n = 3000
    rows = [(f"s{i:04}", "hub") for i in range(n)] + [("hub", f"m{i:04}") for i in range(n)] + [(f"m{i:04}", "mid") for i in range(n)] + [("mid", "end"), ("m0007", "end")]
    e = spark.createDataFrame(rows, "src string, dst string")
    p = spark.createDataFrame([(f"s{i:04}", t) for i in range(n) for t in ("end", "mid", "hub", "none", f"s{i:04}")], "source string, target string")
    got = within(spark, 40, lambda: {(r.source, r.target): (r.n, tuple(r.path)) for r in sampling.shortest(e, p).collect()})
    want = {}
    for i in range(n):
        s = f"s{i:04}"
        want |= {(s, s): (0, (s,)), (s, "hub"): (1, (s, "hub")), (s, "mid"): (3, (s, "hub", "m0000", "mid")), (s, "end"): (3, (s, "hub", "m0007", "end"))}
    assert got == want


def test_nodes_sort_no_triples(spark):
    """F6 to F12: the aggregate that meets the triples is a hash table of names."""
    t = spark.createDataFrame([("a", "r", "b", "u", 5, "T", None), ("b", "r", "a", "u", 3, "U", "V"), ("b", "r", "b", "u", 3, "U", "W"), ("", "r", "c", "u", 1, "X", "Y")], TRIPLE)
    n = graph.nodes(t)
    assert {(r.name, r.type, *r.names) for r in n.collect()} == {("a", "V", "a"), ("b", "U", "b")}
    plan = n._jdf.queryExecution().sparkPlan().toString().splitlines()
    lowest = [x for x in plan if "Aggregate(" in x][-1]
    assert "HashAggregate(" in lowest and "ObjectHash" not in lowest


def test_tasks_follow_the_files(spark, tmp_path):
    """the pairs of lineitem go to a task for each 8 MB of the table."""
    from weftgraph.plans import base
    from weftgraph.session import tasks_for

    spark.range(2_000_000).select(F.xxhash64("id").alias("l_suppkey"), F.xxhash64(-F.col("id")).alias("l_partkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = sum(p.stat().st_size for p in (tmp_path / "lineitem.parquet").glob("*.parquet"))
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    assert tasks_for(lines, mb=1) == -(-size // (1 << 20)) > tasks_for(lines) >= spark.sparkContext.defaultParallelism
    for t in ("supplier", "customer", "nation", "region", "part"):
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    plan = base.triples(spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
    assert "hashpartitioning(l_suppkey" in plan and "REPARTITION_BY_NUM" in plan


def test_tables_of_similarities():
    """a table of similarities is that of the pairs, from the smaller name's side."""
    import random

    from weftgraph.functions import text
    from weftgraph.operators import resolve

    draw = random.Random(1)
    for letters in ("ab", "abc#0é東"):
        for n, m in ((1, 1), (1, 2), (5, 5), (8, 4), (18, 17)):
            a, b = (["".join(draw.choice(letters) for _ in range(k)) for _ in range(20)] for k in (n, m))
            assert text.jaro_winkler_table(a, b, cells=64).tolist() == [[text.jaro_winkler(x, y) for y in b] for x in a]
    few, more = (sorted({"".join(draw.choice("abc") for _ in range(k)) for _ in range(50)}) for k in (5, 7))
    for x, y in ((few, few), (few, more)):
        got = sorted((a[p], b[q], s) for a, b, i, j, t in resolve.tabled(x, y, 0.85, step=16) for p, q, s in zip(i, j, t))
        want = {(min(p, q), max(p, q)) for p in x for q in y if p != q}
        assert got == sorted((p, q, text.jaro_winkler(p, q)) for p, q in want if text.jaro_winkler(p, q) >= 0.85)


def test_dense_types_make_each_pair_once(spark):
    """1,500 names that all match are a million pairs from tiles, no block pairs them; a type of unlike names keeps its blocks."""
    from weftgraph.operators import resolve

    names = [f"Item#{i:09}" for i in range(1500)]
    other = ["".join(chr(0x4E00 + 7 * i + k) for k in range(4)) for i in range(200)] + ["abcd one", "abcd ones"]
    n = spark.createDataFrame([(x, "T") for x in names] + [(x, "U") for x in other], "name string, type string")
    k = n.select("type", "name").distinct()
    assert [r.type for r in resolve.dense(k, resolve.blocks(k)).collect()] == ["T"]
    rows = within(spark, 60, lambda: resolve.matches(n).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("a", "b").alias("d"), F.bool_and(F.col("a") < F.col("b")).alias("ok")).collect())
    got = {r.type: (r.n, r.d, r.ok) for r in rows}
    assert got["U"] == (1, 1, True) and got["T"][0] == got["T"][1] > 1_000_000 and got["T"][2]
    assert resolve.matching(n).first().pairs == sum(x for x, *_ in got.values())


def test_log_is_compressed(spark, tmp_path):
    """F15, F16: the log's files are compressed and read back as they were."""
    from weftgraph.sources import tables

    t = spark.range(3000).select(F.concat(F.lit("Supplier#"), F.lpad((F.col("id") % 40).cast("string"), 9, "0")).alias("subject"), F.lit("supplies").alias("relation"), F.lit("hot bolt").alias("object"), F.concat(F.lit("lineitem://"), "id").alias("source_url"), F.col("id").alias("seq"), F.lit("Supplier").alias("subject_type"), F.lit("Part").alias("object_type"))
    entries = tables.log_entries(t, F.lit("2024"))
    tables.append_log(entries, f"{tmp_path}/log")
    files = [p for p in (tmp_path / "log").iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    plain = sum(len(x) + 1 for x in entries.toJSON().collect())
    assert 5 * sum(p.stat().st_size for p in files) < plain
    assert sorted(map(tuple, tables.read_log(spark, f"{tmp_path}/log").collect())) == sorted(map(tuple, entries.collect()))


def test_streamed_files_are_alike(spark, monkeypatch):
    """no log file, and so no task, gets the entries of the day that nearly all belong to."""
    from weftgraph.plans import run_queries
    from weftgraph.streaming import ingest

    seen = []
    run = ingest.ingest
    monkeypatch.setattr(ingest, "ingest", lambda spark, log, *a, **b: seen.append(log) or run(spark, log, *a, **b))
    run_queries.streaming_ingest(spark, "/root/testdata/sf0.001")
    n = [r["count"] for r in spark.read.text(seen[0]).groupBy(F.input_file_name()).count().collect()]
    assert max(n) < 0.5 * sum(n), n
