"""The command line over a small triple log, names resolved as they arrive, the earlier rules and the summary."""

from pyspark.sql import functions as F

from weftgraph import __main__ as command
from weftgraph.operators import resolve, validation
from weftgraph.plans.base import triples
from weftgraph.plans.resolve_queries import GROUPS
from weftgraph.sources import tables
from weftgraph.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_runs_from_log_to_export(spark, tmp_path):
    few = triples(spark, SF).where("relation in ('located_in', 'part_of', 'includes', 'made_by') and subject_type != 'Customer'")
    tables.append_log(tables.log_entries(few, F.lit("2024")).repartition(2), f"{tmp_path}/log")
    command.main(["--work", str(tmp_path), "--build-graph", "--generate-questions", "--save-to-neo4j", "--save-frequency", "1", "--num-questions", "8"], spark)
    assert len(ingest.versions(spark, f"{tmp_path}/graph")) == 2
    nodes, edges = ingest.latest(spark, f"{tmp_path}/graph")
    assert spark.read.parquet(f"{tmp_path}/export/edges").count() == edges.count() > 0
    got = spark.read.json(f"{tmp_path}/summary").first()
    assert got.original_samples == spark.read.json(f"{tmp_path}/questions").count() > 0
    command.main(["--work", str(tmp_path), "--generate-questions", "--use-old-strategy", "--num-questions", "5"], spark)
    assert 0 < spark.read.json(f"{tmp_path}/questions").count() <= 5
    command.main(["--work", str(tmp_path), "--build-graph", "--start-from", "1000000"], spark)
    assert ingest.latest(spark, f"{tmp_path}/graph")[0].count() == nodes.count()


def test_matches_of_new_names(spark):
    names = ["alpha one", "alpha onee", "alah one", "beta", "betta", "x"]
    n = spark.createDataFrame([("T", x) for x in names], "type string, name string")
    new = {"alpha onee", "x"}
    want = {(r.a, r.b) for r in resolve.matches(n).collect() if {r.a, r.b} & new}
    assert want and {(r.a, r.b) for r in resolve.matches_of(n, n.where(F.col("name").isin(*new))).collect()} == want
    assert resolve.matches_of(n, n.where("false")).count() == 0


def test_earlier_rules(spark):
    rows = spark.createDataFrame([(g, n) for g, names in GROUPS for n in names], "component string, name string")
    now = {r.component: set(r.reasons) for r in resolve.vetoed(rows).collect()}
    then = {r.component: set(r.reasons) for r in resolve.vetoed(rows, earlier=True).collect()}
    assert all(reasons <= now[c] and reasons <= set(resolve.EARLIER) for c, reasons in then.items())
    # told apart by single characters, numbers, or what the longer name adds, which the earlier rules do not know
    assert {"g8", "g10", "g11"} & set(then) == set()
    assert {"g2", "g9", "g12", "g13"} <= set(then)


def test_conversion_summary_of_nothing(spark):
    none = spark.createDataFrame([], "question string, answer string")
    got = validation.conversion_summary(none, none, none).first().asDict()
    assert got == {"original_samples": 0, "contextual_count": 0, "contextual_bytes": 0, "simple_count": 0, "simple_bytes": 0, "conversion_rate": None}
