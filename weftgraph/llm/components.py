"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.session import checkpointed


def _print(e: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that an edge touches; component is its smallest reachable node.

    Null ends are passed over, self-links and repeated links change nothing, and no links give an empty table.
    Each round is two aggregations and joins on a node; its edges are written to the shared checkpoint folder.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = checkpointed(e.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct())
    now = _print(e)
    for _ in range(max_rounds):
        if not now[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = checkpointed(small.distinct())
        was, now = now, _print(e)
        if was == now:
            break
    else:
        raise RuntimeError(f"components are not complete after {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(roots)
