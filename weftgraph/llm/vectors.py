"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, are fitted on a bounded sample; a vector's cell is the pair of its
nearest centroids, and all rows are indexed. The grid grows with the rows, so a cell holds about as many whatever their
number. A query walks the grid by the multi-sequence algorithm: centroids of each half are ranked by distance, and from
the pair of first ranks on the cell of the least sum that borders on what was visited comes next. It stops after as many
cells as the target recall asks for: the number is measured on vectors that did not fit the codebooks, against partners
at exactly the threshold, the farthest that can link, in three kinds of directions (any, within one half, towards
another vector), for the pair as a whole: it is found if either side walks into the other's cell. The recall so measured
on the worst of the three comes back with the result. What a query meets is verified by cosine in double precision.

Equal vectors of one label form one class with a multiplicity, and only classes are compared. A cell is cut into
blocks, queries stream past a block's vectors, and what leaves a task is a number for each vector and a spanning
forest of the links, never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and null labels, link with
nothing; vectors of different lengths link with nothing; rows without an id get no component and are kept; rows of one
id count as one node; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.components import connected
from weftgraph.llm.words import tidy
from weftgraph.session import materialise


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        at = distances(x, c).argmin(1)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1), 0)


class MultiIndex:
    """Two codebooks, the number of cells to visit, and the recall that was measured for it."""

    def __init__(self, sample: np.ndarray, centroids: int, threshold: float, target_recall: float, rounds: int = 10, seed: int = 5):
        rng = np.random.default_rng(seed)
        unit = sample / np.linalg.norm(sample, axis=1)[:, None]
        self.half = max(1, unit.shape[1] // 2)
        shuffled = unit[rng.permutation(len(unit))]
        held = shuffled[: max(1, min(2000, len(unit) // 5))]
        fit = shuffled[len(held) :] if len(unit) > 1 else shuffled
        self.books = [kmeans(h, centroids, rounds, rng) for h in self.halves(fit)]
        self.visits, self.recall = 1, 1.0
        for partner in partners(held, unit, threshold, self.half, rng):
            at = np.minimum(self.place(held, self.cells(partner)), self.place(partner, self.cells(held)))
            self.visits = max(self.visits, int(np.quantile(at, target_recall, method="higher")) + 1)
        for partner in partners(held, unit, threshold, self.half, rng):  # of other directions than those that set the number
            met = np.minimum(self.place(held, self.cells(partner)), self.place(partner, self.cells(held))) < self.visits
            self.recall = min(self.recall, float(met.mean()))

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = unit[:, self.half :]
        return unit[:, : self.half], rest if rest.shape[1] else np.zeros((len(unit), 1))

    def parts(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(distances(h, c) for h, c in zip(self.halves(unit), self.books))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.parts(unit)
        return a.argmin(1) * len(self.books[1]) + b.argmin(1)

    def place(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells each query visits before the one named."""
        a, b = self.parts(unit)
        i, j = np.divmod(cell, len(self.books[1]))
        rows = np.arange(len(unit))
        total = (a[rows, i] + b[rows, j])[:, None]
        return sum((a[:, [k]] + b < total).sum(1) for k in range(a.shape[1]))

    def walk(self, unit: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The first cells of each query by the multi-sequence algorithm, own cell first; all queries walk side by side.

        Row r stands for the centroid of rank r in the first half; ``at`` is the next rank of the second half in it. A
        row is open if the row above it is ahead, so the open ends of the rows are the cells that border on the visited.
        """
        visits = min(visits or self.visits, len(self.books[0]) * len(self.books[1]))
        parts = self.parts(unit)
        rank = [np.argsort(x, axis=1, kind="stable") for x in parts]
        a, b = (np.take_along_axis(x, r, 1) for x, r in zip(parts, rank))
        queries, width = np.arange(len(unit)), b.shape[1]
        deep = min(a.shape[1], visits)
        at = np.zeros((len(unit), deep), dtype=np.int64)
        out = np.empty((len(unit), visits), dtype=np.int64)
        b = np.concatenate([b, np.full((len(unit), 1), np.inf)], axis=1)
        for k in range(visits):
            reach = min(deep, k + 1)
            total = a[:, :reach] + np.take_along_axis(b, at[:, :reach], 1)
            total[:, 1:][at[:, 1:reach] >= at[:, : reach - 1]] = np.inf
            row = total.argmin(1)
            out[:, k] = rank[0][queries, row] * width + rank[1][queries, at[queries, row]]
            at[queries, row] += 1
        return out


def partners(x: np.ndarray, others: np.ndarray, threshold: float, half: int, rng: np.random.Generator):
    """Unit vectors whose cosine to those of ``x`` is the threshold: turned any way, within a half, towards another one."""
    noise = rng.standard_normal(x.shape)
    in_half = noise.copy()
    in_half[:, half:] = 0 if half < x.shape[1] else in_half[:, half:]
    for r in (noise, in_half, others[rng.integers(0, len(others), len(x))]):
        r = r - (r * x).sum(1)[:, None] * x
        size = np.linalg.norm(r, axis=1)[:, None]
        r = np.where(size > 1e-9, r / np.maximum(size, 1e-9), 0)
        y = threshold * x + max(0.0, 1 - threshold**2) ** 0.5 * r
        yield y / np.linalg.norm(y, axis=1)[:, None]


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors of a column, as rows; shorter ones end with zeros."""
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = flat
    return out


def usable(vector: str, label: str):
    """Vectors that can link: a label, some component that is not zero, all of them finite."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, per_cell: int = 200, most_centroids: int = 512, sample_rows: int = 20_000, target_recall: float = 0.99, block: int = 1024) -> DataFrame:
    """(key, n_links, component_id, kept, index_recall), a row for each row of ``rows``.

    The codebooks have as many centroids as give about ``per_cell`` vectors a cell, between 4 and ``most_centroids``.
    """
    spark = rows.sparkSession
    table = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.col(f"`{label}`").alias("label"))
    good = table.where(usable("v", "label") & F.col("id").isNotNull())
    classes = materialise(good.groupBy("label", "v").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("mult")), "vector-classes")
    classes = classes.withColumn("dim", F.size("v"))
    dim, n = classes.agg(F.max("dim"), F.count("*")).first()
    ends = table.select("id", "v", "label", usable("v", "label").alias("ok"))
    if dim is None:
        return ends.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.lit(1.0).alias("index_recall"))
    few = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("v").toArrow()["v"].combine_chunks()
    index = MultiIndex(matrix(few, dim), int(min(most_centroids, max(4, round((n / per_cell) ** 0.5)))), threshold, target_recall)
    recall, index = index.recall, spark.sparkContext.broadcast(index)

    def place(batches):
        ix = index.value
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                x = matrix(part.column("v"), dim)
                unit = x / np.linalg.norm(x, axis=1)[:, None]
                seen = ix.walk(unit).astype(np.int32)
                visits = pa.ListArray.from_arrays(np.arange(0, seen.size + 1, seen.shape[1], dtype=np.int32), seen.ravel())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ix.cells(unit), pa.int32()), visits], [*part.schema.names, "cell", "visits"])

    placed = classes.mapInArrow(tidy(place), T.StructType([*classes.schema, T.StructField("cell", T.IntegerType()), T.StructField("visits", T.ArrayType(T.IntegerType()))]))
    placed = materialise(placed.select(F.struct("label", "dim").alias("group"), "rep", "mult", "v", "cell", "visits"), "vector-cells")
    sizes = placed.groupBy("group", "cell").agg(F.count("*").alias("members"))
    probes = placed.select("group", "rep", "mult", "v", F.col("cell").alias("own"), F.explode("visits").alias("cell"))
    asked = probes.groupBy("group", "cell").agg(F.count("*").alias("asking"))
    sizes = materialise(sizes.join(asked, ["group", "cell"]), "vector-sizes")
    n_m, n_q = F.ceil(F.col("members") / block).cast("int"), F.ceil(F.col("asking") / (8 * block)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    h = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    m = placed.join(sizes, ["group", "cell"]).withColumn("x", h(n_m)).withColumn("y", every(n_q))
    m = m.select("group", "cell", "x", "y", F.lit(0).alias("role"), "rep", "mult", "v", F.col("cell").alias("own"), "visits")
    q = probes.join(sizes, ["group", "cell"]).withColumn("y", h(n_q)).withColumn("x", every(n_m))
    q = q.select("group", "cell", "x", "y", F.lit(1).alias("role"), "rep", "mult", "v", "own", F.lit(None).cast("array<int>").alias("visits"))
    rows_ = m.unionByName(q).withColumn("g", F.xxhash64("group")).select("g", "cell", "x", "y", "role", "rep", "mult", "v", "own", "visits")

    def compare(batches):
        now, parts, state = None, [], None

        def built(rows):
            """A block's members; each as its own component."""
            rep, mult, v, visits, own = rows
            return {"rep": rep, "mult": mult, "v": v, "n": np.zeros(len(rep), np.int64), "seen": visits, "comp": np.arange(len(rep))}

        def close():
            """Numbers of the block's members that were found by others only."""
            if state is not None:
                for k in np.flatnonzero(state["n"]):
                    yield 0, int(state["rep"][k]), 0, int(state["n"][k])

        def ask(reps, mults, v, owns):
            hit = v @ state["v"].T >= threshold
            for i in np.flatnonzero(hit.any(1)):
                rep, mult, own = int(reps[i]), int(mults[i]), owns[i]
                at = np.flatnonzero(hit[i])
                at = at[state["rep"][at] != rep]
                if not len(at):
                    continue
                yield 0, rep, 0, int(state["mult"][at].sum())
                lone = at[~(state["seen"][at] == own).any(1)]  # they do not walk into the query's cell themselves
                state["n"][lone] += mult
                comps = np.unique(state["comp"][at])
                yield 1, rep, int(state["rep"][at[0]]), 0
                for c in comps[1:]:
                    yield 1, int(state["rep"][comps[0]]), int(state["rep"][c]), 0
                if len(comps) > 1:
                    state["comp"][np.isin(state["comp"], comps)] = comps[0]

        def batch(found):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["kind", "a", "b", "n"])

        def unit(column):
            x = matrix(column, dim)
            return x / np.linalg.norm(x, axis=1)[:, None]

        for b in batches:
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                g, cell, x, y, role, rep, mult, own = (part.column(c).to_numpy() for c in ("g", "cell", "x", "y", "role", "rep", "mult", "own"))
                v, found = unit(part.column("v")), []
                cut = np.flatnonzero((g[1:] != g[:-1]) | (cell[1:] != cell[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (role[1:] != role[:-1])) + 1
                for lo, hi in zip([0, *cut], [*cut, len(g)]):
                    key = (int(g[lo]), int(cell[lo]), int(x[lo]), int(y[lo]))
                    if key != now:
                        found += close()
                        now, parts, state = key, [], None
                    if role[lo] == 0:
                        seen = part.column("visits").slice(lo, hi - lo)
                        parts.append((rep[lo:hi], mult[lo:hi], v[lo:hi], seen.flatten().to_numpy().reshape(hi - lo, -1), own[lo:hi]))
                    elif parts:
                        if state is None:
                            state = built([np.concatenate(c) for c in zip(*parts)])
                        found += ask(rep[lo:hi], mult[lo:hi], v[lo:hi], own[lo:hi])
                if found:
                    yield batch(found)
        if found := list(close()):
            yield batch(found)

    met = rows_.repartition("g", "cell", "x", "y").sortWithinPartitions("g", "cell", "x", "y", "role", "rep").mapInArrow(tidy(compare), "kind int, a long, b long, n long")
    met = materialise(met, "vector-links")
    numbers = met.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    same_id = good.join(classes.select("label", "v", "rep"), ["label", "v"]).where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    several = good.groupBy("id").agg(F.countDistinct("label", "v").alias("c")).where("c > 1").select(F.col("id").alias("a"))
    same_id = same_id.join(several, "a", "left_semi")
    comp = connected(met.where("kind = 1").select("a", "b").unionByName(same_id))
    info = classes.select("label", "v", "rep", "mult").join(numbers, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
    info = info.select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = ends.where("ok").join(info, ["label", "v"], "left").select("id", "n_links", "component").unionByName(ends.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
    c = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), F.coalesce(c == F.col("id"), F.lit(True)).alias("kept"), F.lit(recall).alias("index_recall"))
