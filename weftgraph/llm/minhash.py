"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct shingles of five words (lower-cased A-Z; the whole sequence where there are fewer
words). Two permutations of a ring of 2^32 places make all coordinates of the signature: the first scatters the
shingles, the second is applied after a circular shift by k to give coordinate k. Coordinates are banded.

1. Documents of equal sets form one class; its smallest id represents it.
2. A band bucket is headed by its smallest member. Every representative is paired with the smallest head that it shares
   a bucket with, and the pairs are verified on full sets: one pair each, however large a bucket is.
3. Buckets that still hold several components are compared in blocks: each member lies in one block, and the members
   outside the bucket's largest component meet every block. A block first tells by sizes and by one byte of every
   coordinate which members it needs, then gets their texts, and verifies on full sets, most similar pairs first, passing
   over whatever its own union-find has joined by then. Only links that join two components leave it, never pairs. A
   pair belongs to the first bucket that it shares. No bucket is capped.
Components come from the verified links; component ids are the smallest reachable ids.

The byte sketch rules a pair out if it is 5.5 standard deviations below the bound (chance below 1e-6 for a pair at the
bound); a missed band has a chance below 1e-6 at 0.85 and 1e-4 at 0.80. Verification compares sets of 64-bit hashes of
shingles: two different shingles of one pair of documents are taken for equal with a chance below 1e-12.

Defined results: null text and text without words have the empty set and link with nothing; rows without an id get no
component and are kept; repeated rows keep their rows; rows of one id with several texts count as one node; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.components import connected
from weftgraph.llm.words import placed, tidy
from weftgraph.session import materialise

#: Multipliers of 32- and 64-bit bijective mixers.
MIX32 = ((16, 0x85EBCA6B, 13, 0xC2B2AE35, 16), (16, 0x7FEB352D, 15, 0x846CA68B, 16))
MIX64 = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


class Shingler:
    """Sets of 64-bit shingle hashes; the hashes of words stay in a bounded memo."""

    def __init__(self, width: int = 5, memo_size: int = 200_000):
        self.width, self.memo_size = width, memo_size
        self.memo: dict[bytes, int] = {}

    def set_of(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # of bytes: A-Z and ASCII white space only
        memo = self.memo
        if len(memo) > self.memo_size:
            memo.clear()
        try:
            h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in memo:
                    memo[w] = xxhash.xxh64_intdigest(w)
            h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        k = min(self.width, len(h))
        out = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            out = mix64(out * np.uint64(MIX64[2]) + h[j : len(h) - k + 1 + j])
        return np.unique(out)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX64[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX64[1])
    return x ^ (x >> np.uint64(31))


def permute(x: np.ndarray, which: int) -> np.ndarray:
    """One of two permutations of the ring of 2^32 places, in place."""
    s, a, t, b, u = MIX32[which]
    x ^= x >> np.uint32(s)
    x *= np.uint32(a)
    x ^= x >> np.uint32(t)
    x *= np.uint32(b)
    x ^= x >> np.uint32(u)
    return x


def signature(hashes: np.ndarray, size: int, block: int = 512) -> np.ndarray:
    """Coordinate k: the smallest place after the first permutation, a circular shift by k, and the second one."""
    first = permute((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32), 0)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    out = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(first), block):
        np.minimum(out, permute(first[None, k : k + block] + shifts, 1).min(1), out=out)
    return out


def bands_of(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(MIX64[2])
    for j in range(rows.shape[1]):
        h = mix64(h ^ (rows[:, j] + np.uint64(j << 32)))
    return h


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def describe(base: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(id, f, r, n, digest of the set, band hashes, one byte of each coordinate), a row for each row of ``base``."""

    def run(batches):
        s = Shingler(width)
        for b in batches:
            for k in range(0, b.num_rows, 128):
                part = b.slice(k, 128)
                n, digest, band, sketch = [], [], [], []
                for t in part.column(3).to_pylist():
                    x = s.set_of(t)
                    n.append(len(x))
                    if not len(x):
                        digest.append(None), band.append(None), sketch.append(None)
                        continue
                    sig = signature(x, bands * rows)
                    digest.append(hashlib.md5(x.tobytes()).digest())
                    band.append(bands_of(sig, bands).view(np.int64))
                    sketch.append((sig & np.uint32(255)).astype(np.uint8).tobytes())
                made = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(sketch, pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], ["id", "f", "r", "n", "digest", "bands", "sketch"])

    return base.select("id", "f", "r", "t").mapInArrow(tidy(run), "id long, f long, r long, n long, digest binary, bands array<long>, sketch binary")


def verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int, block: int = 512) -> DataFrame:
    """Pairs (a, b) whose full sets are similar. Each ``a`` heads blocks of its partners, which stream past its set."""
    size = pairs.groupBy("a").agg(F.count("*").alias("c"))
    member = pairs.join(size, "a").select("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / block)).cast("int").alias("blk"), F.lit(1).alias("role"), F.col("b").alias("id"))
    head = member.select("a", "blk", F.lit(0).alias("role"), F.col("a").alias("id")).distinct()
    rows = texts.join(member.unionByName(head), "id").select("a", "blk", "role", "id", "text")

    def run(batches):
        s, now, own = Shingler(width), None, []
        for b in batches:
            a, got = [], []
            for head, blk, role, i, t in zip(*(c.to_pylist() for c in b.columns)):
                if role == 0:
                    own = [*own, s.set_of(t)] if (head, blk) == now else [s.set_of(t)]
                    now = (head, blk)
                elif (head, blk) == now:
                    mine = s.set_of(t)
                    if any(similar(x, mine, percent) for x in own):
                        a.append(head), got.append(i)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(got, pa.int64())], ["a", "b"])

    return rows.repartition("a", "blk").sortWithinPartitions("a", "blk", "role", "id").mapInArrow(tidy(run), "a long, b long")


def met_blocks(members: DataFrame, block: int) -> DataFrame:
    """(bucket, x, role, id, ...): every member in one block of its bucket (role 0), and every member that is not of the
    bucket's largest component once in each block (role 1)."""
    blocks = F.ceil(F.col("c") / block).cast("int")
    own = members.withColumn("x", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("role", F.lit(0))
    ask = members.where("comp != main").withColumn("x", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("role", F.lit(1))
    return own.unionByName(ask)


class Block:
    """The members of one block of a bucket, and which of them a member that asks may link with."""

    def __init__(self, rows: list[tuple], percent: int, least: float):
        self.percent, self.least = percent, least
        self.ids, self.comp, self.n = (np.asarray([r[k] for r in rows]) for k in range(3))
        self.sketch = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
        self.bands = np.asarray([r[4] for r in rows], dtype=np.int64)
        self.main = np.asarray([r[5] for r in rows])
        self.parent = {int(c): int(c) for c in self.comp}

    def root(self, c: int) -> int:
        while (up := self.parent.setdefault(c, c)) != c:
            self.parent[c] = c = self.parent.setdefault(up, up)
        return c

    def candidates(self, bucket: int, row: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Places of members of other components that sizes and sketches do not rule out, and their likeness.

        Of two members that both ask, the one of the smaller id does; a pair is taken in the first band that it shares.
        """
        i, comp, n, sketch, bands, main = row[:6]
        ok = (self.comp != comp) & (100 * np.minimum(self.n, n) >= self.percent * np.maximum(self.n, n)) & ((self.comp == main) | (self.ids > i))
        at = np.flatnonzero(ok)
        if len(at):
            like = (self.sketch[at] == np.frombuffer(sketch, np.uint8)).mean(1)
            at, like = at[like >= self.least], like[like >= self.least]
        if not len(at):
            return at, np.zeros(0)
        mine = np.asarray(bands, dtype=np.int64)
        first = (self.bands[at] == mine).argmax(1)
        here = mine[first] == bucket
        return at[here], like[here]


def by_block(batches):
    """((bucket, x), rows of role 0, iterator of rows of role 1) of sorted batches; the rows of role 1 are read as they come."""
    stream = ((row[:2], row[2], row[3:]) for b in batches for k in range(0, b.num_rows, 1024) for row in zip(*(c.to_pylist() for c in b.slice(k, 1024).columns)))
    for key, rows in groupby(stream, key=lambda r: r[0]):
        own, ask = [], None
        for _, role, row in rows:
            if role:
                ask = row
                break
            own.append(row)
        yield key, own, (() if ask is None else chain([ask], (r for _, _, r in rows)))


FACTS = ("id", "comp", "n", "sketch", "bands", "main", "f", "r")


def needed(rows: DataFrame, percent: int, least: float) -> DataFrame:
    """Those of the rows of ``met_blocks`` whose texts a block has to compare: at most one row for each of them."""

    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())

    def run(batches):
        for (bucket, x), own, ask in by_block(batches):
            if not own:
                continue
            block, used, got = Block(own, percent, least), np.zeros(len(own), bool), []
            for row in ask:
                at, _ = block.candidates(bucket, row)
                if len(at):
                    used[at] = True
                    got.append((1, *row))
                if len(got) >= 4096:
                    yield batch(bucket, x, got)
                    got = []
            got += [(0, *own[k]) for k in np.flatnonzero(used)]
            if got:
                yield batch(bucket, x, got)

    def batch(bucket, x, got):
        return pa.RecordBatch.from_arrays([pa.array([bucket] * len(got), pa.int64()), pa.array([x] * len(got), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*got), kinds))], ["bucket", "x", "role", *FACTS])

    rows = rows.select("bucket", "x", "role", *FACTS)
    return rows.repartition("bucket", "x").sortWithinPartitions("bucket", "x", "role", "id").mapInArrow(tidy(run), rows.schema)


def linked(rows: DataFrame, texts: DataFrame, width: int, percent: int, least: float) -> DataFrame:
    """(a, b): links between members, a spanning forest of the components that each block joins."""

    def run(batches):
        s = Shingler(width)
        for (bucket, _), own, ask in by_block(batches):
            if not own:
                continue
            block, sets = Block(own, percent, least), [s.set_of(r[8]) for r in own]
            found: list[tuple[int, int]] = []
            for row in ask:
                at, like = block.candidates(bucket, row)
                if not len(at):
                    continue
                mine, at = None, at[np.argsort(-like, kind="stable")]
                for j in at.tolist():
                    there = int(block.comp[j])
                    if block.root(row[1]) == block.root(there):
                        continue
                    mine = s.set_of(row[8]) if mine is None else mine
                    if similar(mine, sets[j], percent):
                        found.append((row[0], int(block.ids[j])))
                        block.parent[block.root(row[1])] = block.root(there)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    rows = rows.join(texts.drop("id"), ["f", "r"]).select("bucket", "x", "role", *FACTS, "text")
    return rows.repartition("bucket", "x").sortWithinPartitions("bucket", "x", "role", "id").mapInArrow(tidy(run), "a long, b long")


def picked(rows: DataFrame, keys: DataFrame, keep: bool = True, most: int = 1_000_000) -> DataFrame:
    """The rows whose keys are among the distinct rows of ``keys``, or are not. Up to ``most`` keys, counted first, are
    broadcast (some 50 bytes each); more are joined through a shuffle."""
    few = materialise(keys, "keys")
    few = F.broadcast(few) if few.count() <= most else few
    return rows.join(few, few.columns, "left_semi" if keep else "left_anti")


def contracted(links: DataFrame, comp_of: DataFrame) -> DataFrame:
    """Links between components."""
    a, b = (comp_of.select(F.col("rep").alias(x), F.col("comp").alias(f"c{x}")) for x in "ab")
    return links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a != b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5, bands: int = 24, rows: int = 5, block: int = 4096) -> DataFrame:
    """(key, n_shingles, component_id, kept), a row for each row of ``docs``."""
    base = placed(docs, key, text).select(F.col("k").cast("long").alias("id"), "t", "f", "r")
    known = materialise(describe(base, width, bands, rows), "minhash")
    some = known.where("id is not null and digest is not null")
    classes = some.groupBy("digest").agg(F.min(F.struct("id", "f", "r", "n", "bands", "sketch")).alias("m"))
    classes = materialise(classes.select("digest", F.col("m.id").alias("rep"), "m.f", "m.r", "m.n", "m.bands", "m.sketch"), "classes")
    several = some.groupBy("id").agg(F.min("digest").alias("p"), F.max("digest").alias("q")).where("p != q").select("id")
    same_id = some.join(several, "id").join(classes.select("digest", "rep"), "digest").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    buckets = classes.select(F.explode("bands").alias("bucket"), "rep", "f", "r")
    heads = buckets.groupBy("bucket").agg(F.min("rep").alias("head"), F.count("*").alias("c")).where("c > 1").select("bucket", "head")
    shared = materialise(buckets.join(heads, "bucket"), "buckets")  # only what has company
    texts = materialise(picked(base.select("id", F.col("t").alias("text"), "f", "r"), shared.select("f", "r").distinct()), "candidate-texts")  # one of a class

    # each representative meets the smallest head that it shares a bucket with
    tested = shared.where("rep != head").groupBy("rep").agg(F.min("head").alias("head")).select(F.col("head").alias("a"), F.col("rep").alias("b"))
    comp_of = classes.select("rep", F.col("rep").alias("comp"))
    comp_of = joined_up(comp_of, connected(verify(materialise(tested, "star"), texts, width, percent).unionByName(same_id)))

    # then the members of buckets with several components meet in blocks
    share = percent / 100
    least = share - 5.5 * (share * (1 - share) / (bands * rows)) ** 0.5
    labelled = shared.select("bucket", "rep", "f", "r").join(comp_of, "rep")
    parts = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("c")).groupBy("bucket")
    mixed = parts.agg(F.sum("c").alias("c"), F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("parts")).where("parts > 1").select("bucket", "c", F.col("m.comp").alias("main"))
    members = labelled.join(mixed, "bucket").join(classes.select("f", "r", "n", "sketch", "bands"), ["f", "r"]).withColumnRenamed("rep", "id")
    asked = materialise(needed(met_blocks(members, block), percent, least), "needed")
    links = connected(contracted(linked(asked, texts, width, percent, least), comp_of))
    comp_of = joined_up(comp_of, links)
    by_digest = classes.select("digest", "rep").join(comp_of.distinct(), "rep").select("digest", F.col("comp").alias("component_id"))
    out = known.select("id", F.col("n").alias("n_shingles"), "digest").join(by_digest, "digest", "left")
    found = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), "n_shingles", found.alias("component_id"), F.coalesce(found == F.col("id"), F.lit(True)).alias("kept"))


def joined_up(comp_of: DataFrame, found: DataFrame) -> DataFrame:
    """(rep, comp) after components have been joined to the smallest of them."""
    out = comp_of.join(found, F.col("comp") == F.col("node"), "left").select("rep", F.coalesce("component", "comp").alias("comp"))
    return materialise(out.distinct(), "components")
