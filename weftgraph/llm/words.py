"""Choice of the words that are worth broadcasting, places of rows, and what workers give back when a task is done."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.session import materialise

EXACT = 64


def frequent(counts: DataFrame, word: str, number: str, most: int) -> DataFrame:
    """About ``most`` rows of ``counts`` with the highest numbers, without a sort.

    Numbers fall into levels (each number up to 64, then sixteen levels for each doubling), a few hundred at most; whole
    levels are taken from the top, and of the next one the share by a hash of the word that still fits.
    """
    n = F.col(number)
    level = F.when(n < EXACT, n).otherwise(EXACT + F.floor(F.log2(n / EXACT) * 16)).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()), reverse=True)
    left, least, share = most, None, 0.0
    for at, size in sizes:
        if size > left:
            share = left / size
            least = at
            break
        left, least, share = left - size, at, 1.0
    if least is None:
        return counts.where(F.lit(False))
    return counts.where((level > least) | ((level == least) & (F.pmod(F.xxhash64(word), F.lit(1 << 20)) < int(share * (1 << 20)))))


def tidy(run: Callable[[Iterator], Iterator], *caches) -> Callable[[Iterator], Iterator]:
    """A function over batches whose worker empties ``caches`` and returns its free memory to the system when the task ends."""

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        for cache in caches:
            cache.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return tidied


def placed(docs: DataFrame, key: str, text: str, **more: Column) -> DataFrame:
    """(k, t, f, r, ...): key, text, a place that no other row has, the same however often the rows are read, and
    the columns asked for.

    The place is the file and the row within it, so ``docs`` must be files; whatever else it is, is written first.
    """
    own = {"k": F.col(f"`{key}`"), "t": F.col(f"`{text}`")} | more

    def columns(d: DataFrame, **named: Column) -> DataFrame:
        place = d.metadataColumn("_metadata")
        return d.select(*(c.alias(n) for n, c in named.items()), F.xxhash64(place["file_path"]).alias("f"), place["row_index"].alias("r"))

    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        try:
            return columns(docs, **own)
        except AnalysisException:  # files without row numbers
            pass
    return columns(materialise(docs.select(*(c.alias(n) for n, c in own.items())), "texts"), **{n: F.col(n) for n in own})


def free(docs: DataFrame, *made: str) -> DataFrame:
    """``docs`` whose columns of the names ``made`` have got "_" behind their name, as often as it takes."""
    names = list(docs.columns)
    for k, name in enumerate(docs.columns):
        while names[k] in made or names[k] != name and names.count(names[k]) > 1:
            names[k] += "_"
    return docs.toDF(*names)


def cuts_of(df: DataFrame, column: str, ranges: int) -> list[int]:
    """``ranges`` - 1 quantiles of a whole-number column, in order; those of a frequent value are equal."""
    at = [k / ranges for k in range(1, ranges)]
    return sorted(df.agg(F.percentile_approx(column, at, max(10_000, 10 * ranges))).first()[0] or []) if at else []


def range_of(cuts: list[int], value: Column) -> Column:
    """How many of the sorted ``cuts`` are not above ``value``: first among every m-th of them, then among m, m being
    the root of their number."""
    if not cuts:
        return F.lit(0)
    m = math.isqrt(len(cuts)) + 1
    count = lambda some: F.size(F.filter(some, lambda c: c <= value))
    block = F.greatest(count(F.lit(cuts[::m])) - 1, F.lit(0))
    return (block * m + count(F.slice(F.lit(cuts), block * m + 1, F.lit(m)))).cast("int")
