"""Text functions: similarity of names, leaks, rule tables, seeded choice."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weftgraph.functions import vocab


def jaro(a: str, b: str) -> float:
    """Jaro similarity over code points."""
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    taken, common = [False] * m, []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                common.append(c)
                break
    k = len(common)
    if not k:
        return 0.0
    swaps = sum(x != y for x, y in zip(common, (b[j] for j in range(m) if taken[j]))) // 2
    return (k / n + k / m + (k - swaps) / k) / 3


def jaro_winkler(a: str | None, b: str | None) -> float | None:
    """Jaro similarity raised by a common prefix of up to four characters; null if either name is."""
    if a is None or b is None:
        return None
    s = jaro(a, b)
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return s + prefix * 0.1 * (1 - s) if s > 0.7 else s


def _codes(names: Sequence[str], width: int, pad: int) -> np.ndarray:
    """Code points of names, one row each, filled up to ``width``."""
    out = np.full((len(names), width), pad, np.int32)
    n = np.fromiter(map(len, names), np.int64, len(names))
    out[np.arange(width) < n[:, None]] = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _matrix(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """``jaro_winkler`` of pairs of names, none empty, all pairs at once."""
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    x, y = _codes(a, n.max(), -1), _codes(b, m.max(), -2)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)[:, None]
    rows, place = np.arange(len(a)), np.arange(y.shape[1])
    free, hits = np.ones(y.shape, bool), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        can = (y == x[:, i : i + 1]) & free & (np.abs(place - i) <= reach)
        j = can.argmax(1)
        hit = can[rows, j]
        free[rows[hit], j[hit]] = False
        hits[:, i] = hit
    k = hits.sum(1)
    w = min(x.shape[1], y.shape[1])
    # what was matched, in the order of either name
    u = np.take_along_axis(x, np.argsort(~hits, axis=1, kind="stable"), 1)[:, :w]
    v = np.take_along_axis(y, np.argsort(free, axis=1, kind="stable"), 1)[:, :w]
    swaps = ((u != v) & (np.arange(w) < k[:, None])).sum(1) // 2
    some = np.maximum(k, 1)
    s = np.where(k > 0, (k / n + k / m + (k - swaps) / some) / 3, 0.0)
    prefix = np.cumprod(x[:, : min(4, w)] == y[:, : min(4, w)], axis=1).sum(1)
    s = np.where(s > 0.7, s + prefix * 0.1 * (1 - s), s)
    return np.where((k == n) & (k == m) & (swaps == 0), 1.0, s)


def jaro_winklers(a: Sequence[str | None], b: Sequence[str | None], cells: int = 1 << 22) -> np.ndarray:
    """``jaro_winkler`` of each pair; not a number where a name is null.

    Pairs are taken in the order of their lengths, ``cells`` of a matrix at once, so one long name costs no others.
    """
    out = np.full(len(a), np.nan)
    size = np.fromiter((-1 if x is None or y is None else max(len(x), len(y)) if x and y else 0 for x, y in zip(a, b)), np.int64, len(a))
    for i in np.flatnonzero(size == 0):
        out[i] = float(a[i] == b[i])
    order = np.argsort(size, kind="stable")
    order, at = order[size[order] > 0], 0
    while at < len(order):
        rest = size[order[at : at + cells]]
        # the longest pair of a batch sets the width of all
        end = at + max(1, int(np.searchsorted(rest * np.arange(1, len(rest) + 1), cells, "right")))
        part = order[at:end]
        out[part] = _matrix([a[i] for i in part], [b[i] for i in part])
        at = end
    return out


def jaro_winkler_table(a: Sequence[str], b: Sequence[str], cells: int = 1 << 15) -> np.ndarray:
    """``jaro_winkler`` of every name of ``a``, all of one length, with every one of ``b``, likewise; none is empty.

    A place of one name meets a place of the other for ``cells`` pairs at once, in bytes where the alphabet allows.
    """
    n, m = len(a[0]), len(b[0])
    both = np.frombuffer("".join([*a, *b]).encode("utf-32-le", "surrogatepass"), np.uint32)
    known, code = np.unique(both, return_inverse=True)
    code = code.astype(np.uint8 if len(known) < 256 else np.uint32)
    x, y = code[: n * len(a)].reshape(-1, n).T.copy(), code[n * len(a) :].reshape(-1, m).T.copy()
    reach = max(max(n, m) // 2 - 1, 0)
    near = [(i, j) for i in range(n) for j in range(max(0, i - reach), min(m, i + reach + 1))]
    rank = np.uint8 if max(n, m) < 255 else np.uint32
    out, step = np.empty((len(a), len(b))), max(1, cells // len(b))
    for at in range(0, len(a), step):
        p = x[:, at : at + step, None]
        shape = (p.shape[1], len(b))
        free, open_ = np.ones((m, *shape), bool), np.ones((n, *shape), bool)
        for i, j in near:
            got = y[j] == p[i]
            got &= free[j]
            got &= open_[i]
            free[j] ^= got
            open_[i] ^= got
        # what was matched, in the order of either name: the same numbers meet
        u, v = np.cumsum(~open_, axis=0, dtype=rank), np.cumsum(~free, axis=0, dtype=rank)
        k = u[-1].astype(np.float64)
        u[open_] = 0
        v[free] = np.iinfo(rank).max
        swaps = np.zeros(shape, rank)
        for i, j in near:
            other = y[j] != p[i]
            other &= u[i] == v[j]
            swaps += other
        swaps //= 2
        with np.errstate(invalid="ignore", divide="ignore"):
            s = np.where(k > 0, (k / n + k / m + (k - swaps) / k) / 3, 0.0)
        prefix, same = np.zeros(shape), np.ones(shape, bool)
        for i in range(min(4, n, m)):
            same &= y[i] == p[i]
            prefix += same
        s = np.where(s > 0.7, s + prefix * 0.1 * (1 - s), s)
        out[at : at + step] = np.where((k == n) & (k == m) & (swaps == 0), 1.0, s)
    return out


@F.pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(jaro_winklers(a.tolist(), b.tolist()), dtype="float64")


def first_rule(name: Column, rules, otherwise: str) -> Column:
    """The value of the first rule whose pattern the text matches."""
    out = F.lit(otherwise)
    for pattern, value in reversed(rules):
        out = F.when(name.rlike(pattern), value).otherwise(out)
    return out


def generic_description(name: Column) -> Column:
    return first_rule(name, vocab.GENERIC, vocab.GENERIC_ELSE)


def general_description(name: Column) -> Column:
    return first_rule(name, vocab.GENERAL, vocab.GENERAL_ELSE)


def leaks(text: Column, name: Column) -> Column:
    """Whether a text holds a name, or any three characters of it in a row, in either case."""
    t, n = F.lower(text), F.lower(name)
    some = F.exists(F.sequence(F.lit(1), F.greatest(F.char_length(name) - 2, F.lit(1))), lambda i: F.contains(t, F.substr(n, i, F.lit(3))))
    held = F.contains(t, n) | ((F.char_length(name) > 2) & some)
    return F.when((F.coalesce(text, F.lit("")) == "") | (F.coalesce(name, F.lit("")) == ""), False).otherwise(held)


def draw(seed: str, *keys) -> Column:
    """A number of 0 to 2^32 - 1 from a seed and keys, the same everywhere: the place of a random choice."""
    keys = [k if isinstance(k, Column) else F.col(k) for k in keys]
    return F.conv(F.substr(F.md5(F.concat_ws("|", F.lit(seed), *(k.cast("string") for k in keys))), F.lit(1), F.lit(8)), 16, 10).cast("bigint")


def order_of(seed: str, *keys) -> Column:
    """A text to order by, which shuffles rows the same way everywhere."""
    keys = [k if isinstance(k, Column) else F.col(k) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(seed), *(k.cast("string") for k in keys)))
