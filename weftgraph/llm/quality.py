"""Quality by Bradley-Terry pairwise ranking.

Each text gets a feature vector x. A text of label 1 is preferred to one of label 0 with probability
sigmoid(w.(x1 - x0)); w maximises the penalised likelihood of such pairs (Newton steps). The ranking score w.x is
then cut at a quantile of the training scores: by default the share of label 0 among the training rows.
The reported score is sigmoid(w.x - cut + logit(keep_at)), so the cut lies at ``keep_at``.

The fit uses at most ``max_train`` labelled rows (a bounded sample in hash order; of several texts of one id the
smallest) and ``pairs`` pairs of them, 60,000, drawn by a fixed seed; the scores cover every row.
Labels, language, source and id are never inputs of a score.

Defined results: null text counts as the empty text; texts of any length are read whole; without rows of both labels
every score is the same neutral value above the cut; rows, ties, repeated rows and extra columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

PUNCT = [b for b in range(33, 127) if not chr(b).isalnum()]
N_FEATURES = len(PUNCT) + 18


def features(text: str | None) -> np.ndarray:
    """Character shares, repetition and shape of a whole text."""
    data = (text or "").encode()
    n = max(len(data), 1)
    c = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    k, m = max(len(words), 1), max(len(lines), 1)
    distinct = len(set(words))
    ends = sum(c[list(b".!?")])
    caps = c[65:91].sum()
    head = [
        caps / n, c[97:123].sum() / n, c[48:58].sum() / n, c[128:].sum() / n, (c[9] + c[11:14].sum() + c[32]) / n, c[10] / n,
        np.log1p(len(data)) / 10, np.log1p(len(words)) / 10, np.log1p(len(lines)) / 10, len(data) / k / 20, distinct / k,
        np.log1p(k / max(distinct, 1)), len(set(lines)) / m, np.log1p(m / max(len(set(lines)), 1)), ends / k, c[list(b"\"#$%&*+<=>@\\^_`{|}~")].sum() / k,
        caps / k, float(not words),
    ]
    return np.concatenate([np.asarray(head, dtype=np.float64), np.sqrt(c[PUNCT] / k)])


@dataclass(frozen=True)
class Ranking:
    """Weights over features, and the training score at the cut."""

    weights: np.ndarray
    cut: float
    keep_at: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.raw(x) - self.cut + np.log(self.keep_at / (1 - self.keep_at)), -40, 40)
        return 1 / (1 + np.exp(-z))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = 60_000, ridge: float = 1e-3, steps: int = 25, quantile: float | None = None, keep_at: float = 0.3, seed: int = 7) -> Ranking:
    """Bradley-Terry weights from pairs of one row of each label, and the cut at a quantile of the scores."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(N_FEATURES), -1.0, keep_at)
    scale = np.maximum(x.std(0), 1e-6)
    z = x / scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # of the pair being the other way round
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w)), d.T @ p / pairs - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(z @ w)
    share = len(bad) / (len(bad) + len(good)) if quantile is None else quantile
    at = int(round(share * len(raw)))
    cut = (raw[max(at - 1, 0)] + raw[min(at, len(raw) - 1)]) / 2
    return Ranking(w / scale, float(cut), keep_at)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_train: int = 20_000, **options) -> Ranking:
    """Fit on at most ``max_train`` rows of ``labels`` (0 or 1; others are passed over), taken in the order of a hash."""
    few = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
    few = few.orderBy(F.xxhash64("_k"), "_k", "_y").limit(max_train)

    @F.pandas_udf(ArrayType(FloatType()))
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype(np.float32) for t in texts])

    # at most max_train keys: a proven bound for the broadcast, and for the rows that return, one text for each of them
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(few), "_k")
    rows = rows.groupBy("_k", "_y").agg(F.min("_t").alias("_t")).select("_k", "_y", vector("_t").alias("x")).toPandas()
    if rows.empty:
        return Ranking(np.zeros(N_FEATURES), -1.0, options.get("keep_at", 0.3))
    rows = rows.sort_values(["_k", "_y"], kind="stable")
    return fit_pairs(np.stack(rows["x"]).astype(np.float64), rows["_y"].to_numpy(), **options)


def score(ranking: Ranking, text: Column) -> Column:
    """The score of each whole text, 0 to 1."""

    @F.pandas_udf(DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(ranking.score(np.stack([features(t) for t in texts])) if len(texts) else [], dtype="float64")

    return run(text)


def held_out(key: Column, folds: int) -> Column:
    """Rows whose crc32 of the key as text falls into the first of so many folds; a null key is taken as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0
