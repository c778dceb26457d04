"""Subword lattice likelihood.

A word is weighed over all its segmentations. An edge of its lattice is a piece of an existing vocabulary, of any length,
or one character by its bytes where no piece is that character. A forward recursion in log space sums over all paths: a
first piece (or the bare word mark), then pieces with the chance of going on, then the word's end. The probability of a
text is the product over its words of (1 - e) * P(word), and e for the end of the text, so those of all texts sum to one
at most.

The weights are the vocabulary's own. Pieces fall into classes, by whether they begin a word and by their length, and
within a class a piece weighs exp(slope * score) if the file's scores are log probabilities, or (shift + rank) ** -slope
if they are the ranks of merges. Training texts set no weight of a single piece: they set the share, slope and shift of
each class, the share of bytes, the chance of going on, and e, all from expected counts over the lattices of every
distinct training word, each as often as it occurs (one step of expectation-maximisation from equal shares and slope 1).
That model alone is ``vocabulary_score``; ``adapted_score`` takes the expected counts of the pieces themselves as
weights, the vocabulary's as prior.

``score`` is that of the lattice to which training adds every one of its words as one more edge, from the word's begin
to its end: the edge weighs the word's discounted number, and what the discounts leave is dealt over the paths of the
adapted lattice, so unseen words are spelt by pieces. Training texts fall into groups by ``group`` (eight at most, and
the rest), each with edges of its own over those of all texts; a text's probability is the sum over the groups, each
weighing its share of the training texts, so the group of a scored text is never read. ``counted_score`` is its older name.

Words are counted over all documents. The most frequent ones (``hot_words``, a parameter) are broadcast with their
scores; every other word of a text meets its score through a shuffle on the word. The route never changes a result.

Defined results: null text counts as the empty text (one end token); a null id is not held out; repeated rows keep
their rows, whatever their ids; without training rows the classes keep equal shares and e is one half; an empty table
gives an empty table; null groups are one group; of the columns, the key and those made here are returned.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.words import frequent, placed, tidy
from weftgraph.session import materialise

SPACE = "▁"
END = b""
BASE = 0x9E3779B97F4A7C15
NEVER = -1e30
#: Pieces of so many characters and more are one class.
LONG = 6


class Vocabulary:
    """Pieces of a vocabulary file as sorted hashes: of those that begin a word (0), and of those within one (1)."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=model_path)
        found: tuple[dict, dict] = {}, {}
        for i in range(m.get_piece_size()):
            if m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i):
                continue
            p = m.id_to_piece(i)
            body = p[1:] if p[0] == SPACE else p
            if body and not re.search(f"[A-Z{SPACE}]", body):  # words are lower-cased and hold no mark
                found[p[0] != SPACE][body] = m.get_score(i)
        self.longest = max(map(len, [*found[0], *found[1]]))
        scores = [x for f in found for x in f.values()]
        self.ranked = all(x == int(x) <= 0 for x in scores)
        self.keys, self.score, self.kind = [], [], []
        for pieces in found:
            rows = sorted((hash_of(p), x, min(len(p), LONG) - 1) for p, x in pieces.items())
            self.keys.append(np.asarray([r[0] for r in rows], dtype=np.uint64))
            self.score.append(np.asarray([r[1] for r in rows], dtype=np.float64))
            self.kind.append(np.asarray([r[2] for r in rows]))

    def find(self, which: int, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the pieces, or -1."""
        keys = self.keys[which]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, at, -1)

    def of_class(self, which: int, kind: int, slope: float, shift: float) -> np.ndarray:
        """Log weights of a class's pieces, summing to one."""
        x = self.score[which][self.kind[which] == kind]
        x = -slope * np.log(shift - x) if self.ranked else slope * x
        return x - np.logaddexp.reduce(x) if len(x) else x


def hash_of(piece: str) -> int:
    h = sum((ord(c) + 1) * pow(BASE, k, 1 << 64) for k, c in enumerate(piece)) % (1 << 64)
    return h ^ len(piece)


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> Vocabulary:
    return Vocabulary(model_path)


class Weights:
    """Log weights of pieces, of the bare mark, of bytes, and of a word's going on or ending after a piece.

    ``first`` with the bare mark sum to one, and so do ``later`` with the bytes.
    """

    def __init__(self, first: np.ndarray, later: np.ndarray, bare: float, by_bytes: float, stop: float):
        self.first, self.later = np.append(first, NEVER), np.append(later, NEVER)
        self.bare, self.by_bytes, self.stop, self.go = float(bare), float(by_bytes), float(np.log(stop)), float(np.log1p(-stop))

    @classmethod
    def of_classes(cls, v: Vocabulary, shares: list[np.ndarray], slopes: list[list[tuple[float, float]]], stop: float) -> Weights:
        """``shares``: of each class, and at the end of the bare mark and of the bytes."""
        out = []
        for which in (0, 1):
            w = np.full(len(v.keys[which]), NEVER)
            for kind in range(LONG):
                w[v.kind[which] == kind] = np.log(shares[which][kind]) + v.of_class(which, kind, *slopes[which][kind])
            out.append(w)
        return cls(*out, np.log(shares[0][LONG]), np.log(shares[1][LONG]), stop)

    @classmethod
    def untrained(cls, v: Vocabulary) -> Weights:
        return cls.of_classes(v, *start(v), 0.5)


def start(v: Vocabulary) -> tuple[list[np.ndarray], list[list[tuple[float, float]]]]:
    """Equal shares of the classes that have pieces, a thousandth for the bare mark and the bytes, slope 1, shift 10."""
    shares = []
    for which in (0, 1):
        there = np.asarray([(v.kind[which] == k).any() for k in range(LONG)], dtype=np.float64)
        shares.append(np.append(there / max(there.sum(), 1) * 0.999, 0.001) + 1e-12)
    return [x / x.sum() for x in shares], [[(1.0, 10.0)] * LONG] * 2


def fitted(v: Vocabulary, counts: Counts) -> tuple[Weights, Weights]:
    """The vocabulary's weights with shares and slopes that fit the expected counts best, and the adapted ones."""
    if not counts.words:
        return (Weights.untrained(v),) * 2
    shares, slopes = start(v)
    stop = min(0.99, (counts.words + 1) / (counts.pieces + 2))
    for which, (n, other) in enumerate(((counts.first, counts.bare), (counts.later, counts.bytes))):
        own = np.asarray([n[v.kind[which] == k].sum() for k in range(LONG)] + [other])
        shares[which] = (own + 10 * shares[which]) / (own.sum() + 10)
        options = [(s, q) for q in ((1.0, 10.0, 100.0, 1000.0, 10000.0) if v.ranked else (1.0,)) for s in np.arange(0, 3.01, 0.1)]
        slopes[which] = [max(options, key=lambda o: float(n[v.kind[which] == k] @ v.of_class(which, k, *o))) if own[k] > 0 else (1.0, 10.0) for k in range(LONG)]  # noqa: B023
    w = Weights.of_classes(v, shares, slopes, stop)
    mass = lambda n, log_w, other, log_o: (np.append(n, other) + max(10.0, 0.01 * (n.sum() + other)) * np.exp(np.append(log_w, log_o)))
    first, later = mass(counts.first, w.first[:-1], counts.bare, w.bare), mass(counts.later, w.later[:-1], counts.bytes, w.by_bytes)
    first, later = np.log(first / first.sum()), np.log(later / later.sum())
    return w, Weights(first[:-1], later[:-1], first[-1], later[-1], stop)


class Counts:
    """Expected counts: of pieces that begin words, of those within, of the bare mark, of bytes, of all pieces, of words."""

    PARTS = ("first", "later", "bare", "bytes", "pieces", "words")

    def __init__(self, first, later, bare=0.0, bytes=0.0, pieces=0.0, words=0.0):
        self.first, self.later, self.bare, self.bytes, self.pieces, self.words = first, later, bare, bytes, pieces, words

    @classmethod
    def none(cls, v: Vocabulary) -> Counts:
        return cls(np.zeros(len(v.keys[0])), np.zeros(len(v.keys[1])))

    def row(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.asarray(getattr(self, c), np.float64).tobytes()], pa.binary()) for c in self.PARTS], list(self.PARTS))

    def add(self, batch: pa.RecordBatch) -> None:
        for c in self.PARTS:
            for x in batch.column(c):
                got = np.frombuffer(x.as_buffer(), np.float64)
                setattr(self, c, getattr(self, c) + (got if len(got) > 1 else float(got[0])))


class Lattice:
    """Words of one length: their edges, found once."""

    def __init__(self, words: list[str], v: Vocabulary):
        self.n, self.length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(self.n, self.length)
        c = codes.astype(np.uint64) + np.uint64(1)
        size = (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF) + 1
        self.first, self.later = [], []
        h, power = np.zeros_like(c), 1
        for k in range(1, min(v.longest, self.length) + 1):
            h = h[:, : self.length - k + 1] + c[:, k - 1 :] * np.uint64(power)
            power = power * BASE % (1 << 64)
            own = h ^ np.uint64(k)
            self.first.append(v.find(0, own[:, 0]))
            self.later.append(v.find(1, own))
        # a length of one to four bytes, then the bytes, where no piece is the character
        self.spelt = np.where(self.later[0] < 0, -np.log(4.0) - size * np.log(256.0), NEVER)

    def later_weight(self, w: Weights, k: int, at: int) -> np.ndarray:
        out = w.later[self.later[k - 1][:, at]]
        return (np.maximum(out, self.spelt[:, at] + w.by_bytes) if k == 1 else out) + w.go

    def forward(self, w: Weights) -> np.ndarray:
        """Log weight of all paths to each place; the bare mark stands at place 0."""
        a = np.full((self.length + 1, self.n), NEVER)
        a[0] = w.bare - w.go
        for end in range(1, self.length + 1):
            terms = [a[end - k] + self.later_weight(w, k, end - k) for k in range(1, min(end, len(self.later)) + 1)]
            if end <= len(self.first):
                terms.append(w.first[self.first[end - 1]])
            top = np.maximum.reduce(terms)
            a[end] = top + np.log(sum(np.exp(t - top) for t in terms))
        return a

    def log_probability(self, w: Weights) -> np.ndarray:
        return self.forward(w)[-1] + w.stop

    def expect(self, w: Weights, often: np.ndarray, into: Counts) -> None:
        """Add the expected counts over all segmentations, each word as often as it occurs."""
        a = self.forward(w)
        z = a[-1] - np.log(often)
        b = np.full_like(a, NEVER)
        b[-1] = 0.0
        for at in range(self.length - 1, -1, -1):
            terms = [b[at + k] + self.later_weight(w, k, at) for k in range(1, min(self.length - at, len(self.later)) + 1)]
            top = np.maximum.reduce(terms)
            b[at] = top + np.log(sum(np.exp(t - top) for t in terms))
        for k, at in enumerate(self.later, 1):
            p = np.exp(a[: self.length - k + 1].T + (w.later[at] + w.go) + b[k:].T - z[:, None])
            into.later += np.bincount(at.ravel() + 1, weights=p.ravel(), minlength=len(into.later) + 1)[1:]
            into.pieces += p.sum()
        p = np.exp(a[:-1].T + (self.spelt + w.by_bytes + w.go) + b[1:].T - z[:, None]).sum()
        into.bytes += float(p)
        into.pieces += p
        for k, at in enumerate(self.first, 1):
            p = np.exp(w.first[at] + b[k] - z)
            into.first += np.bincount(at + 1, weights=p, minlength=len(into.first) + 1)[1:]
            into.pieces += p.sum()
        into.bare += float(np.exp(a[0] + b[0] - z).sum())
        into.words += float(often.sum())


def lattices(words: list[str], v: Vocabulary, cells: int = 2_000_000):
    """(places in ``words``, lattice) for groups of words of one length."""
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by.setdefault(len(w), []).append(k)
    for length, at in by.items():
        step = max(1, cells // (length * min(v.longest, length)))
        for k in range(0, len(at), step):
            yield at[k : k + step], Lattice([words[j] for j in at[k : k + step]], v)


def text_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def word_table(base: DataFrame, groups: int = 1, flush: int = 250_000) -> DataFrame:
    """(word, c, g0, g1, ...): every distinct word of all documents and its number in training texts, and in those of
    each of ``groups`` groups.

    ``base`` has the text ``t``, whether it trains, ``own``, and its group ``g``; the empty word is the end of a text.
    """

    def tally(batches):
        seen, other = [Counter() for _ in range(groups)], set()

        def rows():
            words = [*(w for x in seen for w in x), *other]
            c = [*(c for x in seen for c in x.values()), *[0] * len(other)]
            g = [*(k for k, x in enumerate(seen) for _ in range(len(x))), *[0] * len(other)]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(g, pa.int32()), pa.array(c, pa.int64())], ["word", "g", "c"])
            for x in (*seen, other):
                x.clear()
            return out

        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                for t, own, g in zip(*(x.to_pylist() for x in part.columns)):
                    if own:
                        seen[g].update(text_words(t))
                        seen[g][END] += 1
                    else:
                        other.update(text_words(t))
                if sum(map(len, seen)) + len(other) > flush:
                    yield rows()
        yield rows()

    rows = base.select("t", "own", "g").mapInArrow(tidy(tally), "word binary, g int, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), *(F.sum(F.when(F.col("g") == k, F.col("c")).otherwise(0)).alias(f"g{k}") for k in range(groups)))


def expected(counts: DataFrame, model_path: str, chunk: int = 20_000, fan_in: int = 32) -> Counts:
    """Expected counts over every distinct training word, added up in a tree of tasks: ``fan_in`` rows reach the driver."""
    fields = ", ".join(f"{c} binary" for c in Counts.PARTS)

    def learn(batches):
        v = vocabulary(model_path)
        w, into = Weights.untrained(v), Counts.none(v)
        for b in batches:
            for k in range(0, b.num_rows, chunk):
                got = [(x.decode("utf-8", "replace"), c) for x, c in zip(*(y.to_pylist() for y in b.slice(k, chunk).columns[:2])) if x and c]
                often = np.asarray([c for _, c in got], dtype=np.float64)
                for at, x in lattices([x for x, _ in got], v):
                    x.expect(w, often[at], into)
        yield into.row()

    def add_up(batches):
        into = Counts.none(vocabulary(model_path))
        for b in batches:
            into.add(b)
        yield into.row()

    rows, n = counts.mapInArrow(tidy(learn), fields), counts.rdd.getNumPartitions()
    while n > fan_in:
        n = -(-n // fan_in)
        rows = rows.repartition(n).mapInArrow(tidy(add_up), fields)
    out = Counts.none(vocabulary(model_path))
    for b in rows.toArrow().to_batches():
        out.add(b)
    return out


SCORES = ("vocabulary_score", "adapted_score", "counted_score")
#: Groups of training texts beside the rest; a bound of the model, as each is a column of every word.
GROUPS = 8


def discount(once: int, twice: int) -> float:
    """What is taken off the number of every word for the unseen ones; below one, so that no seen word loses its edge."""
    return min(0.9, once / (once + 2 * twice)) if once else 0.5


def likelihood(docs: DataFrame, model_path: str, train: Column, key: str = "doc_id", text: str = "text", group: str = "lang", hot_words: int = 300_000) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, vocabulary_score, adapted_score, counted_score), a row for
    each row of ``docs``, in log10. Without a column ``group`` all training texts are one group."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    own = F.coalesce(train, F.lit(False))
    of = F.coalesce(F.col(group).cast("string"), F.lit("")) if group in docs.columns else F.lit("")
    named = [r.g for r in docs.where(own).groupBy(of.alias("g")).count().orderBy(F.desc("count"), "g").limit(GROUPS).collect()]
    base = placed(docs, key, text, own=own, g=F.coalesce(*(F.when(of == x, k) for k, x in enumerate(named)), F.lit(len(named))))
    parts = len(named) + 1
    counts = materialise(word_table(base, parts), "words")
    is_end = F.col("word") == F.lit(END)
    facts = lambda c: (F.coalesce(F.sum(c), F.lit(0)), F.count_if(F.col(c) > 0), F.coalesce(F.max(F.when(is_end, F.col(c))), F.lit(0)), F.count_if(F.col(c) == 1), F.count_if(F.col(c) == 2))
    of_all = ("c", *(f"g{k}" for k in range(parts)))
    found = counts.agg(*(x.alias(f"{c}_{i}") for c in of_all for i, x in enumerate(facts(c)))).first()
    facts_of = {c: tuple(found[5 * i : 5 * i + 5]) for i, c in enumerate(of_all)}
    n, distinct, texts, once, twice = facts_of["c"]
    used = [c for c in of_all[1:] if facts_of[c][2]]
    less = discount(once, twice)
    ends = texts / n if n else 0.5
    sent = spark.sparkContext.broadcast(fitted(vocabulary(model_path), expected(counts, model_path)))
    sums_of = (*SCORES[:2], *(used or ["g0"]))

    def weigh(batches):
        v = vocabulary(model_path)
        for b in batches:
            words = b.column(0).to_pylist()
            out = np.full((len(words), len(sums_of)), np.log(max(ends, 1e-12)))
            real = [k for k, x in enumerate(words) if x]
            for at, x in lattices([words[k].decode("utf-8", "replace") for k in real], v):
                for k, w in enumerate(sent.value):
                    out[[real[j] for j in at], k] = x.log_probability(w) + np.log1p(-min(ends, 1 - 1e-12))
            c = b.column(1).to_numpy().astype(np.float64)
            if n:
                with np.errstate(divide="ignore"):
                    spelt = np.where([bool(x) for x in words], out[:, 1] + np.log(less * distinct / n), -np.inf)
                    whole = np.logaddexp(np.log(np.maximum(c - less, 0) / n), spelt)
                    for k, name in enumerate(used, 2):
                        m, kinds, _, one, two = facts_of[name]
                        off = discount(one, two)
                        out[:, k] = np.logaddexp(np.log(np.maximum(b.column(name).to_numpy() - off, 0) / m), whole + np.log(off * kinds / m))
            else:
                out[:, 2] = out[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array(x) for x in (out / np.log(10)).T.copy())], ["word", "c", *sums_of])

    columns = ", ".join(f"{x} double" for x in sums_of)
    scored = materialise(counts.mapInArrow(tidy(weigh), f"word binary, c long, {columns}"), "word-scores")
    top = frequent(scored, "word", "c", hot_words).toArrow()  # about hot_words rows
    base_of = lambda c: np.log10((c + 0.1) / (n + 0.1 * (distinct + 1)))
    c = top["c"].to_numpy().astype(np.float64)
    table = np.column_stack([base_of(c), c > 0, *(top[x].to_numpy() for x in sums_of)])
    hot = spark.sparkContext.broadcast((pa.array(top["word"].to_pylist(), pa.binary()), table))
    del top, c
    sums = ("base_score", "n_known", *sums_of)
    end = np.asarray([float(base_of(0.0)), 0.0, *[np.log10(max(ends, 1e-12))] * len(sums_of)])  # where no text trains

    def known(batches):
        index, table = hot_index(hot)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                n_t, out = [], np.zeros((part.num_rows, table.shape[1]))
                for j, t in enumerate(part.column(3).to_pylist()):
                    words = text_words(t)
                    n_t.append(len(words) + 1)
                    at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                    out[j] = table[at[at >= 0]].sum(0) + (table[index[END]] if END in index else end)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(n_t, pa.int64()), *(pa.array(x) for x in out.T.copy())], ["f", "r", "k", "n_tokens", *sums])

    def others(batches):
        index, _ = hot_index(hot)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                at, words, tf = [], [], []
                for j, t in enumerate(part.column(2).to_pylist()):
                    for w, c in Counter(w for w in text_words(t) if w not in index).items():
                        at.append(j), words.append(w), tf.append(c)
                if at:
                    at = pa.array(at, pa.int32())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(words, pa.binary()), pa.array(tf, pa.int32())], ["f", "r", "word", "tf"])

    rare = base.select("f", "r", "t").mapInArrow(tidy(others), "f long, r long, word binary, tf int").join(scored, "word")
    of_base = F.log10((F.col("c") + F.lit(0.1)) / (F.lit(float(n)) + F.lit(0.1) * F.lit(distinct + 1)))
    seen = F.when(F.col("c") > 0, F.col("tf")).otherwise(0).cast("double")
    rare = rare.select("f", "r", F.lit(None).cast(kind).alias("k"), F.lit(None).cast("long").alias("n_tokens"), (of_base * F.col("tf")).alias("base_score"), seen.alias("n_known"), *((F.col(x) * F.col("tf")).alias(x) for x in sums_of))
    fields = T.StructType([T.StructField("f", T.LongType()), T.StructField("r", T.LongType()), T.StructField("k", kind), T.StructField("n_tokens", T.LongType()), *(T.StructField(x, T.DoubleType()) for x in sums)])
    whole = base.select("f", "r", "k", "t").mapInArrow(tidy(known), fields)
    out = whole.unionByName(rare).groupBy("f", "r").agg(F.max("k").alias(key), F.max("n_tokens").alias("n_tokens"), *(F.sum(x).alias(x) for x in sums))
    # the groups' probabilities, each by its share of the training texts
    each = [F.col(c) + F.lit(float(np.log10(facts_of[c][2] / texts))) for c in used] or [F.col("g0")]
    top_of = F.array_max(F.array(*each))
    score = top_of + F.log10(reduce(lambda x, y: x + y, (F.pow(F.lit(10.0), x - top_of) for x in each)))
    return out.select(key, "n_tokens", F.round("n_known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), "base_score", score.alias("score"), *SCORES[:2], score.alias(SCORES[2]))


def hot_index(sent) -> tuple[dict[bytes, int], np.ndarray]:
    """The table of frequent words and their places in it."""
    words, table = sent.value
    return {w: k for k, w in enumerate(words.to_pylist())}, table
