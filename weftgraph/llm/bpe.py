"""Byte-level BPE over a table of distinct words.

Executors split texts into words with the library's own pattern; each distinct word is encoded once, in executors, and
its ids are joined back by position. As in any join with hot keys, the table of distinct words has two parts:

1. Words that are frequent in a bounded sample of rows (the sample only chooses a word's route, never its ids). They are
   encoded, sorted by number and broadcast as Arrow, at most ``hot_words`` of them.
2. Every other word, which goes with the place of its row through a shuffle on the word: there it is encoded, and its
   ids return by place. A row sends a word once, with all its positions; words of more than 64 characters are salted, so
   one that many rows hold is spread over 64 tasks (and encoded there).

A text travels as one code for each word, a number that the broadcast part resolves or a mark that the returned ids
fill. Rows are told apart by file and row number, never by id or text. Decoding joins ids by position to the id-to-piece
table, whose size is the vocabulary's.

Texts are cut and looked up some megabytes at a time, as Arrow arrays: each distinct chunk of them is cut once, and the
broadcast words stay an array, so no worker holds a dictionary of them.

Defined results: null text is the empty text (no ids); repeated rows, repeated ids and null ids each keep their row; an
empty table gives an empty table; of the columns, the key and those made here are returned, whatever else the table
holds.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.words import frequent, placed, tidy
from weftgraph.session import materialise

#: White space as the tokenizers library's patterns take it (Unicode White_Space).
WS = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The published pattern of the byte-level vocabulary.
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: A run of white space with what follows it: no word crosses such a border.
CHUNK = regex.compile(rf"[{WS}]*[^{WS}]+|[{WS}]+")
#: White space before a space: only there can a cut before a space part what belongs together.
ODD = r"[\t-\r \x85\xa0\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: A chunk of Latin letters with up to eight marks behind it: the letters, with the space, are a word, the marks another.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = rf"\A ?[A-Za-z\x{{c0}}-\x{{d6}}\x{{d8}}-\x{{f6}}\x{{f8}}-\x{{24f}}]+[{regex.escape(MARKS)}]{{0,8}}\z"
#: Codes of words in a packed text: places in the broadcast table, then added tokens, then the mark of an open word.
ADDED, GAP = 0xFE0000, 0xFFFFFF
#: Before they are packed, codes from here on are open words by number.
OPEN = 0x1000000
#: Characters of words that go among the many frequent ones, and among the few.
SHORT, LONGEST = 64, 1024


class Codec:
    """One vocabulary file: words, ids of a word, pieces of ids."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level vocabulary without normaliser or prefix space is needed")
        self.cutter = ByteLevel(add_prefix_space=False, use_regex=True)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.added_at = regex.compile("(" + "|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.size = max([*spec["model"]["vocab"].values(), *self.added.values()]) + 1
        if self.size > 0xFFFF:
            raise ValueError("vocabularies of up to 65,535 ids are packed in two bytes")

    @cached_property
    def tok(self):
        """The library's tokenizer, for the workers that encode words: those that only cut texts do without."""
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def encode_word(self, word: str) -> bytes:
        return np.asarray(self.tok.encode(word, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def chunks(self, text: str) -> list[str]:
        return CHUNK.findall(text)

    def parts(self, text: str) -> list[tuple[str, int]]:
        """(text, -1) or ("", id of an added token), as the library cuts a text before anything else."""
        if not self.added or not self.added_at.search(text):
            return [(text, -1)] if text else []
        return [("", self.added[x]) if x in self.added else (x, -1) for x in self.added_at.split(text) if x]

    def cut(self, chunk: str) -> list[str]:
        """The words of a chunk. Beyond Latin, classes of characters differ by Unicode version: there the library cuts."""
        if chunk.isascii() or max(chunk) < "\u0370":
            return WORD.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(chunk)]

    def words(self, text: str | None) -> list[str]:
        return [w for t, i in self.parts(text or "") if i < 0 for c in self.chunks(t) for w in self.cut(c)]


class Chunks:
    """Texts as numbers of their distinct chunks.

    ``distinct`` are the chunks, ``codes`` the codes of added tokens, which are numbered behind them; text ``k`` of
    ``order`` (its place among the texts) has the numbers ``at[ends[k - 1] : ends[k]]``.
    """

    def __init__(self, codec: Codec, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        slow = np.asarray(pc.match_substring_regex(texts, ODD))
        for a in codec.added:
            slow = slow | np.asarray(pc.match_substring(texts, a))
        quick = texts if not slow.any() else texts.filter(pa.array(~slow))
        self.order = np.concatenate([np.flatnonzero(~slow), np.flatnonzero(slow)])
        # cut before each space: a text's first chunk stands as it is, the others have the space before them
        cut = pc.split_pattern(quick, " ")
        size, found = np.asarray(pc.list_value_length(cut)).astype(np.int64), cut.flatten().dictionary_encode()
        at, first = np.asarray(found.indices), np.cumsum(size) - size
        heads, head_of = np.unique(at[first], return_inverse=True)
        some = [pc.binary_join_element_wise(pa.scalar(""), found.dictionary, " "), found.dictionary.take(pa.array(heads))]
        at = at.astype(np.int32)
        at[first] = len(found.dictionary) + head_of
        # the rest are cut one by one
        n, own, added, more, sizes = len(found.dictionary) + len(heads), {}, {}, [], []
        for text in texts.filter(pa.array(slow)).to_pylist() if slow.any() else ():
            before = len(more)
            for t, i in codec.parts(text):
                if i >= 0:
                    more.append(-1 - added.setdefault(i, len(added)))
                else:
                    more += [own.setdefault(c, len(own)) for c in codec.chunks(t)]
            sizes.append(len(more) - before)
        tail = np.asarray(more, np.int32)
        tail = np.where(tail < 0, n + len(own) - 1 - tail, n + tail).astype(np.int32)
        self.distinct = pa.concat_arrays([*some, pa.array(own, pa.string())])
        self.codes = np.asarray([ADDED + i for i in added], np.int32)
        self.at = np.concatenate([at, tail])
        self.ends = np.cumsum(np.concatenate([size, np.asarray(sizes, np.int64)]))


class Cut:
    """The words of ``chunks``, some chunks after the others: chunk ``of[k]`` has the ``size[k]`` words from ``start[k]`` on."""

    def __init__(self, codec: Codec, chunks: pa.Array):
        plain = np.asarray(pc.match_substring_regex(chunks, PLAIN))
        easy, hard = chunks.filter(pa.array(plain)), chunks.filter(pa.array(~plain)).to_pylist()
        stem = pc.utf8_rtrim(easy, MARKS)
        marks = np.asarray(pc.subtract(pc.binary_length(easy), pc.binary_length(stem)))
        by_size = [(k, np.flatnonzero(marks == k)) for k in np.unique(marks[marks > 0]).tolist()]
        found = [codec.cut(c) for c in hard]
        n, sizes = len(easy), np.fromiter(map(len, found), np.int64, len(found))
        self.words = pa.concat_arrays([stem, pa.array([w for ws in found for w in ws], pa.string()), *(pc.utf8_slice_codeunits(easy.take(pa.array(at)), -k) for k, at in by_size)])
        self.of = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        self.size = np.concatenate([1 + (marks > 0), sizes]).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        #: for each word of the chunks its number among ``words``
        self.at = np.zeros(int(self.size.sum()), np.int64)
        self.at[self.start[:n]] = np.arange(n)
        self.at[len(self.at) - int(sizes.sum()) :] = n + np.arange(int(sizes.sum()))
        marked = np.concatenate([np.zeros(0, np.int64), *(at for _, at in by_size)])
        self.at[self.start[marked] + 1] = n + int(sizes.sum()) + np.arange(len(marked))


class Words:
    """A table of distinct words that are looked up by a hash of their first bytes; a hit is compared whole, so a clash
    of hashes only leaves a word open."""

    WEIGHTS = np.random.default_rng(9).integers(1 << 62, 1 << 63, SHORT, np.uint64) | np.uint64(1)

    def __init__(self, words: pa.Array):
        self.words, own = words, self.hashes(words)
        self.order = np.argsort(own).astype(np.int32)
        self.sorted = own[self.order]

    def hashes(self, words: pa.Array) -> np.ndarray:
        _, offsets, data = words.buffers()
        if data is None or not len(words):
            return np.zeros(len(words), np.uint64)
        at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data, out = np.frombuffer(data, np.uint8), np.empty(len(words), np.uint64)
        for k in range(0, len(words), 50_000):
            start, size = at[:-1][k : k + 50_000], np.diff(at[k : k + 50_001])
            own = np.minimum(size, SHORT)
            ends = np.cumsum(own)
            nth = np.arange(int(ends[-1])) - np.repeat(ends - own, own)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.WEIGHTS[nth] * (data[np.repeat(start, own) + nth].astype(np.uint64) + np.uint64(1)))])
            out[k : k + 50_000] = (sums[ends] - sums[ends - own]) * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)
        return out

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each of the words in the table, or -1."""
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        own = self.hashes(words)
        line = np.argsort(own)
        at = np.empty(len(own), np.int64)
        at[line] = np.minimum(np.searchsorted(self.sorted, own[line]), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[at] == own)
        place = self.order[at[hit]]
        same = np.asarray(pc.equal(self.words.take(pa.array(place)), words.take(pa.array(hit))))
        out = np.full(len(words), -1, np.int64)
        out[hit[same]] = place[same]
        return out


class Packer:
    """Gives texts as codes of their words, many texts at a time. ``table`` holds the broadcast words."""

    def __init__(self, codec: Codec, table: pa.Array):
        self.codec, self.table = codec, Words(table)

    def pack(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """(order, ends, codes, open words): text ``order[k]`` has the codes from ``ends[k - 1]`` to ``ends[k]``; those
        from ``OPEN`` on are the numbers of open words."""
        c = Chunks(self.codec, texts)
        n = len(c.distinct)
        whole = self.table.find(c.distinct)  # a chunk that is a word of the table is that word alone
        rest = np.flatnonzero(whole < 0)
        cut = Cut(self.codec, c.distinct.take(pa.array(rest)))
        words = cut.words.dictionary_encode()
        known = self.table.find(words.dictionary)
        left = np.flatnonzero(known < 0)
        known[left] = OPEN + np.arange(len(left))
        size = np.ones(n + len(c.codes), np.int64)
        start = np.arange(n + len(c.codes))
        size[rest[cut.of]], start[rest[cut.of]] = cut.size, len(start) + cut.start
        flat = np.concatenate([whole, c.codes, known[np.asarray(words.indices)[cut.at]]]).astype(np.int32)
        codes, ends = runs(flat, start, size, c.at)
        return c.order, ends[c.ends - 1] if len(ends) else np.zeros(len(c.ends), np.int64), codes, words.dictionary.take(pa.array(left))


def runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that the numbers ``at`` name, one after the other, and where each ends."""
    own = size[at]
    ends = np.cumsum(own)
    return flat[np.repeat(start[at] - (ends - own), own) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def some_of(batch: pa.RecordBatch, column: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of a text column, of one row at least."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
    k = 0
    while k < len(size):
        end = max(k + 1, int(np.searchsorted(size, (size[k - 1] if k else 0) + most, "right")))
        yield batch.slice(k, end - k)
        k = end


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


class Hot:
    """The broadcast part of the table of distinct words: the words, and the ids of a code, laid out flat."""

    def __init__(self, blob: bytes):
        table = pa.ipc.open_stream(pa.py_buffer(blob)).read_all().combine_chunks()
        word, ids = (table[n].chunk(0) if len(table) else pa.array([], t) for n, t in (("word", pa.string()), ("ids", pa.binary())))
        self.words = word.cast(pa.string())
        size = np.asarray(pc.binary_length(ids).cast(pa.int64())) // 2
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.ids = np.frombuffer(pc.binary_join(pa.array([ids.cast(pa.binary())], pa.list_(pa.binary())), b"")[0].as_py() if len(ids) else b"", dtype="<u2")


@lru_cache(maxsize=1)
def hot(blob: bytes) -> Hot:
    return Hot(blob)


def encoded_words(words: DataFrame, path: str) -> DataFrame:
    """``words`` (word, ...) with ``ids``: each row's word is encoded once."""

    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.encode_word(w) for w in b.column("word").to_pylist()], pa.binary())], [*b.schema.names, "ids"])

    return words.mapInArrow(tidy(run), T.StructType([*words.schema, T.StructField("ids", T.BinaryType())]))


def hot_table(base: DataFrame, path: str, hot_words: int, sample_rows: int) -> bytes:
    """The frequent part of the table of distinct words, as Arrow: the words that are frequent in about ``sample_rows`` rows.

    At most ``hot_words`` words of up to 64 characters and a hundredth as many of up to 1,024: at 100 bytes a word and
    its ids, 40 MB at the default, and some 10 MB for words as they are.
    """
    n = base.count()
    share = int(min(1.0, sample_rows / max(n, 1)) * (1 << 20)) + 1
    few = base.where(F.pmod(F.xxhash64("f", "r"), F.lit(1 << 20)) < share).select("t")

    def tally(batches):
        c = codec(path)
        for b in batches:
            for part in some_of(b, 0):
                chunks = Chunks(c, part.column(0))
                n = np.bincount(chunks.at, minlength=len(chunks.distinct))[: len(chunks.distinct)]
                cut = Cut(c, chunks.distinct)
                words = cut.words.dictionary_encode()
                times = np.bincount(np.asarray(words.indices)[cut.at], np.repeat(n[cut.of], cut.size), len(words.dictionary)).astype(np.int64)
                out = pa.RecordBatch.from_arrays([words.dictionary, pa.array(times)], ["word", "n"])
                yield out.filter(pc.and_(pc.less_equal(pc.utf8_length(out.column(0)), LONGEST), pc.greater(out.column(1), 0)))

    seen = materialise(few.mapInArrow(tidy(tally), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "sample-words")
    length = F.char_length("word")
    short, long = (frequent(seen.where(x), "word", "n", most) for x, most in ((length <= SHORT, hot_words), (length > SHORT, hot_words // 100)))
    table = encoded_words(short.unionByName(long), path).toArrow().sort_by([("n", "descending"), ("word", "ascending")]).select(["word", "ids"])
    if len(table) >= ADDED:
        raise ValueError("codes are made for fewer frequent words")
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", hot_words: int = 400_000, sample_rows: int = 40_000) -> DataFrame:
    """A row for each row of ``docs``: ``key`` and ``ids`` (binary, two bytes an id, little end first)."""

    def made(ids, ends):
        data = ids.astype("<u2").tobytes()
        return [pa.array([data[2 * a : 2 * b] for a, b in zip([0, *ends], ends)], pa.binary())]

    return _encoded(docs, path, key, text, hot_words, sample_rows, {"ids": "binary"}, made)


def encoded_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", hot_words: int = 400_000, sample_rows: int = 40_000) -> DataFrame:
    """``digests(encode(...))`` where the ids are made, so they go through no second worker."""
    return _encoded(docs, path, key, text, hot_words, sample_rows, DIGESTS, lambda ids, ends: digested(ids, ends, path))


def _encoded(docs: DataFrame, path: str, key: str, text: str, hot_words: int, sample_rows: int, fields: dict[str, str], made) -> DataFrame:
    """``key`` and the columns ``fields`` that ``made`` gives of the ids of some texts and of where each text's end."""
    base = placed(docs, key, text)
    kind = docs.schema[key].dataType
    sent = docs.sparkSession.sparkContext.broadcast(hot_table(base, path, hot_words, sample_rows))
    row = T.StructType([T.StructField(n, t) for n, t in (("f", T.LongType()), ("r", T.LongType()), ("at", T.IntegerType()), ("more", T.BinaryType()), ("ids", T.BinaryType()), ("k", kind))])

    def opened(batches):
        """(w, f, r, at, more): the open words of each row once, with the places where they stand among the open ones."""
        p = Packer(codec(path), hot(sent.value).words)
        for b in batches:
            for part in some_of(b, 2):
                order, ends, codes, words = p.pack(part.column(2))
                place = np.flatnonzero(codes >= OPEN)
                if not len(place):
                    continue
                of = np.searchsorted(ends, place, "right")
                nth = np.arange(len(place)) - np.searchsorted(of, of)  # among the open words of the text
                pair = of * len(words) + (codes[place] - OPEN)
                line = np.argsort(pair, kind="stable")
                pair, nth = pair[line], nth[line].astype("<i4")
                head = np.flatnonzero(np.diff(pair, prepend=-1))
                end = np.append(head[1:], len(pair))
                more = [None] * len(head)
                for k in np.flatnonzero(end - head > 1).tolist():
                    more[k] = nth[head[k] + 1 : end[k]].tobytes()
                rows = pa.array(order[pair[head] // len(words)])
                yield pa.RecordBatch.from_arrays([words.take(pa.array(pair[head] % len(words))), part.column(0).take(rows), part.column(1).take(rows), pa.array(nth[head], pa.int32()), pa.array(more, pa.binary())], ["w", "f", "r", "at", "more"])

    def merged(batches):
        c, last, ids = codec(path), None, b""
        for b in batches:
            got = []
            for w in b.column(0).to_pylist():
                if w != last:
                    last, ids = w, c.encode_word(w)
                got.append(ids)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(got, pa.binary())], ["f", "r", "at", "more", "ids"])

    def packed(batches):
        p, z = Packer(codec(path), hot(sent.value).words), zstandard.ZstdCompressor(level=1)
        for b in batches:
            for part in some_of(b, 2):
                order, ends, codes, _ = p.pack(part.column(2))
                lanes = planes(np.minimum(codes, GAP))
                got = [z.compress(b"".join(x[i:j].tobytes() for x in lanes)) for i, j in zip([0, *ends], ends)]
                n, rows = len(got), pa.array(order)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array([-1] * n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(got, pa.binary()), part.column(3).take(rows)], row.names)

    def filled(batches):
        table, z = hot(sent.value), zstandard.ZstdDecompressor()
        now, head, fills, done, size, key_type = None, None, [], [], 0, None

        def close():
            codes = unplaned(z.decompress(head[0]))
            gaps = [b""] * int((codes == GAP).sum())
            for at, more, ids in fills:
                gaps[at] = ids
                for i in np.frombuffer(more, "<i4").tolist() if more else ():
                    gaps[i] = ids
            if b"" in gaps:
                raise RuntimeError("a word of a text got no ids")
            return head[1], codes, gaps

        def batch():
            """Of the texts that are done, the ids and what is made of them."""
            ids, ends = looked_up(np.concatenate([c for _, c, _ in done]), [g for _, _, gaps in done for g in gaps], table, np.cumsum([len(c) for _, c, _ in done]))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in done], key_type), *made(ids, ends.tolist())], [key, *fields])

        for b in batches:
            key_type = b.schema.field("k").type
            for f, r, at, more, ids, k in zip(*(c.to_pylist() for c in b.columns)):
                if (f, r) != now:
                    if now is not None:
                        done.append(close())
                        size += len(done[-1][1])
                        if size > 300_000 or len(done) >= 5_000:
                            yield batch()
                            done, size = [], 0
                    now, fills = (f, r), []
                if at < 0:
                    head = (ids, k)
                else:
                    fills.append((at, more, ids))
        if now is not None:
            done.append(close())
            yield batch()

    salt = F.when(F.length("w") > SHORT, F.pmod("r", F.lit(64))).otherwise(0)  # long words that many rows hold
    open_words = base.select("f", "r", "t").mapInArrow(tidy(opened, hot), "w string, f long, r long, at int, more binary")
    rare = open_words.repartition(F.col("w"), salt).sortWithinPartitions("w").mapInArrow(tidy(merged), "f long, r long, at int, more binary, ids binary")
    whole = base.select("f", "r", "t", "k").mapInArrow(tidy(packed, hot), row)
    both = whole.unionByName(rare.withColumn("k", F.lit(None).cast(kind)))
    out = T.StructType([T.StructField(key, kind), *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in fields.items()))])
    return both.repartition("f", "r").sortWithinPartitions("f", "r", "at").mapInArrow(tidy(filled, hot), out)


def planes(codes: np.ndarray) -> np.ndarray:
    """The lowest bytes of the codes, the next ones, the highest: of a text, alike bytes go side by side."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T)


def unplaned(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(3, -1).T
    return out.reshape(-1).view("<u4")


def looked_up(codes: np.ndarray, gaps: list[bytes], table: Hot, text_ends: np.ndarray, step: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """The ids of codes, and where each text's end: joined to the broadcast words by code, to added tokens, and to the
    words that came back."""
    out, sizes, used = [], [np.zeros(1, np.int64)], 0
    for k in range(0, len(codes), step):
        c = codes[k : k + step].astype(np.int64)
        is_open, is_added = c == GAP, (c >= ADDED) & (c != GAP)
        known = np.where(is_open | is_added, 0, c)
        start = table.start[known] if len(table.start) > 1 else np.zeros(len(c), np.int64)
        size = table.start[known + 1] - start if len(table.start) > 1 else np.zeros(len(c), np.int64)
        mine = gaps[used : used + int(is_open.sum())]
        used += len(mine)
        extra, n = [table.ids], len(table.ids)
        if mine:
            own = np.fromiter(map(len, mine), np.int64, len(mine)) // 2
            size[is_open] = own
            start[is_open] = n + np.cumsum(own) - own
            extra.append(np.frombuffer(b"".join(mine), "<u2"))
            n += len(extra[-1])
        if is_added.any():
            size[is_added] = 1
            start[is_added] = n + np.arange(int(is_added.sum()))
            extra.append((c[is_added] - ADDED).astype("<u2"))
        flat = np.concatenate(extra) if len(extra) > 1 else extra[0]
        out.append(runs(flat, start, size, np.arange(len(c)))[0])
        sizes.append(size)
    return np.concatenate([np.zeros(0, "<u2"), *out]), np.cumsum(np.concatenate(sizes))[text_ends]


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids, joined by position to the id-to-piece table."""

    @F.pandas_udf("string")
    def text(packed):
        table = pieces(path)
        return packed.map(lambda p: joined(p, table).decode("utf-8", "replace"))

    return encoded.withColumn(out, text(F.col(f"`{ids}`")))


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table: the bytes of each id, at the row of its number."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranges = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in ranges}
    of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(ranges))}
    vocab, added = spec["model"]["vocab"], {a["content"]: a["id"] for a in spec["added_tokens"]}
    out = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(of[ch] for ch in piece) if all(ch in of for ch in piece) else piece.encode()
    for content, i in added.items():
        out[i] = content.encode()
    return pa.array(out, pa.large_binary())


@lru_cache(maxsize=2)
def numerals(path: str) -> pa.Array:
    """Each id as decimal figures and a comma, at the row of its number."""
    return pa.array([b"%d," % i for i in range(len(pieces(path)))], pa.large_binary())


def laid_out(ids: np.ndarray, table: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The rows of the table that ids name, in their order: ids joined by row number. Their bytes, and where each begins."""
    got = table.take(pa.array(ids))
    _, offsets, data = got.buffers()
    at = np.frombuffer(offsets, np.int64)[got.offset : got.offset + len(got) + 1] if len(got) else np.zeros(1, np.int64)
    return memoryview(data if data is not None else b""), at


def joined(packed: bytes, table: pa.Array) -> bytes:
    """The pieces of the ids, in their order."""
    data, at = laid_out(np.frombuffer(packed, dtype="<u2"), table)
    return bytes(data[at[0] : at[-1]])


#: What ``digested`` makes of the ids of a text.
DIGESTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def digested(ids: np.ndarray, ends: list[int], path: str, step: int = 500_000) -> list[pa.Array]:
    """Number of ids, and digests of the ids and of the text that they decode to, of each text."""
    decoded, figures, starts = pieces(path), numerals(path), [0, *ends][:-1]
    if len(ids) <= step:
        (text, t), (number, d) = laid_out(ids, decoded), laid_out(ids, figures)
        a = [hashlib.sha256(number[d[i] : max(d[j] - 1, d[i])]).hexdigest() for i, j in zip(starts, ends)]
        b = [hashlib.sha256(str(text[t[i] : t[j]], "utf-8", "replace").encode()).hexdigest() for i, j in zip(starts, ends)]
    else:
        a, b = [], []
        for i, j in zip(starts, ends):
            of_ids, of_text, reader = hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")
            for k in range(i, j, step):
                e = min(k + step, j)
                (text, t), (number, d) = laid_out(ids[k:e], decoded), laid_out(ids[k:e], figures)
                of_ids.update(number[: d[-1] - (e == j)])
                of_text.update(reader.decode(text[: t[-1]], e == j).encode())
            a.append(of_ids.hexdigest()), b.append(of_text.hexdigest())
    return [pa.array([j - i for i, j in zip(starts, ends)], pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


def digests(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Number of ids, and digests of the ids and of the text that they decode to."""

    def rows(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                packed = part.column(1).to_pylist()
                made = digested(np.frombuffer(b"".join(packed), "<u2"), np.cumsum([len(p) // 2 for p in packed]).tolist(), path)
                yield pa.RecordBatch.from_arrays([part.column(0), *made], [key, *DIGESTS])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(f"`{key}`", "ids").mapInArrow(tidy(rows), f"`{key}` {kind}, " + ", ".join(f"{n} {t}" for n, t in DIGESTS.items()))
