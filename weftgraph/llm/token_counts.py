"""Token counts with a whole-token shortcut.

The text is cut where no merge can cross: before a run of spaces that follows another character. That is safe when
no vocabulary string holds a space mark after another character, which ``boundaries_hold`` proves from the vocabulary.
``whole_tokens`` proves offline which vocabulary strings encode alone as one token; pre-tokens among them count as one
without any merging, and only the others are merged, each distinct one once per worker while it stays in a bounded memo.

Defined results: null text counts as the empty text (0 tokens); rows, ties and repeated rows stay as they are; an empty
table gives an empty table; extra columns stay. A column named as ``out`` is replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

SPACE = "▁"
UNITS = re.compile(r" *[^ ]+| +$")


class Counter:
    """Counts tokens as the library does for a model whose normaliser only marks spaces and adds one in front."""

    def __init__(self, model_path: str, memo_size: int = 400_000, memo_chars: int = 64):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_path)
        self.memo_size, self.memo_chars = memo_size, memo_chars
        self.split = self.boundaries_hold() and self.marks_only()
        self.whole = self.whole_tokens() if self.split else frozenset()
        self.memo: dict[str, int] = {}

    def pieces(self) -> list[str]:
        m = self.model
        return [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]

    def boundaries_hold(self) -> bool:
        """No vocabulary string holds a space mark after another character, so no merge crosses such a place."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces())

    def marks_only(self) -> bool:
        """The normaliser leaves characters as they are, keeps all spaces and adds one mark in front."""
        probe = "  ﬁ AÅ①  b\n\tc "
        return self.model.normalize(probe) == SPACE + probe.replace(" ", SPACE)

    def whole_tokens(self) -> frozenset[str]:
        """Strings that encode alone, with the mark in front, as exactly one token."""
        words = [p[1:] for p in self.pieces() if p[0] == SPACE and len(p) > 1 and SPACE not in p[1:]]
        return frozenset(w for w, ids in zip(words, self.model.encode(words, num_threads=1)) if len(ids) == 1)

    def merge(self, unit: str) -> int:
        return len(self.model.encode(unit)) if unit else 1  # a lone mark is one token

    def unit(self, unit: str) -> int:
        if unit in self.whole:
            return 1
        n = self.memo.get(unit)
        if n is None:
            n = self.merge(unit)
            if len(unit) <= self.memo_chars:
                if len(self.memo) >= self.memo_size:
                    self.memo.clear()
                self.memo[unit] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.split:
            return len(self.model.encode(text))
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            units = [u[1:] for u in UNITS.findall(" " + text)]
        else:
            units = text.split(" ")
        memo, whole = self.memo, self.whole
        total = 0
        for u in units:
            if u in whole:
                total += 1
            else:
                n = memo.get(u)
                total += self.unit(u) if n is None else n
        return total


@lru_cache(maxsize=4)
def counter(model_path: str) -> Counter:
    return Counter(model_path)


def with_token_counts(docs: DataFrame, model_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text`` in ``out``. Every executor must find ``model_path``."""

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        c = counter(model_path)
        return pd.Series([c.count(t) for t in texts], dtype="int64")

    return docs.withColumn(out, count(F.col(f"`{text}`")))
