"""Token counts by byte-pair merging, without token identifiers.

A piece starts as its bytes, in a doubly linked list; a heap holds the
adjacent pairs by merge rank.  Popping the lowest rank joins two neighbours
and adds the pairs around the joined symbol.  The count of a piece is its
initial symbols minus its merges.  Pieces repeat a lot, so each worker keeps
a bounded memo of their counts.

Defined cases: null and empty texts have 0 tokens; the vocabulary's special
strings count one token each and split the text, as its library does by
default; long texts and long pieces are counted whole.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO_PIECES = 400_000  # per worker; the memo starts anew when it is full
MEMO_CHARS = 48        # longer pieces hardly repeat and are not kept

# Letters, digits and white space below U+0250, where every Unicode version
# agrees; other texts are split by the library's own pre-tokenizer.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
OTHER = re.compile("[ɐ-\U0010ffff]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    itself if printable, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def count_merged(symbols: str, ranks: dict) -> int:
    """Symbols left when no adjacent pair has a rank any more."""
    n = len(symbols)
    if n < 2:
        return n
    sym = list(symbols)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i in range(n - 1) if (r := ranks.get((a := sym[i], b := sym[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i] if sym[i] == a else n
        if j >= n or sym[j] != b:
            continue  # one of the two is part of a larger symbol by now
        sym[i], sym[j] = a + b, None
        k = nxt[i] = nxt[j]
        merges += 1
        if k < n:
            prv[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i, sym[i], sym[k]))
        h = prv[i]
        if h >= 0 and (r := ranks.get((sym[h], sym[i]))) is not None:
            heapq.heappush(heap, (r, h, sym[h], sym[i]))
    return n - merges


class _Memo(dict):
    """piece -> count; a missing one is merged and kept."""

    def __init__(self, ranks: dict):
        self.ranks, self.letters = ranks, byte_letters()

    def __missing__(self, piece: str) -> int:
        n = count_merged("".join([self.letters[b] for b in piece.encode()]), self.ranks)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = n
        return n


class Counter:
    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.memo = _Memo(self.ranks)
        self.split = Tokenizer.from_file(vocabulary).pre_tokenizer.pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def part(self, text: str) -> int:
        if OTHER.search(text):
            return sum(count_merged(p, self.ranks) for p, _ in self.split(text))
        return sum(map(self.memo.__getitem__, PIECES.findall(text)))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.part(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.part(p) for p in parts if p)


@lru_cache(maxsize=4)
def counter(vocabulary: str) -> Counter:
    """One per worker process and vocabulary."""
    return Counter(vocabulary)


def token_counts(df: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; no shuffle."""

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        count = counter(vocabulary)
        return pd.Series([count(t) for t in texts], dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return out.select(F.col(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
