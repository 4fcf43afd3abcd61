"""Quality rules by repetition coverage.

Rolling hashes of the words and of windows of several lengths are computed
in numpy for a whole Arrow batch; a window is duplicated if its 64-bit hash
occurs twice or more in the text, and the measure is the share of word characters
inside duplicated windows and lines.  No shuffle.

Defined cases: a null, empty or blank text has no words (all figures 0,
``base_failed`` true); repeated rows are judged each on its own; a text is
judged whole, however long; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bundlelake.llm.textnum import Rolling, is_space, keyed, spans, text_chunks, windows

# Most percent of the word characters inside duplicated windows of n words
# (the published repetition rules for web text).
MOST_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MOST_LINES, MOST_LINE_CHARS = 30, 20
MIN_WORDS, MOST_REPEAT_WORDS = 50, 50
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)

COLUMNS = (["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
           + [f"dup{n}_chars" for n in MOST_PERCENT] + ["n_lines", "dup_line_chars"])


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def _grouped(owner: np.ndarray, hashes: np.ndarray):
    """The items whose (owner, hash) may occur twice or more, equal ones side
    by side in their order, and which equal the one before.  The short keys
    of one plain sort only find candidates; whole hashes decide."""
    keys = keyed(owner, hashes)
    order = np.argsort(keys)
    met = keys[order][1:] == keys[order][:-1]
    near = np.zeros(keys.size, bool)
    near[order[1:][met]] = True
    near[order[:-1][met]] = True
    at = np.flatnonzero(near)
    at = at[np.lexsort((hashes[at], owner[at]))]
    return at, (owner[at][1:] == owner[at][:-1]) & (hashes[at][1:] == hashes[at][:-1])


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which items occur twice or more in their text."""
    at, same = _grouped(owner, hashes)
    hit = np.zeros(hashes.size, bool)
    hit[at[1:][same]] = True
    hit[at[:-1][same]] = True
    return hit


def _later(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which items their text has had before."""
    at, same = _grouped(owner, hashes)
    hit = np.zeros(hashes.size, bool)
    hit[at[1:][same]] = True
    return hit


def _covered(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which words are inside a window of n words that is repeated."""
    h, first = windows(hashes, owner, n)
    delta = np.zeros(hashes.size + 1, np.int64)
    if first.size:
        starts = first[_repeated(owner[first], h)]
        delta[starts] += 1
        np.subtract.at(delta, starts + n, 1)
    return np.cumsum(delta[:-1]) > 0


def measure(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of every text of a chunk."""
    n = offsets.size - 1
    rolling = Rolling(raw)
    starts, ends, owner = spans(~is_space(raw), offsets)
    points = np.zeros(raw.size + 1, np.int64)  # code points up to each byte
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    hashes = rolling.of(starts, ends)
    symbol = np.flatnonzero(np.isin(raw, SYMBOLS))
    out = {"n_words": np.bincount(owner, minlength=n).astype(np.int64), "word_chars": _per_text(chars, owner, n),
           "n_symbols": np.bincount(np.searchsorted(offsets, symbol, "right") - 1, minlength=n).astype(np.int64),
           "n_repeat_words": _per_text(_covered(hashes, owner, 3), owner, n)}
    for k in MOST_PERCENT:
        out[f"dup{k}_chars"] = _per_text(chars * _covered(hashes, owner, k), owner, n)
    # lines with a word; word characters before each byte give a line's share
    ls, le, lo = spans(raw != 10, offsets)
    word_at = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    full = np.flatnonzero(word_at[1] > word_at[0])
    ls, le, lo = ls[full], le[full], lo[full]
    up_to = np.concatenate([[0], np.cumsum(chars)])
    line_chars = up_to[word_at[1][full]] - up_to[word_at[0][full]]
    later = _later(lo, rolling.of(ls, le))
    out |= {"n_dup_lines": _per_text(later, lo, n), "n_lines": np.bincount(lo, minlength=n).astype(np.int64),
            "dup_line_chars": _per_text(line_chars * later, lo, n)}
    return out


def verdict(f: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept), in whole numbers."""
    base = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MOST_REPEAT_WORDS * f["n_words"])
    bad = (100 * f["n_dup_lines"] > MOST_LINES * f["n_lines"]) | (100 * f["dup_line_chars"] > MOST_LINE_CHARS * f["word_chars"])
    for k, most in MOST_PERCENT.items():
        bad |= 100 * f[f"dup{k}_chars"] > most * f["word_chars"]
    return base, ~base & ~bad


def repetition(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the figures, ``base_failed`` and ``kept``."""

    def run(batches):
        for batch in batches:
            parts = [measure(raw, offsets) for _, raw, offsets in text_chunks(batch.column(1))]
            if not parts:
                continue
            f = {c: np.concatenate([p[c] for p in parts]) for c in COLUMNS}
            base, kept = verdict(f)
            cols = [batch.column(0)] + [pa.array(f[c]) for c in COLUMNS] + [pa.array(base), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, *COLUMNS, "base_failed", "kept"])

    src = df.select(id_col, text_col)
    kind = src.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COLUMNS) + ", base_failed boolean, kept boolean"
    return src.mapInArrow(run, schema)
