"""Numpy views of Arrow string columns: word spans and rolling hashes of a
whole batch of texts at once, without a Python loop over rows or words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20  # text handled in one numpy step; one longer text is one step

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, bytes, offsets) for runs of rows of about ``limit``
    bytes.  A null text has no bytes, like an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off_buf, data = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def spans(inside: np.ndarray, offsets: np.ndarray):
    """Start, end and text index of the runs of ``inside`` bytes; a run ends
    with its text."""
    if not inside.size:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(inside.size + 1, bool)
    edge[offsets] = True
    before = np.empty(inside.size, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(inside.size, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(kind: str, n: int) -> np.ndarray:
    if _powers[kind].size < n:
        step = np.full(max(n, CHUNK_BYTES + 1), _BASE if kind == "up" else _BASE_INV, np.uint64)
        step[0] = 1
        _powers[kind] = np.multiply.accumulate(step)
    return _powers[kind]


class Rolling:
    """Polynomial rolling hash over a chunk's bytes: after one prefix sum,
    the hash of any span costs one subtraction and one product."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _power("up", raw.size)[:raw.size], out=self.sums[1:])
        self.down = _power("down", raw.size + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * _ODD)


def windows(hashes: np.ndarray, owner: np.ndarray, n: int):
    """Hashes of n consecutive items and the first item of each such window
    (windows do not cross owners)."""
    m = hashes.size - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:m].copy()
    for j in range(1, n):
        h *= _ODD
        h += hashes[j:m + j]
    first = np.flatnonzero(owner[:m] == owner[n - 1:])
    return mix64(h[first]), first


def keyed(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """40 hash bits below 24 bits of the text's index in its chunk: equal for
    equal items of one text, and one plain sort groups them.  Of some hundred
    thousand different items of a text, two may meet by chance; where counts
    must be exact, compare the whole hashes."""
    return (owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))


def lower_latin(raw: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case, byte by byte in UTF-8."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] |= 32
    if raw.size > 1:
        second = np.zeros(raw.size, bool)
        second[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[second] += 32
    return out
