"""Probability-Jaccard signatures (ProbMinHash) of weighted shingles.

A text's shingles are its five-word windows, weighted by how often they
occur.  Every shingle is a Poisson process whose rate is its weight; each
arrival falls on a random one of the signature's components, which keeps the
shingle of its earliest arrival.  Two texts agree in a component with
probability equal to their probability Jaccard

    J_P = sum over common d of 1 / sum over d' of max(a(d')/a(d), b(d')/b(d)).

A text's processes stop as soon as they have passed the latest of its
components' arrivals (early termination).  Arrivals of all texts of a chunk
are drawn at once in numpy, in batches that double in length while a batch
stays below ``CELLS`` arrivals.  A text of one shingle needs no draw: its
signature is that shingle.
"""

from __future__ import annotations

import numpy as np

from bundlelake.llm.textnum import Rolling, is_space, mix64, spans, windows

WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST_BATCH = 256
CELLS = 1 << 18  # arrivals drawn at once (more only for the first of each shingle of a very long text)


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """(text, shingle hash, weight) of a chunk, sorted by text and hash.  A
    text of fewer words has one shingle, of all its words; one without words
    has none."""
    n = offsets.size - 1
    starts, ends, owner = spans(~is_space(raw), offsets)
    hashes = Rolling(raw).of(starts, ends)
    count = np.bincount(owner, minlength=n)[owner]
    found = [(h, owner[first]) for h, first in [windows(hashes, owner, words)]]
    for k in range(1, words):
        short = count == k
        h, first = windows(hashes[short], owner[short], k)
        found.append((h, owner[short][first]))
    key, text = (np.concatenate(x) for x in zip(*found))
    key = key >> np.uint64(32)  # 32 bits: what verification compares, too
    both = (text.astype(np.uint64) << np.uint64(32)) | key
    both, weight = np.unique(both, return_counts=True)
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32), weight


def signatures(text: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """(n, size) uint32: the shingle of the earliest arrival in each
    component; rows of texts without shingles are 0."""
    best = np.full(n * size, np.inf)
    out = np.zeros(n * size, np.uint32)
    has = np.zeros(n, bool)
    has[text] = True
    alone = np.bincount(text, minlength=n)[text] == 1
    out.reshape(n, size)[text[alone]] = key[alone][:, None]
    seed = mix64(key.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + _STEP)
    time = np.zeros(key.size)
    live = np.flatnonzero(~alone)
    done, batch = 0, 1
    while live.size:
        steps = np.arange(done + 1, done + batch + 1, dtype=np.uint64) * _STEP
        draw = mix64(seed[live][:, None] + steps[None, :])
        gap = -np.log((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weight[live][:, None]
        at = time[live][:, None] + np.cumsum(gap, axis=1)
        time[live] = at[:, -1]
        cell = text[live][:, None] * size + (mix64(draw) >> np.uint64(32)).astype(np.int64) % size
        cell, at, who = cell.ravel(), at.ravel(), np.repeat(live, batch)
        better = at < best[cell]
        cell, at, who = cell[better], at[better], who[better]
        order = np.lexsort((at, cell))
        cell, at, who = cell[order], at[order], who[order]
        head = np.ones(cell.size, bool)
        head[1:] = cell[1:] != cell[:-1]
        best[cell[head]], out[cell[head]] = at[head], key[who[head]]
        # a process that has passed its text's latest component is over
        latest = best.reshape(n, size).max(axis=1)
        live = live[time[live] < latest[text[live]]]
        done += batch
        batch = max(1, min(batch * 2, _LAST_BATCH, CELLS // max(1, live.size)))
    return out.reshape(n, size) * has[:, None]


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """(n, bands) int64: a hash of each band's rows and number."""
    n, size = sig.shape
    bands = size // rows
    part = sig[:, :bands * rows].reshape(n, bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (n, bands)).copy()
    for j in range(rows):
        h = mix64(h * np.uint64(3) + part[:, :, j] + _STEP)
    return h.view(np.int64)


def probability_jaccard(a_key: np.ndarray, a_weight: np.ndarray, b_key: np.ndarray, b_weight: np.ndarray) -> float:
    """Exact J_P of two weighted sets (keys sorted), in n log n steps."""
    if not a_key.size or not b_key.size:
        return 0.0
    _, ia, ib = np.intersect1d(a_key, b_key, assume_unique=True, return_indices=True)
    if not ia.size:
        return 0.0
    a, b = a_weight[ia].astype(float), b_weight[ib].astype(float)
    ratio = b / a
    order = np.argsort(ratio, kind="stable")
    sorted_ratio = ratio[order]
    # elements of a alone have ratio 0, of b alone infinity
    a_up_to = np.concatenate([[0.0], np.cumsum(a[order])]) + (a_weight.sum() - a.sum())
    b_from = np.concatenate([np.cumsum(b[order][::-1])[::-1], [0.0]]) + (b_weight.sum() - b.sum())
    cut = np.searchsorted(sorted_ratio, ratio, "right")
    total = (a_up_to[cut] + b_from[cut] / ratio) / a
    return float((1.0 / total).sum())
