"""Toxicity by multiple-instance learning.

A document is a bag of sentences; it is toxic if at least one of them is.
A sentence's probability, as a text on its own, is a logistic function of its
hashed words and word beginnings.  A document's is the noisy-or of one prior
(the bias) and of what each sentence's features add to it, so sentences
without any add nothing, however many; the weights, none below zero, are
fitted to the document labels by maximum likelihood.  The same weights then
point to the offending sentences.

Defined cases: a null, empty or wordless text is one empty sentence, so its
score is the bias's, as is that of any text without a feature; repeated rows are scored alike, each on its own; texts
are read whole; with no labelled rows, or labels of one kind only, every
score is the (smoothed) share of label 1; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.labelled import held_out, training_sample
from bundlelake.llm.rows import kept
from bundlelake.llm.textnum import Rolling, lower_latin, spans, text_chunks
from bundlelake.session import scratch_path

BITS = 18                    # hashed features
BEGINNINGS = (3, 4, 5, 6)    # bytes of a word's beginning that are features too
# screening of features: documents of label 1, times as common there, and the
# expected share of chance ones among those kept
MIN_POSITIVE, MIN_LIFT, FALSE_SHARE = 3, 4.0, 0.2
STEPS, RATE, SHRINK = 400, 0.3, 2e-4

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True  # line feed ! . ?


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # 2**BITS


def sentences(raw: np.ndarray, offsets: np.ndarray):
    """Sentence spans with their text, and the features of each word: an
    array (words, 1 + len(BEGINNINGS)), -1 where a word is too short, with
    the sentence of each word.  Every text has a sentence."""
    low = lower_latin(raw)
    s, e, owner = spans(~_END[low], offsets)
    ws, we, _ = spans(_WORD[low], offsets)
    of = np.searchsorted(s, ws, "right") - 1
    rolling, shift = Rolling(low), np.uint64(64 - BITS)
    size = we - ws
    feats = np.full((ws.size, 1 + len(BEGINNINGS)), -1, np.int64)
    feats[:, 0] = rolling.of(ws, we) >> shift
    for j, k in enumerate(BEGINNINGS, 1):
        long = size > k
        feats[long, j] = (rolling.of(ws[long], ws[long] + k) ^ np.uint64(0x5851F42D4C957F2D)) >> shift
    return (s, e, owner), (feats, of)


def _counts(batches):
    """Documents of each label in which a feature occurs, summed by task."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        y_all = b.column(2).to_numpy(zero_copy_only=False)
        for first, raw, offsets in text_chunks(b.column(1)):
            (_, _, owner), (feats, of) = sentences(raw, offsets)
            keys = np.unique(((owner[of].astype(np.int64) << BITS)[:, None] | np.maximum(feats, 0))[feats >= 0])
            y = y_all[first + (keys >> BITS)]
            for k in (0, 1):
                seen[k] += np.bincount(keys[y == k] & ((1 << BITS) - 1), minlength=1 << BITS)
    some = np.flatnonzero(seen[1])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[0][some]), pa.array(seen[1][some])],
                                     names=["feature", "neg", "pos"])


def _bags(keep: np.ndarray):
    def run(batches):
        for b in batches:
            for first, raw, offsets in text_chunks(b.column(1)):
                (_, _, owner), (feats, of) = sentences(raw, offsets)
                n = offsets.size - 1
                column = np.searchsorted(keep, feats)
                hit = (feats >= 0) & (keep[np.minimum(column, keep.size - 1)] == feats)
                pairs = np.unique(((of[:, None] * keep.size) + column)[hit])
                sent, feat = pairs // keep.size, pairs % keep.size
                doc = owner[sent] if sent.size else sent
                cut = np.searchsorted(doc, np.arange(n + 1))
                lists = lambda v: pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(v.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(2).slice(first, n).cast(pa.int32()), lists(sent), lists(feat)],
                    names=["label", "sent", "feat"])
    return run


def _softplus(z):
    return np.logaddexp(0.0, z)


def fit_bags(bags: pd.DataFrame, n_features: int) -> tuple[float, np.ndarray]:
    """Noisy-or maximum likelihood by Adagrad over the whole (bounded) sample."""
    y = bags["label"].to_numpy()
    size = bags["sent"].map(len).to_numpy()
    doc = np.repeat(np.arange(len(y)), size)
    sent = np.concatenate([*bags["sent"], np.zeros(0, int)]).astype(np.int64)
    feat = np.concatenate([*bags["feat"], np.zeros(0, int)]).astype(np.int64)
    key, at = np.unique((doc << 32) | sent, return_inverse=True)
    s_doc = key >> 32
    found = np.bincount(s_doc, minlength=len(y))  # sentences with a kept feature
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(share) - 2)
    w = np.zeros(n_features)
    gw, gb = np.full(n_features, 1e-8), 1e-8
    n = len(y)
    for _ in range(STEPS):
        z = bias + np.bincount(at, weights=w[feat], minlength=key.size)
        total = _softplus(bias) + np.bincount(s_doc, weights=_softplus(z) - _softplus(bias), minlength=n)
        # d loss / d total: 1 for label 0, -1 / (e^total - 1) for label 1
        d = np.where(y == 1, -1.0 / np.expm1(np.clip(total, 1e-9, 50)), 1.0) / n
        slope = d[s_doc] / (1 + np.exp(-z))
        g = np.bincount(feat, weights=slope[at], minlength=n_features)
        b = slope.sum() + (d * (1 - found)).sum() / (1 + np.exp(-bias))
        gw += g * g
        gb += b * b
        step = RATE / np.sqrt(gw)
        w = w - step * g
        w = np.maximum(w - step * SHRINK / n ** 0.5, 0)
        bias -= RATE / np.sqrt(gb) * b
    return bias, w


def screened(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Which features, by their documents of each label, are far more common
    under label 1, by more than chance: Benjamini and Hochberg's rule over
    Chernoff's bound on the binomial tail, so what a feature needs does not
    grow with the number of labels."""
    both, share = np.maximum(pos + neg, 1), n_pos / (n_pos + n_neg)
    term = lambda k, of: k * np.log(np.maximum(k, 1) / (both * of))
    chance = np.where(pos > share * both, np.exp(-term(pos, share) - term(neg, 1 - share)), 1.0)
    ranked = np.sort(chance[pos + neg >= MIN_POSITIVE])
    low = np.flatnonzero(ranked <= FALSE_SHARE * np.arange(1, ranked.size + 1) / max(1, ranked.size))
    most = ranked[low[-1]] if low.size else -1.0
    return (pos >= MIN_POSITIVE) & (pos / n_pos > MIN_LIFT * (neg + 1) / n_neg) & (chance <= most)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on the bounded sample of :func:`training_sample`.  Counting and
    feature extraction run in tasks; the driver gets the feature counts (at
    most 2**BITS rows) and, per sampled document, its kept features."""
    spark = docs.sparkSession
    at = scratch_path(spark, "toxicity-sample")
    # copies of one text are one bag, with the label of most of them
    sample = training_sample(docs, labels, label).groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.avg("label").alias("label"))
    sample.select("doc_id", "text", (F.col("label") >= 0.5).cast("int").alias("label")).write.parquet(at)
    rows = spark.read.parquet(at)
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    flat = np.zeros(1 << BITS, np.float32)
    prior = float(np.log((pos + 0.5) / (neg + 0.5)))
    if not pos or not neg:
        return Model(prior, flat)
    counts = (rows.mapInArrow(_counts, "feature long, neg long, pos long").groupBy("feature")
              .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toPandas())
    keep = np.sort(counts["feature"].to_numpy()[screened(counts["pos"].to_numpy(), counts["neg"].to_numpy(), pos, neg)])
    if not keep.size:
        return Model(prior, flat)
    bags = rows.mapInArrow(_bags(keep), "label int, sent array<int>, feat array<int>").toPandas()
    bias, w = fit_bags(bags, keep.size)
    flat[keep] = w
    return Model(bias, flat)


def score_chunk(model: Model, raw: np.ndarray, offsets: np.ndarray):
    """Per text: noisy-or score, number of sentences of probability 0.5 or
    more, and byte span and probability of the likeliest sentence."""
    n = offsets.size - 1
    (s, e, owner), (feats, of) = sentences(raw, offsets)
    gain = np.where(feats >= 0, model.weights[np.maximum(feats, 0)], 0)
    z = np.full(s.size, model.bias)
    if of.size:
        # a feature counts once in a sentence, as in training
        some = np.flatnonzero(gain.ravel())
        sent, value = np.repeat(of, feats.shape[1])[some], feats.ravel()[some]
        _, first = np.unique((sent << BITS) | value, return_index=True)
        z += np.bincount(sent[first], weights=gain.ravel()[some][first], minlength=s.size)
    more = np.where(z > model.bias, _softplus(z) - _softplus(model.bias), 0.0)  # nothing where no feature is found
    total = _softplus(model.bias) + np.bincount(owner, weights=more, minlength=n)
    p = 1 / (1 + np.exp(-z))
    order = np.lexsort((np.arange(s.size), -z, owner))
    lead = order[np.searchsorted(owner[order], np.arange(n))] if s.size else np.zeros(n, np.int64)
    has = np.bincount(owner, minlength=n) > 0
    pick = lambda v: np.where(has, v[lead] if s.size else 0, 0)
    begin = pick(s - offsets[owner]) if s.size else np.zeros(n, np.int64)
    end = pick(e - offsets[owner]) if s.size else np.zeros(n, np.int64)
    worst = pick(p) if s.size else np.zeros(n)
    return -np.expm1(-total), np.bincount(owner, weights=p >= 0.5, minlength=n).astype(np.int64), begin, end, worst


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_flagged (sentences), and the
    likeliest sentence: text, probability.  One scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def run(batches):
        m = shared.value
        for b in batches:
            texts = b.column(1)
            for first, raw, offsets in text_chunks(texts):
                p, flagged, begin, end, worst = score_chunk(m, raw, offsets)
                data = raw.tobytes()
                worst_text = [data[offsets[i] + begin[i]:offsets[i] + end[i]].decode("utf-8", "replace").strip()
                              for i in range(len(p))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(p)), b.column(2).slice(first, len(p)), pa.array(p),
                     pa.array((p >= 0.5).astype(np.int32)), pa.array(flagged), pa.array(worst_text, pa.string()), pa.array(worst)],
                    names=["doc_id", "held_out", "score", "predicted", "n_flagged", "worst_sentence", "worst_score"])

    src = docs.select("doc_id", "text", held_out().alias("held_out"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_flagged long, "
                               "worst_sentence string, worst_score double")


def offending_sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Every sentence of probability ``least`` or more: doc_id, its place in
    the text in bytes, its text and probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            for first, raw, offsets in text_chunks(b.column(1)):
                (s, e, owner), (feats, of) = sentences(raw, offsets)
                if not s.size:
                    continue
                pairs = np.unique((np.repeat(of, feats.shape[1]) << BITS | feats.ravel())[feats.ravel() >= 0])
                z = m.bias + np.bincount(pairs >> BITS, weights=m.weights[pairs & ((1 << BITS) - 1)], minlength=s.size)
                p = 1 / (1 + np.exp(-z))
                hit = np.flatnonzero(p >= least)
                data = raw.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(first + owner[hit])), pa.array(s[hit] - offsets[owner[hit]]),
                     pa.array([data[s[i]:e[i]].decode("utf-8", "replace").strip() for i in hit], pa.string()), pa.array(p[hit])],
                    names=["doc_id", "start", "sentence", "probability"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, start long, sentence string, probability double")


def keep(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored under ``below``, all columns as they were.
    The text is scored where it lies: no join, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(texts):
        return np.concatenate([score_chunk(shared.value, raw, offsets)[0] < below for _, raw, offsets in text_chunks(texts)])

    return kept(docs, "text", accept)
