"""Quality classifier by Bradley-Terry pairwise ranking.

Documents get scores such that a preferred one beats the other with the
logistic probability of the score difference; the weights over surface
features are fitted to preference pairs (a good label against a bad one) by
Newton steps on the logistic loss of feature differences.  The cut is a
quantile of the labelled rows' scores: the share of bad labels.

Defined cases: a null, empty or wordless text has all-zero features and is
scored like any other; repeated rows are scored alike; texts are read whole;
with no labelled rows, or labels of one kind only, the weights are 0 and
every score is the cut's; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.labelled import held_out, labels_known, training_rows
from bundlelake.llm.repetition import SYMBOLS, _covered
from bundlelake.llm.rows import kept
from bundlelake.llm.textnum import Rolling, is_space, keyed, spans, text_chunks
from bundlelake.session import scratch_path

CUT = 0.3            # score at the quantile
PAIRS_PER_ROW = 8    # rivals drawn for each row
RIDGE, STEPS, SMALL_STEP = 1e-3, 25, 1e-12
BUCKET, RARER = 20_000, 100  # rows that draw rivals among themselves; at least so many of the rarer label are due to each
PAIRS_AT_ONCE, BINS, LOOKED_AT = 100_000, 1024, 10_000

NAMES = ["log_words", "word_length", "symbols", "exclamations", "digits", "upper", "wide", "marks", "line_breaks",
         "distinct", "echo", "repeat3", "dup_lines", "short_words", "top_run"]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; CUT exactly at the quantile."""
        z = self.raw(x) - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, features): rates of characters, words, lines and repeats.
    Square roots spread the small rates apart."""
    n = offsets.size - 1
    count = lambda where: np.add.reduceat(np.append(where, False).astype(np.int64), offsets[:-1]) * (offsets[1:] > offsets[:-1])
    starts, ends, owner = spans(~is_space(raw), offsets)
    h = Rolling(raw).of(starts, ends)
    per = lambda v: np.bincount(owner, weights=v, minlength=n)
    words, size = per(np.ones(owner.size)), np.maximum(per(ends - starts), 1)
    w = np.maximum(words, 1)
    keys = keyed(owner, h)
    distinct = np.bincount((np.unique(keys) >> np.uint64(40)).astype(np.int64), minlength=n)
    again = np.zeros(keys.size)
    again[1:] = keys[1:] == keys[:-1]
    ls, le, lo = spans(raw != 10, offsets)
    line = keyed(lo, Rolling(raw).of(ls, le))
    lines = np.bincount(lo, minlength=n)
    own_lines = np.bincount((np.unique(line) >> np.uint64(40)).astype(np.int64), minlength=n)
    root = lambda part, whole: np.sqrt(np.minimum(part / whole, 4.0))
    letters = np.maximum(count(((raw | 32) >= 97) & ((raw | 32) <= 122)), 1)
    # the longest run of one word, next to next
    heads = np.flatnonzero(again == 0)
    longest = np.zeros(n)
    np.maximum.at(longest, owner[heads], np.diff(np.append(heads, owner.size)))
    return np.column_stack([
        np.log1p(words), np.log1p(size / w), root(count(np.isin(raw, SYMBOLS)), w), root(count(raw == 33), w),
        root(count((raw >= 48) & (raw <= 57)), size), root(count((raw >= 65) & (raw <= 90)), letters),
        root(count(raw >= 0xC0), size), root(count((raw == 44) | (raw == 46)), w), root(count(raw == 10), w),
        np.log1p(distinct) / np.log1p(w), root(per(again), w), root(per(_covered(h, owner, 3)), w),
        root(lines - own_lines, np.maximum(lines, 1)), root(per((ends - starts) <= 2), w), np.log1p(longest)])


def _moments(x, y, bucket):
    return [len(x), (y == 1).sum(), (y == 0).sum(), *x.sum(0)]


def _deviations(mean):
    return lambda x, y, bucket: [*((x - mean) ** 2).sum(0)]


def _newton(model: Model, seed: int):
    """Number of pairs, gradient and Hessian over the pairs of one bucket:
    each row meets rivals of the other label drawn from its bucket."""
    def of(x, y, bucket):
        d = x.shape[1]
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        n, grad, hess = 0, np.zeros(d), np.zeros((d, d))
        if good.size and bad.size:
            z = (x - model.mean) / model.scale
            rng = np.random.default_rng(seed + bucket)
            first = np.concatenate([np.repeat(good, PAIRS_PER_ROW), rng.choice(good, bad.size * PAIRS_PER_ROW)])
            second = np.concatenate([rng.choice(bad, good.size * PAIRS_PER_ROW), np.repeat(bad, PAIRS_PER_ROW)])
            n = len(first)
            for at in range(0, n, PAIRS_AT_ONCE):
                diff = z[first[at:at + PAIRS_AT_ONCE]] - z[second[at:at + PAIRS_AT_ONCE]]
                p = 1 / (1 + np.exp(-np.clip(diff @ model.weights, -50, 50)))
                grad += diff.T @ (p - 1)
                hess += (diff * (p * (1 - p))[:, None]).T @ diff
        return [n, *grad, *hess.ravel()]

    return of


def _spread(model: Model, lo: float, hi: float):
    """Number, smallest and largest of the strengths from lo to below hi."""
    def of(x, y, bucket):
        s = model.raw(x)
        s = s[(s >= lo) & (s < hi)]
        return [s.size, s.min(initial=np.inf), s.max(initial=-np.inf)]

    return of


def _histogram(model: Model, edges: np.ndarray):
    def of(x, y, bucket):
        s = model.raw(x)
        s = s[(s >= edges[0]) & (s < edges[-1])]
        return [*np.bincount(np.searchsorted(edges, s, side="right") - 1, minlength=len(edges) - 1)]

    return of


def _between(model: Model, lo: float, hi: float):
    def of(x, y, bucket):
        s = model.raw(x)
        return [*s[(s >= lo) & (s < hi)]]

    return of


def _per_bucket(rows: DataFrame, of) -> list[np.ndarray]:
    """``of(features, labels, bucket)`` of every bucket, in their order; a
    bucket's rows are in the order of their ids."""
    def run(table):
        table = table.sort_by("doc_id")
        x = table["features"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, len(NAMES))
        bucket = table["bucket"][0].as_py()
        return pa.table({"bucket": pa.array([bucket], pa.int64()),
                         "v": pa.array([[float(v) for v in of(x, table["label"].to_numpy(), bucket)]], pa.list_(pa.float64()))})

    got = rows.groupBy("bucket").applyInArrow(run, "bucket long, v array<double>").collect()
    return [np.array(r["v"], float) for r in sorted(got, key=lambda r: r["bucket"])]


def _ranked(rows: DataFrame, model: Model, rank: int) -> float:
    """The strength of the given rank (from 0): counts in ever finer bins,
    until few enough strengths are left to be looked at."""
    lo, hi = -np.inf, np.inf
    while True:
        parts = np.array(_per_bucket(rows, _spread(model, lo, hi)))
        n, least, most = parts[:, 0].sum(), parts[:, 1].min(), parts[:, 2].max()
        if least == most:
            return float(least)
        if n <= LOOKED_AT:
            return float(np.sort(np.concatenate(_per_bucket(rows, _between(model, lo, hi))))[rank])
        edges = np.linspace(least, np.nextafter(most, np.inf), BINS + 1)
        upto = np.cumsum(np.sum(_per_bucket(rows, _histogram(model, edges)), axis=0))
        j = int(np.searchsorted(upto, rank, side="right"))
        rank -= int(upto[j - 1]) if j else 0
        lo, hi = edges[j], edges[j + 1]


def fit_pairs(rows: DataFrame, seed: int = 7) -> Model:
    """Bradley-Terry weights from pairs of rows ``(doc_id, label, features)``
    with unlike labels.  Every row takes part: rows lie in buckets by a hash
    of the id, each some ``BUCKET`` rows and with both labels, a bucket adds
    up its own pairs, and the driver adds up one gradient per bucket."""
    d = len(NAMES)
    one = rows.groupBy("label").count().collect()
    n, kinds = sum(r["count"] for r in one), {r["label"]: r["count"] for r in one}
    if not n:
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    rarer = min(kinds.get(0, 0), kinds.get(1, 0))
    buckets = max(1, min(-(-n // BUCKET), rarer // RARER if rarer else -(-n // BUCKET)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("long"))
    total = np.sum(_per_bucket(rows, _moments), axis=0)
    mean = total[3:] / n
    scale = np.maximum(np.sqrt(np.sum(_per_bucket(rows, _deviations(mean)), axis=0) / n), 1e-6)
    model = Model(mean, scale, np.zeros(d), 0.0)
    if not rarer:
        return model
    for _ in range(STEPS):
        total = np.sum(_per_bucket(rows, _newton(model, seed)), axis=0)
        w, pairs = model.weights, max(total[0], 1)
        grad, hess = total[1:d + 1] / pairs + RIDGE * w, total[d + 1:].reshape(d, d) / pairs + RIDGE * np.eye(d)
        step = np.linalg.solve(hess, grad)
        model = Model(mean, scale, w - step, 0.0)
        if np.abs(step).max() < SMALL_STEP:
            break
    k = kinds[0]  # the quantile at the share of bad rows, half-way between its neighbours
    return Model(mean, scale, model.weights, (_ranked(rows, model, k - 1) + _ranked(rows, model, k)) / 2)


def _featured(df: DataFrame, rest: list[str], schema: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for first, raw, offsets in text_chunks(b.column(1)):
                x = features(raw, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(first, len(x)) for i in (0, *range(2, b.num_columns))] + [lists],
                    names=["doc_id", *rest, "features"])

    return df.mapInArrow(run, schema)


def _training_features(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, features) of ``training_rows``, a repeated document once.

    Features are computed where the texts lie and written once: some 15
    numbers and a digest a document are shuffled, no text.  Only of a document
    that is there with unlike texts are the texts looked at again, for the one
    that ``training_rows`` takes."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    mine = docs.where(F.col("doc_id").isNotNull() & ~held_out())
    text = F.coalesce("text", F.lit(""))
    at = scratch_path(spark, "ranking-features")
    _featured(mine.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("digest")), ["digest"],
              f"doc_id {kind}, digest string, features array<double>").write.parquet(f"{at}/documents")
    once = spark.read.parquet(f"{at}/documents").groupBy("doc_id").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high"), F.first("features").alias("features"))
    once.where("low < high").select("doc_id").write.parquet(f"{at}/unlike")
    rows = once.where("low = high").join(labels_known(labels, label), "doc_id").select("doc_id", "label", "features")
    unlike = spark.read.parquet(f"{at}/unlike")
    if not unlike.isEmpty():
        texts = training_rows(docs.join(unlike, "doc_id", "left_semi"), labels, label)
        rows = rows.unionByName(_featured(texts, ["label"], f"doc_id {kind}, label int, features array<double>"))
    rows.write.parquet(f"{at}/labelled")
    return spark.read.parquet(f"{at}/labelled")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on every labelled document outside the held-out fold.  Features
    are written once; each pass reads some 15 numbers a document."""
    return fit_pairs(_training_features(docs, labels, label))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= CUT) of every row, and
    its Bradley-Terry strength.  One scan, no shuffle."""
    def run(batches):
        for b in batches:
            for first, raw, offsets in text_chunks(b.column(1)):
                x = features(raw, offsets)
                p = model.score(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(x)), b.column(2).slice(first, len(x)), pa.array(p),
                     pa.array((p >= CUT).astype(np.int32)), pa.array(model.raw(x))],
                    names=["doc_id", "held_out", "score", "predicted", "strength"])

    src = docs.select("doc_id", "text", held_out().alias("held_out"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, strength double")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` the model accepts, all columns as they were.
    The text is scored where it lies: no join, no shuffle."""
    def accept(texts):
        return np.concatenate([model.score(features(raw, offsets)) >= CUT for _, raw, offsets in text_chunks(texts)])

    return kept(docs, "text", accept)
