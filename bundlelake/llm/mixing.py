"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) with token totals.
Raking finds a factor per source, per language and per topic such that the
expected tokens under the keeping probabilities min(1, product of the three)
meet all three sets of target totals.  The driver holds the language by
topic table only (its size is checked); sources are rows, each with its
cells, and their factors are solved where they lie.  Each sweep is one Spark
job over the written cell table.

Tokens are those of a vocabulary (a file for ``packing.encoder``); without
one, white-space separated words, by which a text in a script without spaces
weighs next to nothing.

Targets: a side's value of t tokens weighs t ** exponent (or a given share);
totals are capped at what there is and the rest goes to the others.  Where
the three sides exclude each other, the sources' totals are met and the
others as nearly as the sweeps get.

Defined cases: a null source or language is the value ``(none)``; a null or
empty text has 0 tokens and the probability of its cell; a source without
tokens is kept whole; a text without long words has topic ``t0``; rows equal
in id and text are drawn alike; an empty table gives no rows; ``keep``
carries other columns as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from bundlelake.llm.packing import encoder
from bundlelake.llm.rows import column, column_of, packed, schema
from bundlelake.llm.textnum import Rolling, is_space, keyed, spans, text_chunks
from bundlelake.session import scratch_path

TOPICS, LONG_WORD = 8, 6      # topics; bytes of a word that may name one
NONE = "(none)"
MAX_TABLE = 100_000           # languages x topics the driver may hold
SWEEPS, STALLED = 60, 4       # sweeps at most; and without progress (targets that exclude each other)
CLOSE, STRIDE = 1e-4, 4.0     # relative error at the end; most a sweep changes a factor by


@dataclass(frozen=True)
class Mix:
    budget: float = 0.75      # share of all tokens to keep
    exponents: dict = field(default_factory=lambda: {"source": 0.5, "lang": 0.7, "topic": 0.5})
    shares: dict = field(default_factory=dict)  # side -> {value: share}, instead of the exponent's
    seed: int = 1


def describe(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, topic) of each text.  The topic is the bucket of the text's
    most frequent long word (ties: the smallest hash)."""
    n = offsets.size - 1
    starts, ends, owner = spans(~is_space(raw), offsets)
    long = ends - starts >= LONG_WORD
    words, count = np.unique(keyed(owner[long], Rolling(raw).of(starts[long], ends[long])), return_counts=True)
    who = (words >> np.uint64(40)).astype(np.int64)
    order = np.lexsort((words, -count, who))
    head = np.ones(order.size, bool)
    head[1:] = who[order][1:] != who[order][:-1]
    topic = np.zeros(n, np.int64)
    topic[who[order][head]] = (words[order][head] % np.uint64(TOPICS)).astype(np.int64)
    return np.bincount(owner, minlength=n).astype(np.int64), topic


def token_counts(raw: np.ndarray, offsets: np.ndarray, vocabulary: str, at_once: int = 64) -> np.ndarray:
    """Tokens of each text; ids of ``at_once`` texts are held at a time."""
    encode, text = encoder(vocabulary), raw.tobytes()
    cut = [(text[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return np.array([x.size for s in range(0, len(cut), at_once) for x in encode(cut[s:s + at_once])], np.int64)


def _described(docs: DataFrame, text_col: str, vocabulary: str | None) -> DataFrame:
    """(row, n_tokens, topic): every row of ``docs`` as a struct."""
    def chunk(raw, offsets):
        words, topic = describe(raw, offsets)
        return (token_counts(raw, offsets, vocabulary) if vocabulary else words), topic

    def run(batches):
        for b in batches:
            found = [chunk(raw, offsets) for _, raw, offsets in text_chunks(column_of(b, text_col))]
            if found:
                n, topic = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array([f"t{x}" for x in topic])],
                                                 names=["row", "n_tokens", "topic"])

    return packed(docs).mapInArrow(run, schema(docs, StructField("n_tokens", LongType()), StructField("topic", StringType())))


def _side(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NONE))


def _fill(have: np.ndarray, weight: np.ndarray, total: float) -> np.ndarray:
    """min(have, x * weight) with x such that they add up to ``total``."""
    want, free = np.zeros(len(have)), (have > 0) & (weight > 0)
    left = total
    while free.any() and left > 0:
        give = np.where(free, weight, 0) / weight[free].sum() * left
        full = free & (want + give >= have)
        if not full.any():
            return want + give
        left -= (have - want)[full].sum()
        want[full] = have[full]
        free &= ~full
    return want


def _source_factor(n: np.ndarray, g: np.ndarray, target: float) -> float:
    """a with sum of n * min(1, a * g) = target."""
    total = n.sum()
    if total <= 0 or target >= total:
        return np.inf
    order = np.argsort(-g, kind="stable")
    n, g = n[order], g[order]
    full = np.concatenate([[0.0], np.cumsum(n)[:-1]])        # the first k cells are kept whole
    rest = np.cumsum((n * g)[::-1])[::-1]
    a = (target - full) / np.maximum(rest, 1e-300)
    return float(a[np.flatnonzero(a * g <= 1 + 1e-12)[0]])


def _sweep(b: np.ndarray, c: np.ndarray):
    """Expected tokens by (language, topic) under factors b and c: of cells
    kept whole, and of the others, which follow the factors."""
    def run(batches):
        whole, free = np.zeros((len(b), len(c))), np.zeros((len(b), len(c)))
        for batch in batches:
            for target, ls, ts, ns in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ls, ts, ns = np.array(ls), np.array(ts), np.array(ns, float)
                g = np.maximum(b[ls] * c[ts], 1e-300)
                p = np.minimum(1, _source_factor(ns, g, target) * g)
                np.add.at(whole, (ls, ts), np.where(p < 1, 0, ns))
                np.add.at(free, (ls, ts), np.where(p < 1, ns * p, 0))
        ls, ts = np.nonzero(whole + free)
        yield pa.RecordBatch.from_arrays([pa.array(ls), pa.array(ts), pa.array(whole[ls, ts]), pa.array(free[ls, ts])],
                                         names=["l", "t", "whole", "free"])
    return run


def _adjust(goal: np.ndarray, whole: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Factors on the free tokens that meet the goal; where the whole ones
    exceed it, by proportion."""
    now = np.maximum(whole + free, 1e-9)
    return np.where((goal > whole) & (free > 0), (goal - whole) / np.maximum(free, 1e-9), goal / now)


def _probabilities(b: np.ndarray, c: np.ndarray, langs: list[str], topics: list[str]):
    def run(batches):
        for batch in batches:
            out = []
            for source, target, ls, ts, ns in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ls, ts, ns = np.array(ls), np.array(ts), np.array(ns, float)
                g = np.maximum(b[ls] * c[ts], 1e-300)
                p = np.minimum(1, _source_factor(ns, g, target) * g)
                out += [(source, langs[i], topics[j], float(x)) for i, j, x in zip(ls, ts, p)]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], pa.string()) for i in range(3)] + [pa.array(cols[3], pa.float64())],
                                             names=["source", "lang", "topic", "probability"])
    return run


def rake(cells: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, lang, topic, tokens) cells -> (source, lang, topic,
    probability), written to the shared folder."""
    spark = cells.sparkSession
    at = scratch_path(spark, "mixing-cells")
    cells.write.parquet(at)
    cells = spark.read.parquet(at)
    sides, have = {}, {}
    for side in ("lang", "topic"):
        rows = cells.groupBy(side).agg(F.sum("tokens").alias("n")).orderBy(side).limit(MAX_TABLE + 1).collect()
        sides[side], have[side] = [r[side] for r in rows], np.array([r["n"] for r in rows], float)
    if len(sides["lang"]) * len(sides["topic"]) > MAX_TABLE:
        raise ValueError("too many languages and topics for the driver's table")
    # sources: how much budget fits under their caps, from totals by size class
    number = {s: {v: i for i, v in enumerate(sides[s])} for s in sides}
    index = lambda s: (F.create_map(*[F.lit(x) for kv in number[s].items() for x in kv])[F.col(s)] if number[s]
                       else F.lit(0))
    cell = F.sort_array(F.collect_list(F.struct(index("lang").alias("l"), index("topic").alias("t"), F.col("tokens").alias("n"))))
    sources = cells.groupBy("source").agg(F.sum("tokens").alias("total"), cell.alias("cells"))
    given = mix.shares.get("source", {})
    weight = F.pow(F.col("total").cast("double"), F.lit(float(mix.exponents["source"])))
    if given:
        share = F.create_map(*[x for k, v in given.items() for x in (F.lit(k), F.lit(float(v)))])
        weight = F.coalesce(F.try_element_at(share, F.col("source")) * F.lit(float(have["lang"].sum())), weight)
    sources = sources.withColumn("weight", F.when(F.col("total") > 0, weight).otherwise(0.0))
    at = scratch_path(spark, "mixing-sources")
    sources.write.parquet(at)
    sources = spark.read.parquet(at)
    level = F.round(F.log2(F.col("total") / F.col("weight")) * 16)
    classes = (sources.where("total > 0 and weight > 0").groupBy(level.alias("level"))
               .agg(F.sum("total").alias("n"), F.sum("weight").alias("w")).collect())
    n, w = np.array([r["n"] for r in classes], float), np.array([r["w"] for r in classes], float)
    filled = _fill(n, w, mix.budget * n.sum())
    free = filled < n
    x = (filled[free] / w[free]).max() if free.any() else np.inf
    sources = sources.withColumn("target", F.least(F.col("total").cast("double"), F.col("weight") * F.lit(float(x)))
                                 if np.isfinite(x) else F.col("total").cast("double"))
    budget = float(sources.agg(F.sum("target")).first()[0] or 0.0)
    goal = {}
    for side in ("lang", "topic"):
        powers = have[side] ** mix.exponents[side]
        fixed = mix.shares.get(side, {})
        goal[side] = _fill(have[side], np.array([fixed.get(v, None) * have[side].sum() if v in fixed else p
                                                 for v, p in zip(sides[side], powers)]), budget)
    b, c = np.ones(len(sides["lang"])), np.ones(len(sides["topic"]))
    lists = sources.select("target", "cells.l", "cells.t", "cells.n")
    best, since = (np.inf, b, c), 0
    for _ in range(SWEEPS if b.size else 0):
        whole, free = np.zeros((b.size, c.size)), np.zeros((b.size, c.size))
        for r in (lists.mapInArrow(_sweep(b, c), "l long, t long, whole double, free double").groupBy("l", "t")
                  .agg(F.sum("whole").alias("whole"), F.sum("free").alias("free")).collect()):
            whole[r["l"], r["t"]], free[r["l"], r["t"]] = r["whole"], r["free"]
        off = max(np.abs((whole + free).sum(1 - i) - goal[s])[goal[s] > 0].max(initial=0) / max(goal[s].max(initial=0), 1e-9)
                  for i, s in enumerate(("lang", "topic")))
        since = 0 if off < 0.99 * best[0] else since + 1
        best = min(best, (off, b, c), key=lambda x: x[0])
        if off < CLOSE or since == STALLED:
            break
        db, dc = np.ones(b.size), np.ones(c.size)
        for _ in range(20):  # the two small sides are raked against this sweep's table
            db = _adjust(goal["lang"], whole.sum(1), (free * dc).sum(1))
            dc = _adjust(goal["topic"], whole.sum(0), (free * db[:, None]).sum(0))
        b, c = b * np.clip(db, 1 / STRIDE, STRIDE), c * np.clip(dc, 1 / STRIDE, STRIDE)
        b, c = np.clip(b / b.max(), 1e-12, None), np.clip(c / c.max(), 1e-12, None)
    _, b, c = best
    at = scratch_path(spark, "mixing-probabilities")
    (sources.select("source", "target", "cells.l", "cells.t", "cells.n")
     .mapInArrow(_probabilities(b, c, sides["lang"], sides["topic"]), "source string, lang string, topic string, probability double")
     .write.parquet(at))
    return spark.read.parquet(at)


def _draw(id_col: str, text_col: str, seed: int) -> Column:
    """A number in [0, 1) fixed by the row's id and text."""
    h = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))
    return F.pmod(h, F.lit(1 << 53)) / F.lit(float(1 << 53))


def _rows(docs: DataFrame, text_col: str, vocabulary: str | None = None) -> DataFrame:
    return _described(docs, text_col, vocabulary).withColumns({"source": _side("row.source"), "lang": _side("row.lang")})


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"))


def mix_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
                  vocabulary: str | None = None) -> DataFrame:
    """One row per input row: id, source, lang, topic, n_tokens, probability
    and kept."""
    few = docs.select(column(id_col).alias("id"), column(text_col).alias("text"), "source", "lang",
                      _draw(id_col, text_col, mix.seed).alias("draw"))
    at = scratch_path(docs.sparkSession, "mixing-rows")
    _rows(few, "text", vocabulary).select("row.id", "row.draw", "source", "lang", "topic", "n_tokens").write.parquet(at)
    rows = docs.sparkSession.read.parquet(at)
    return (rows.join(rake(_cells(rows), mix), ["source", "lang", "topic"])
            .select(F.col("id").alias(id_col), "source", "lang", "topic", "n_tokens", "probability",
                    (F.col("draw") < F.col("probability")).alias("kept")))


def keep(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they were.  Tokens are
    counted once, for the cells; drawing needs a row's cell only."""
    few = docs.select(column(text_col).alias("text"), "source", "lang")
    drawn = _rows(docs, text_col).join(rake(_cells(_rows(few, "text", vocabulary)), mix), ["source", "lang", "topic"])
    return drawn.where(_draw(f"row.{id_col}", f"row.{text_col}", mix.seed) < F.col("probability")).select("row.*")
