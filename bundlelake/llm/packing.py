"""Packing along a Hilbert curve.

A document's distinct tokens are hashed with signs into a vector, projected
to three dimensions and given the Hilbert key of that point.  Documents are
range-sorted by key and laid end to end, so a sequence holds neighbours on
the curve.  The line is cut every ``length`` tokens: only the last sequence
is shorter.  Partitions are laid out one by one; the driver only adds up one
total per partition.

Defined cases: a null or empty text is its end token alone; repeated rows
are documents of their own; long texts are cut over several sequences; a
null id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.textnum import mix64
from bundlelake.llm.tokencount import OTHER, Counter, byte_letters
from bundlelake.session import scratch_path

BUCKETS, DIMS, BITS = 4096, 3, 16
SEED = 11


# Fixed value: how byte-level vocabularies of this kind split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of a byte-level BPE file, as the ``tokenizers`` library gives
    them.  Where its merges are in the order of the ids they make, texts go
    through ``tiktoken`` with the same vocabulary, several times as fast;
    texts with special strings, or with characters on which the two may
    differ (see ``tokencount``), go to the library itself."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.special = Counter(vocabulary).special
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.fast = self._same_vocabulary(vocabulary)

    @staticmethod
    def _same_vocabulary(vocabulary: str):
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        made = [ids.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        if spec["pre_tokenizer"].get("add_prefix_space") or None in made or made != sorted(made):
            return None
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in ids.items()}
        return tiktoken.Encoding("same", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if self.fast is None or OTHER.search(t) or (self.special and self.special.search(t)):
                rest.append(i)
            else:
                out[i] = self.fast.encode_to_numpy(t, disallowed_special=()).astype(self.dtype)
        for i, e in zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, self.dtype)
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(vocabulary)


@lru_cache(maxsize=1)
def _directions() -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(BUCKETS, DIMS))


def project(ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, DIMS): the unit hashed vectors of each text's distinct tokens,
    projected on random directions."""
    seen = np.unique((owner.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
    who, h = (seen >> np.uint64(32)).astype(np.int64), mix64((seen & np.uint64(0xFFFFFFFF)) + np.uint64(SEED))
    cell, sign = (h % np.uint64(BUCKETS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)
    cells, at = np.unique(who * BUCKETS + cell, return_inverse=True)
    value = np.bincount(at, weights=sign, minlength=cells.size)
    who, cell = cells // BUCKETS, cells % BUCKETS
    length = np.sqrt(np.maximum(np.bincount(who, weights=value * value, minlength=n), 1))
    lines = _directions()
    return np.column_stack([np.bincount(who, weights=value * lines[cell, d], minlength=n) for d in range(DIMS)]) / length[:, None]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, dims) below 2**bits:
    axes to transposed index by exchanges and inversions from the top bit
    down, then Gray decoding, then the bits interleaved."""
    x = [points[:, d].astype(np.int64).copy() for d in range(points.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(len(x)):
            flip = (x[d] & bit) > 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[d]
        bit >>= 1
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn = np.where(x[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (((v ^ turn) >> b) & 1)
    return key


def _encode(vocabulary: str, end_id: int, rows_at_once: int = 256):
    def run(batches):
        encode, tie = encoder(vocabulary), TaskContext.get().partitionId() << 40
        end = encode.dtype(end_id)
        for b in batches:
            for s in range(0, b.num_rows, rows_at_once):
                part = b.slice(s, rows_at_once)
                ids = [np.append(x, end) for x in encode(part.column(1).to_pylist())]
                size, n = np.array([x.size for x in ids]), len(ids)
                point = project(np.concatenate(ids), np.repeat(np.arange(n), size), n)
                grid = np.clip((0.5 + 0.5 * np.tanh(point / 4)) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(size), pa.array(hilbert(grid)), pa.array(tie + np.arange(n))],
                    names=["doc_id", "ids", "n", "curve", "tie"])
                tie += n
    return run


def _lay(batches):
    """Rows of a partition, in their order: its number and where each starts."""
    part, start = TaskContext.get().partitionId(), 0
    for b in batches:
        size = b.column(1).to_numpy()
        end = start + np.cumsum(size)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.full(b.num_rows, part)), pa.array(end - size)],
                                         names=["tie", "n", "part", "start"])
        start = int(end[-1]) if b.num_rows else start


def _cut(length: int, wide: bool):
    kind = np.uint32 if wide else np.uint16

    def run(batches):
        for b in batches:
            rows = []
            for r, (data, n, at) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist())):
                ids, start = np.frombuffer(data, kind).astype("<u4"), 0
                while start < n:
                    seq, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    rows.append((r, start, size, ids[start:start + size].tobytes(), seq, offset))
                    start += size
            cols = list(zip(*rows)) or [()] * 6
            r = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(r), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()),
                 b.column(2).take(r), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()), b.column(3).take(r)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "curve"])
    return run


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32 bits), doc_tokens, sequence_id, offset and the document's curve key."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    at = scratch_path(spark, "packing-ids")
    src.mapInArrow(_encode(vocabulary, end_id), f"doc_id {kind}, ids binary, n long, curve long, tie long").write.parquet(at)
    rows = spark.read.parquet(at)  # encoded once; the curve is sorted without the ids
    at = scratch_path(spark, "packing-line")
    line = rows.select("tie", "n", "curve").repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie")
    line.select("tie", "n").mapInArrow(_lay, "tie long, n long, part long, start long").write.parquet(at)
    line = spark.read.parquet(at)
    # one total per partition of the line
    totals = sorted((r["part"], r["n"]) for r in line.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in totals])])
    base = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(totals, before)], "part long, base long")
    starts = line.join(F.broadcast(base), "part").select("tie", (F.col("base") + F.col("start")).alias("at"))
    placed = rows.join(starts, "tie").select("doc_id", "ids", "n", "curve", "at")
    wide = encoder(vocabulary).dtype is np.uint32
    return placed.mapInArrow(_cut(length, wide), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                                 "sequence_id long, offset long, curve long")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids (packed as in ``pack``) and the lengths
    of its pieces, in order.  A group has one sequence's pieces at most."""
    got = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return got.select("sequence_id", joined.alias("ids"), F.col("p.length").alias("piece_lengths"))
