"""MinHash near-duplicates: ProbMinHash signatures, banding, verification.

1. Rows with equal text form a class; only classes go on.  A class has a
   ProbMinHash signature of its weighted five-word shingles and a key for
   each band of it.  Classes that share a key are candidates.
2. In every bucket, each class is verified against the bucket's first one by
   the exact probability Jaccard of the two texts.  A dense bucket of n
   classes costs n - 1 checks and its links make one component.
3. Where a bucket of three classes or more still spans components, all its
   pairs across components are verified, in blocks of bounded size that only
   return links.  So no link between candidates is lost, nor are all pairs
   of a group written.
4. Groups are the connected components of the links.

With 32 bands of 5 rows, a pair at similarity 0.8 shares no bucket with
probability (1 - 0.8^5)^32 = 3e-6.

Defined cases: null text is empty; texts without words are alike only to
exact copies; a text of fewer than five words is one shingle; a null id
comes after all others; of rows with equal id and text one stays; rows
with equal id but other texts are documents of their own; an empty table
gives no rows; other columns are carried by ``keep`` as they are, their
names never clash (the helper columns live in frames without them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.llm import probminhash as P
from bundlelake.llm.components import components
from bundlelake.llm.textnum import text_chunks
from bundlelake.session import scratch_path

SIZE, ROWS = 160, 5      # components of a signature, rows of a band
LEAST = 0.8              # similarity of a link
BLOCK = 1024             # classes on either side of a verification block
BLOCK_BYTES = 3 << 20    # and bytes of shingles (32 bits each)
TEXTS = 1024             # texts whose signatures are drawn together: their arrays grow with texts x SIZE
SLICE = 2048             # shingles of a matrix product


def _written(df: DataFrame, name: str) -> DataFrame:
    at = scratch_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def _keys(id_col: str, text_col: str) -> list[Column]:
    """c: class (hash of the text); k: hash of id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    c = F.md5(text)
    k = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), c))
    return [c.alias("c"), k.alias("k")]


def _bands(batches):
    for part in batches:
        for b, first, raw, offsets in ((b, *c) for b in (part.slice(s, TEXTS) for s in range(0, part.num_rows, TEXTS))
                                       for c in text_chunks(b.column(4))):
            n = offsets.size - 1
            t, key, weight = P.shingles(raw, offsets)
            keys = P.band_keys(P.signatures(t, key, weight, n, SIZE), ROWS)
            has = np.zeros(n, bool)
            has[t] = True
            cut = np.concatenate([[0], np.cumsum(np.where(has, keys.shape[1], 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(keys[has].ravel()))
            yield pa.RecordBatch.from_arrays([b.column(i).slice(first, n) for i in range(4)] + [lists],
                                             names=["id", "c", "k", "tag", "bands"])


def _shingle_sets(batches):
    """Per text its shingle hashes, sorted, each as often as it occurs."""
    for b in batches:
        for first, raw, offsets in text_chunks(b.column(1)):
            n = offsets.size - 1
            t, key, weight = P.shingles(raw, offsets)
            cut = np.concatenate([[0], np.cumsum(np.bincount(t, weights=weight, minlength=n).astype(np.int64))])
            data = np.repeat(key, weight).tobytes()
            sets = pa.array([data[4 * i:4 * j] for i, j in zip(cut[:-1], cut[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(first, n), sets], names=["node", "sh"])


def _unpack(data: bytes):
    return np.unique(np.frombuffer(data, np.uint32), return_counts=True)


def _verify(least: float):
    def run(batches):
        for b in batches:
            memo, hit = {}, np.zeros(b.num_rows, bool)
            for i, (a, x, y) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())):
                if a not in memo:
                    memo = {a: _unpack(x)}  # rows of one lead come together
                hit[i] = P.probability_jaccard(*memo[a], *_unpack(y)) >= least
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(hit))
    return run


def _shared(sets: list, left: np.ndarray, right: np.ndarray):
    """For all pairs of two lists of weighted sets: the number of shingles
    they share, and which share of either's weight lies on those; by matrix
    products over slices of the shingles that occur twice or more."""
    rows = np.repeat(np.arange(len(sets)), [k.size for k, _ in sets])
    key, column, count = np.unique(np.concatenate([k for k, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.concatenate([w / w.sum() for _, w in sets])
    often = count[column] > 1
    slot = (np.cumsum(count > 1) - 1)[column[often]]
    rows, weight = rows[often], weight[often]
    order = np.argsort(slot, kind="stable")
    slot, rows, weight = slot[order], rows[order], weight[order]
    both, of_left, of_right = (np.zeros((left.size, right.size), np.float32) for _ in range(3))
    for first in range(0, int(slot[-1]) + 1 if slot.size else 0, SLICE):
        i, j = np.searchsorted(slot, [first, first + SLICE])
        one, part = np.zeros((len(sets), SLICE), np.float32), np.zeros((len(sets), SLICE), np.float32)
        one[rows[i:j], slot[i:j] - first] = 1
        part[rows[i:j], slot[i:j] - first] = weight[i:j]
        both += one[left] @ one[right].T
        of_left += part[left] @ one[right].T
        of_right += one[left] @ part[right].T
    return both, of_left, of_right


def _block(least: float):
    """Links across components in one block pair.  A pair goes to the exact
    check if neither text's shared weight is below ``least`` (the probability
    Jaccard is at most that) and, where both texts have single shingles only,
    their Jaccard, which then equals it, is not.  Found links join components
    at once, so copies of copies are not compared again."""
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        sets = [_unpack(x) for x in table.column("sh").to_pylist()]
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        both, of_left, of_right = _shared(sets, left, right)
        size = np.array([k.size for k, _ in sets])
        plain = np.array([w.max() == 1 for _, w in sets])
        jaccard = both / (size[left][:, None] + size[right][None, :] - both)
        near = (of_left >= least - 1e-3) & (of_right >= least - 1e-3) & (comp[left][:, None] != comp[right][None, :])
        near &= ~(plain[left][:, None] & plain[right][None, :]) | (jaccard >= least - 1e-3)
        up = {int(c): int(c) for c in comp}

        def find(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        out = []
        for x, y in zip(*np.nonzero(np.triu(near, 1) if same else near)):
            x, y = left[x], right[y]
            p, q = find(int(comp[x])), find(int(comp[y]))
            if p != q and P.probability_jaccard(*sets[x], *sets[y]) >= least:
                up[p] = q
                out.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
    return run


def _block_links(members: DataFrame, label: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Verified links between components that share a bucket of three
    classes or more (pairs in smaller buckets have been verified)."""
    comp = members.join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("comp"))
    wide = (comp.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("n > 2 and lo != hi").select("key", "n"))
    rows = comp.join(wide, "key").join(sets.select("node", F.octet_length("sh").alias("bytes")), "node")
    parts = rows.groupBy("key").agg(F.ceil(F.greatest(F.max("n") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).alias("g"))
    rows = rows.join(parts, "key").withColumn("c", F.pmod(F.xxhash64("node"), F.col("g")))
    pairs = rows.select("key", "node", "comp", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("o"))
    pairs = pairs.select("key", "node", "comp", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"),
                         F.when(F.col("c") <= F.col("o"), 0).otherwise(1).alias("side"))
    return (pairs.join(sets, "node").groupBy("key", "i", "j").applyInArrow(_block(least), "a long, b long").distinct())


def _grouped(docs: DataFrame, id_col: str, text_col: str, least: float):
    """(rows: id, c, tag; classes: node, c, rep, n_copies, the group's first
    row and sizes).  A tag tells rows of equal id and text apart."""
    c, k = _keys(id_col, text_col)
    src = docs.select(F.col(id_col).alias("id"), c, k, F.monotonically_increasing_id().alias("tag"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    order = F.struct(F.col("id").isNull().alias("null_id"), F.col("id"), F.col("k"), F.col("tag"))
    rows = _written(src.mapInArrow(_bands, f"id {kind}, c string, k string, tag long, bands array<long>"), "neardup-rows")
    classes = (rows.groupBy("c").agg(F.min(order).alias("rep"), F.count("*").alias("n_copies"), F.first("bands").alias("bands"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = _written(classes, "neardup-classes")  # fixes the node numbers

    keys = classes.select("node", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = _written(keys.join(buckets, "key").select("key", "node", "lead"), "neardup-members")

    active = members.select("node").distinct().join(classes.select("node", "c", "rep.k"), "node")
    texts = src.select("k", "text").join(active.select("node", "k"), "k")
    # repeated rows have one k; any of them serves
    sets = texts.select("node", "text").mapInArrow(_shingle_sets, "node long, sh binary").groupBy("node").agg(F.first("sh").alias("sh"))
    sets = _written(sets, "neardup-shingles")

    pairs = members.where("lead != node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("sh").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("sh").alias("x")), "a").select("a", "b", "x", "y"))
    links = _written(both.mapInArrow(_verify(least), "a long, b long"), "neardup-links")
    label = components(links)
    more = _written(_block_links(members.select("key", "node"), label, sets, least), "neardup-more-links")
    if more.limit(1).count():
        label = components(links.unionByName(more))

    whole = classes.select("node", "c", "rep", "n_copies").join(label, "node", "left")
    whole = whole.withColumn("label", F.coalesce("label", "node"))
    first = whole.groupBy("label").agg(F.min("rep").alias("first"), F.count("*").alias("n_classes"), F.sum("n_copies").alias("n_rows"))
    return rows.select("id", "c", "tag"), whole.join(first, "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per input row: id, class_id (smallest id of equal text),
    group_id (smallest id of its near-duplicate group), n_classes and n_docs
    of the group, and kept (true for one row of the group, its first)."""
    rows, classes = _grouped(docs, id_col, text_col, least)
    out = rows.join(classes.select("c", "rep", "first", "n_classes", "n_rows"), "c")
    return out.select(F.col("id").alias(id_col), F.col("rep.id").alias("class_id"), F.col("first.id").alias("group_id"),
                      "n_classes", F.col("n_rows").alias("n_docs"), (F.col("tag") == F.col("first.tag")).alias("kept"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns as they were, with one document of
    each group."""
    _, classes = _grouped(docs, id_col, text_col, least)
    first = classes.select(F.col("first.k").alias("k")).distinct()
    whole = docs.select(_keys(id_col, text_col)[1], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # rows equal in id and text have one k; the join has brought them together
    return whole.join(first, "k").groupBy("k").agg(F.first("row").alias("row")).select("row.*")
