"""Vector codes by Lloyd iterations over partition-local cover trees.

Vectors become integers and are cut into equal consecutive parts; each part
position has a codebook, and a vector's code is the number of its nearest
entry in every position.

A task builds, for every block of its rows and each position, a cover tree
of the parts: a node's points lie within its radius of its first point, its
children within half of that, and centres of sibling nodes lie further apart
than their children's scale.  The points are kept in tree order with
cumulative sums, so the sum over any subtree is one subtraction.  The trees
are built once and written to the shared folder; each round reads them and
walks down: an entry further from the centre than the nearest one by more
than twice the radius can be nearest to no point of the node (triangle
inequality).  With one entry left, the whole subtree is assigned; only nodes
that stay ambiguous go on to their children and, in leaves, to exact integer
comparisons.  A round sends one sum per task, entry and component.

Defined cases: vectors that are null or hold null or non-finite components
are left out; shorter vectors (and those whose length does not divide) are
filled up with zeros; components are held within bounds (2**27 at 64
components) so that squared distances of a whole vector stay below 2**62;
a null id comes after all others; rows of one id count each, ordered by
vector among the first entries; with fewer rows than entries there are fewer
entries; ties go to the lower entry, unused entries stay; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CELLS = 1 << 19   # components of a block: 8192 vectors of 64
LEAF = 24         # points that a node need not split
_FAR = np.iinfo(np.int64).max
_SLACK = 1e-9     # covers the rounding of lengths; an entry kept in vain costs a comparison only


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(fine, F.lit(False))


def _whole(values: np.ndarray, lengths: np.ndarray, dim: int, limit: int, scale: int) -> np.ndarray:
    """(rows, dim) integers: floor(scale * x), filled up with zeros."""
    out = np.zeros((lengths.size, dim), np.int64)
    row = np.repeat(np.arange(lengths.size), lengths)
    at = np.arange(values.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = np.clip(np.floor(values.astype(np.float64) * scale), -limit, limit).astype(np.int64)
    return out


class Tree:
    """Of one block and position: points in tree order with cumulative sums,
    and per node its range, radius and children (consecutive nodes)."""

    def __init__(self, points: np.ndarray, links: np.ndarray, radius: np.ndarray):
        self.points, self.links, self.radius = points, links, radius
        self.sums = np.zeros((points.shape[0] + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=self.sums[1:])


def plant(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, links: start, end, first child, children; radii)."""
    order = np.arange(points.shape[0])
    links, radius = [[0, order.size, 0, 0]], [0.0]
    open_nodes = [0]
    while open_nodes:
        node = open_nodes.pop()
        start, end = links[node][:2]
        rest = order[start:end].copy()
        away = np.sqrt(((points[rest] - points[rest[0]]) ** 2).sum(axis=1).astype(float))
        wide = float(away.max())
        radius[node] = wide * (1 + _SLACK)
        if rest.size <= LEAF or wide == 0:
            continue
        scale = 2.0 ** (np.ceil(np.log2(wide)) - 1)  # of the children, below the radius; the first keeps the centre
        links[node][2], at = len(links), start
        while True:
            near = away <= scale
            child = rest[near]
            order[at:at + child.size] = child
            open_nodes.append(len(links))
            links.append([at, at + child.size, 0, 0])
            radius.append(0.0)
            at += child.size
            rest = rest[~near]
            if not rest.size:
                break
            away = np.sqrt(((points[rest] - points[rest[0]]) ** 2).sum(axis=1).astype(float))
        links[node][3] = len(links) - links[node][2]
    return order, np.array(links, np.int32), np.array(radius)


def _squares(points: np.ndarray, book: np.ndarray, among: np.ndarray) -> np.ndarray:
    """(points, entries) squared distances; entries not among are far."""
    return np.where(among, ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2), _FAR)


def settle(tree: Tree, book: np.ndarray):
    """Subtrees assigned whole (start, end, entry) and single points (place,
    entry) of the leaves that stayed ambiguous."""
    node, among = np.zeros(1, np.int64), np.ones((1, book.shape[0]), bool)
    runs, singles = [], []
    while node.size:
        start, end, child, kids = tree.links[node].T.astype(np.int64)
        squares = _squares(tree.points[start], book, among)
        best = squares.argmin(axis=1)  # the first of equal ones
        far = np.sqrt(squares.astype(float))
        reach = far[np.arange(node.size), best] + 2 * tree.radius[node]
        among = among & (far <= (reach * (1 + _SLACK) + _SLACK)[:, None])
        # a node without extent has the centre's exact answer
        done = (among.sum(axis=1) == 1) | (tree.radius[node] == 0)
        runs.append((start[done], end[done], best[done]))
        leaf = ~done & (kids == 0)
        if leaf.any():
            size = end[leaf] - start[leaf]
            place = np.repeat(start[leaf] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            exact = _squares(tree.points[place], book, np.repeat(among[leaf], size, axis=0))
            singles.append((place, exact.argmin(axis=1)))
        down = ~done & (kids > 0)
        size = kids[down]
        node = np.repeat(child[down] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        among = np.repeat(among[down], size, axis=0)
    none = [(np.zeros(0, np.int64),) * 2]
    return [np.concatenate(x) for x in zip(*runs)], [np.concatenate(x) for x in zip(*(singles or none))]


def totals(tree: Tree, book: np.ndarray) -> np.ndarray:
    """(entries, components + 1): sums of the points assigned to each entry,
    and their number."""
    (start, end, entry), (place, own) = settle(tree, book)
    out = np.zeros((book.shape[0], book.shape[1] + 1), np.int64)
    np.add.at(out, entry, np.column_stack([tree.sums[end] - tree.sums[start], end - start]))
    np.add.at(out, own, np.column_stack([tree.points[place], np.ones(place.size, np.int64)]))
    return out


def assigned(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, in tree order."""
    (start, end, entry), (place, own) = settle(tree, book)
    label = np.zeros(tree.points.shape[0], np.int64)
    size = end - start
    label[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(entry, size)
    label[place] = own
    return label, ((tree.points - book[label]) ** 2).sum(axis=1)


def _grow(dim: int, limit: int, scale: int, parts: int):
    """Rows (struct of id and group, vector) -> one row per block with its trees."""
    per_block, p = max(1, CELLS // max(1, dim)), dim // parts

    def block(rows: list[pa.Array], whole: np.ndarray) -> pa.RecordBatch:
        n, order, points, links, radius = whole.shape[0], [], [], [], []
        for j in range(parts):
            part = np.ascontiguousarray(whole[:, j * p:(j + 1) * p])
            o, k, r = plant(part)
            order.append(o.astype(np.int32))
            points.append(part[o].astype(np.int32))
            links.append(k)
            radius.append(r)
        kept = pa.concat_arrays(rows)
        cells = [kept, *(np.concatenate(x).tobytes() for x in (order, points, links, radius)), np.array([len(r) for r in radius], np.int32).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), cells[0]), *(pa.array([c], pa.binary()) for c in cells[1:])],
            names=["rows", "ranks", "points", "links", "radius", "nodes"])

    def run(batches):
        rows, held, n = [], [], 0
        for b in batches:
            vecs = b.column(1)
            whole = _whole(vecs.flatten().to_numpy(zero_copy_only=False), vecs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), dim, limit, scale)
            at = 0
            while at < b.num_rows:
                take = min(per_block - n, b.num_rows - at)
                rows.append(b.column(0).slice(at, take))
                held.append(whole[at:at + take])
                n, at = n + take, at + take
                if n == per_block:
                    yield block(rows, np.concatenate(held))
                    rows, held, n = [], [], 0
        if n:
            yield block(rows, np.concatenate(held))
    return run


def _trees(b: pa.RecordBatch, r: int, parts: int, p: int):
    """(order, tree) of every position of a block's row."""
    get = lambda c, kind: np.frombuffer(b.column(c)[r].as_buffer(), kind)
    ranks, points, links, radius, nodes = (get(c, k) for c, k in zip(range(1, 6), (np.int32, np.int32, np.int32, np.float64, np.int32)))
    n, cut = ranks.size // parts, np.concatenate([[0], np.cumsum(nodes)])
    points, links = points.reshape(parts, n, p).astype(np.int64), links.reshape(-1, 4)
    for j in range(parts):
        at = slice(cut[j], cut[j + 1])
        yield ranks[j * n:(j + 1) * n], Tree(points[j], links[at], radius[at])


def _round(books: np.ndarray):
    """Sums and counts over a whole task, one row per cell in use."""
    parts, _, p = books.shape

    def run(batches):
        total = np.zeros(books.shape[:2] + (p + 1,), np.int64)
        for b in batches:
            for r in range(b.num_rows):
                for j, (_, tree) in enumerate(_trees(b, r, parts, p)):
                    total[j] += totals(tree, books[j])
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell])], names=["cell", "total"])
    return run


def _encode(books: np.ndarray):
    parts, _, p = books.shape
    digits = np.array([f"{e:02x}" for e in range(256)])

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                n = b.column(0).value_lengths()[r].as_py()
                code, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
                for j, (order, tree) in enumerate(_trees(b, r, parts, p)):
                    label, far = assigned(tree, books[j])
                    code[order, j] = label
                    error[order] += far
                rows = b.column(0).slice(r, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [*rows.flatten(), pa.array(["".join(x) for x in digits[code].tolist()], pa.string()), pa.array(error)],
                    names=["id", "group", "code", "error"])
    return run


def _written(df: DataFrame, name: str, **options) -> DataFrame:
    at = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(at)
    return df.sparkSession.read.parquet(at)


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((id, group, code, error) of every usable row, codebooks as (parts,
    entries, components) integers).  The driver holds the codebooks and their
    sums, whose size does not depend on the table."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part")
    spark = vectors.sparkSession
    rows = vectors.select(F.struct(F.col(id_col).alias("id"), F.col(group_col).alias("group")).alias("row"),
                          F.col(vec_col).alias("vec")).where(usable(F.col("vec")))
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    dim = -(-longest // parts) * parts
    limit = 1 << ((62 - max(1, dim).bit_length()) // 2 - 1)
    first = rows.orderBy(F.col("row.id").asc_nulls_last(), "vec").select("vec").limit(entries).collect()
    lengths = np.array([len(r["vec"]) for r in first], np.int64)
    start = _whole(np.array([x for r in first for x in r["vec"]], float), lengths, dim, limit, scale)
    books = start.reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy()

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema["row"].dataType.fields}
    blocks = rows.mapInArrow(_grow(dim, limit, scale, parts),
                             f"rows array<struct<id:{kinds['id']},`group`:{kinds['group']}>>, ranks binary, points binary, links binary, radius binary, nodes binary")
    # a row is a block of some megabytes: row groups of a few, so that a reader holds few at once
    blocks = _written(blocks, "codebook-trees", **{"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 2,
                                                   "parquet.page.size.row.check.min": 2})
    for _ in range(rounds):
        sums = blocks.mapInArrow(_round(books), "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).collect()
        total = np.zeros(books.shape[:2] + (books.shape[2] + 1,), np.int64)
        for r in sums:
            total.ravel()[r["cell"]] = r["total"]
        count = total[:, :, -1:]
        books = np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)  # // rounds down
    codes = blocks.mapInArrow(_encode(books), f"id {kinds['id']}, `group` {kinds['group']}, code string, error long")
    return codes.select(F.col("id").alias(id_col), F.col("group").alias(group_col), "code", "error"), books


def group_error(codes: DataFrame, group_col: str = "label") -> DataFrame:
    """``codes`` with ``label_error``, the error summed over rows of an equal
    group (nulls are one).  The sums are one row per group, made by partial
    aggregation; a hot group's rows stay spread, as the join may split them."""
    codes = _written(codes, "codebook-codes")
    sums = codes.groupBy(F.col(group_col).alias("of_group")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col(group_col).eqNullSafe(F.col("of_group"))).drop("of_group")


def fingerprint(books: np.ndarray) -> str:
    """Of the integers by part, entry and component."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
