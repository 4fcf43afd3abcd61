"""Token ids, vector codes and fill-in-middle: against the library, plain
versions and SQL, on the given tables and on odd ones."""

import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import LONG, SF, no_documents, odd_documents
from pyspark.sql import functions as F

from bundlelake.llm import codebooks, fim, queries, wordbpe

VOCABULARY = queries.vocabulary("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_fill_in_middle"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name]).df()
    got = queries.Q[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = want.columns[0]
    got, want = (x[sorted(want.columns)].sort_values(key).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got.astype(object).where(got.notna(), None), want.astype(object).where(want.notna(), None), check_dtype=False)


# --- 11 ---

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=wordbpe.ranks_of(VOCABULARY), special_tokens={})


def test_words_and_merges_are_the_librarys(library):
    rng, split, ranks = random.Random(5), wordbpe.splitter(public_tokenizers.PATTERN), wordbpe.ranks_of(VOCABULARY)
    # white space of all kinds, marks, and characters that Unicode versions class differently
    pool = list("abcABC  \n\t'st0123²Ⅷ漢字éß.,!?\x85\xa0 　") + [chr(c) for c in (0x88F, 0xC5C, 0x11DE1, 0x1F600, 0x2EBF0, 0x323B0, 0x300)] + ["'ll", "'ve"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(40))) for _ in range(4000)]
    texts += ["a" * 30_000, " " * 5000 + "x", "ab" * 9000, "".join(rng.choices(pool, k=3 * wordbpe.SLICE_CHARS)), "x" * 3 * wordbpe.SLICE_CHARS + " y"]
    for text in texts:
        assert [i for words in split(text) for w in words for i in wordbpe.merged(w.encode(), ranks)] == library.encode_ordinary(text)
    assert list(split(texts[-1])) == [[texts[-1][:-2]], [" y"]]  # cut at the first white space beyond a slice


def check_ids(spark, docs, library):
    want = []
    for r in docs.collect():
        text = r["text"] or ""
        want.append((r["doc_id"], text, library.encode_ordinary(text)))
    key = lambda x: (x[0] is None, x)
    for done in (wordbpe.decode(wordbpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY),
                 wordbpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN)):
        got = []
        for r in done.collect():
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            got.append((r["doc_id"], bytes(r["decoded"]).decode(), ids))
        assert sorted(got, key=key) == sorted(want, key=key)


def test_ids_of_documents(spark, library):
    check_ids(spark, spark.read.parquet(f"{SF}/documents.parquet"), library)


def test_ids_odd_and_empty(spark, library, monkeypatch):
    check_ids(spark, odd_documents(spark), library)
    monkeypatch.setattr(wordbpe, "CHUNK_CHARS", 50)  # chunks of a document or two
    check_ids(spark, odd_documents(spark).coalesce(1), library)
    assert wordbpe.decode(wordbpe.encode(no_documents(spark), VOCABULARY, public_tokenizers.PATTERN), VOCABULARY).count() == 0


def test_parts_hold_every_document_once(monkeypatch):
    monkeypatch.setattr(wordbpe, "CHUNK_IDS", 4)
    docs = [[3, 3, 9], [], [1], [7] * 9, [2, 5], [2]]
    packed = pa.array([np.array(x, np.uint32).tobytes() for x in docs], pa.binary())
    rows = [r for b in wordbpe._parts(40, pa.array(range(len(docs))), packed) for r in b.to_pylist()]
    held = [(r["chunk"], r["docs"]) for r in rows if r["token"] == -1]
    assert held == [(40, [0, 1, 2]), (41, [3]), (42, [4, 5])]
    for chunk, own in held:
        assert [r["token"] for r in rows if r["chunk"] == chunk] == [-1, *sorted({x for d in own for x in docs[d]})]


def test_each_word_crosses_once_per_chunk(spark):
    docs = spark.createDataFrame([(i, "hot " * 1000) for i in range(50)], "doc_id long, text string").coalesce(1)
    chunks = docs.mapInArrow(wordbpe._chunks(public_tokenizers.PATTERN, pa.int64()),
                            "chunk long, ids array<long>, sizes array<long>, places binary, words binary, word_sizes binary")
    asked = chunks.mapInArrow(wordbpe._requests(1024), "chunk long, bucket int, words binary, word_sizes binary").collect()
    assert sum(wordbpe._unpack(r["word_sizes"]).size for r in asked) == 3  # "hot", " hot" and the last " "


# --- 12 ---

def lloyd(rows, entries=16, parts=8, rounds=6):
    """Plain version in Python integers: rows of (id, vector, label)."""
    rows = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    dim = -(-max((len(v) for _, v, _ in rows), default=0) // parts) * parts
    p = dim // parts
    whole = [[int(np.floor(float(x) * 4096)) for x in v] + [0] * (dim - len(v)) for _, v, _ in rows]
    cut = [[w[j * p:(j + 1) * p] for j in range(parts)] for w in whole]
    books = [[c[j] for c in cut[:entries]] for j in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda c, j: min(range(len(books[j])), key=lambda e: (far(c[j], books[j][e]), e))
    for _ in range(rounds):
        new = []
        for j in range(parts):
            got = [near(c, j) for c in cut]
            members = [[c[j] for c, g in zip(cut, got) if g == e] for e in range(len(books[j]))]
            new.append([[sum(x) // len(m) for x in zip(*m)] if m else b for m, b in zip(members, books[j])])
        books = new
    out = []
    for (i, _, g), c in zip(rows, cut):
        code = [near(c, j) for j in range(parts)]
        out.append((i, g, "".join(f"{e:02x}" for e in code), sum(far(c[j], books[j][e]) for j, e in enumerate(code))))
    return out, books


def check_codes(spark, rows):
    df = spark.createDataFrame([(i, v, g, 0, "x") for i, v, g in rows], "vec_id long, embedding array<double>, label int, row int, id string")
    codes, books = codebooks.compress(df)
    want, want_books = lloyd(rows)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, codes.collect()), key=key) == sorted(want, key=key)
    assert books.tolist() == want_books
    total = {g: sum(e for _, h, _, e in want if h == g) for g in {g for _, g, _, _ in want}}
    assert all(r["label_error"] == total[r["label"]] for r in codebooks.group_error(codes).collect())


def test_codes_with_a_hot_vector_and_grid_ties(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "CELLS", 16 * 400)  # several blocks
    rng = np.random.default_rng(8)
    # a third equal, a third on a coarse grid (ties, radii that are powers of two), a third anywhere
    rows = ([(i, [0.25] * 16, 1) for i in range(300)]
            + [(1000 + i, (rng.integers(-2, 3, 16) / 1024).tolist(), None) for i in range(300)]
            + [(i - 500, rng.normal(size=16).tolist(), i % 3) for i in range(300)])
    check_codes(spark, rows)


def test_codes_odd_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, -2.0, 0.5], 1), (3, [1.0, -2.0, 0.5], 1), (3, [0.0], 2), (None, [1.0] * 9, None), (1, None, 1), (2, [None, 1.0], 1), (4, [nan], 1),
            (5, [inf, 0.0], 1), (6, [], None), (7, [-1e-9, 1e-9], 2), (8, [3.0] * 11, 2)]
    check_codes(spark, rows)
    check_codes(spark, [(1, [], 1), (2, [], None)])
    huge = spark.createDataFrame([(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1)], "vec_id long, embedding array<double>, label int")
    assert [r["error"] for r in codebooks.compress(huge)[0].collect()] == [0, 0]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    codes, books = codebooks.compress(empty)
    assert codebooks.group_error(codes).count() == 0 and books.size == 0 and len(codebooks.fingerprint(books)) == 64


def test_subtrees_are_assigned_whole():
    rng = np.random.default_rng(2)
    points = np.repeat(rng.integers(-9000, 9000, (16, 8)), 200, axis=0) + rng.integers(-40, 41, (3200, 8))
    order, links, radius = codebooks.plant(points)
    tree = codebooks.Tree(points[order], links, radius)
    assert sorted(order.tolist()) == list(range(3200))
    for (start, end, child, kids), r in zip(links.tolist(), radius):  # covered by the centre; children part the node
        assert ((tree.points[start:end] - tree.points[start]) ** 2).sum(axis=1).max() ** 0.5 <= r * (1 + 1e-9)
        assert not kids or [links[child][0], links[child + kids - 1][1]] == [start, end]
    book = points[::200]
    (start, end, _), (place, _) = codebooks.settle(tree, book)
    assert (end - start).sum() + place.size == 3200 and place.size < 300 and start.size < 300
    label, error = codebooks.assigned(tree, book)
    exact = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (label == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()


# --- 13 ---

UNIT = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def check_fim(spark, docs):
    rows = fim.transform(docs).withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    key = lambda x: (x[0] is None, x)
    want = []
    for d in docs.collect():
        text, digest = d["text"] or "", hashlib.sha256(f"42:{'' if d['doc_id'] is None else d['doc_id']}".encode()).hexdigest()
        units = [m.group() for m in UNIT.finditer(text)]
        h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form = "plain" if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
        out = {"plain": text, "spm": f"<S>{s}<P>{p}<M>{m}", "psm": f"<P>{p}<S>{s}<M>{m}"}[form]
        cut = form != "plain"
        want.append((d["doc_id"], len(units), form, len(p) if cut else -1, len(m) if cut else -1, out, text))
    got = [(r["doc_id"], r["n"], r["form"], *(-1 if r[c] is None else r[c] for c in ("prefix_chars", "middle_chars")), r["output"], r["restored"]) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_fim_odd_and_empty(spark):
    check_fim(spark, odd_documents(spark))
    assert fim.transform(no_documents(spark)).count() == 0
    texts = ["<P>", "a <M> b", "<S", "P>", "<P<S", " \x0b\x0c\r\n", "a\x1fb\xa0c", "🙂 é\n", LONG, "x", " x", "x ", "<[PSM]>"]
    check_fim(spark, spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(200)], "doc_id long, text string"))
