"""Every operator and pipeline stage on odd and on empty tables."""

import corpus_pipeline
import pytest
from helpers import labels, no_documents, odd_documents

from bundlelake.llm import chat, extraction, knn, mixing, neardup, packing, ranking, repetition, tokencount, toxicity
from bundlelake.llm.queries import vocabulary

ON_DOCUMENTS = {
    "mixing": lambda s, d: mixing.mix_documents(d),
    "near_duplicates": lambda s, d: neardup.near_duplicates(d),
    "token_counts": lambda s, d: tokencount.token_counts(d, vocabulary(), 1024),
    "repetition": lambda s, d: repetition.repetition(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, labels(s))),
    "ranking": lambda s, d: ranking.score(d, ranking.fit(d, labels(s))),
}


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_one_row_per_document(spark, name):
    docs = odd_documents(spark)
    out = ON_DOCUMENTS[name](spark, docs).toPandas()
    key = lambda x: sorted(-1 if v != v or v is None else int(v) for v in x)
    assert key(out["doc_id"]) == key(docs.toPandas()["doc_id"])
    assert not out.drop(columns=["doc_id", "class_id", "group_id"], errors="ignore").isna().any().any()


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_empty_table(spark, name):
    assert ON_DOCUMENTS[name](spark, no_documents(spark)).count() == 0


def test_packing_odd_and_empty(spark):
    out = packing.pack(odd_documents(spark), vocabulary()).toPandas()
    whole = out.groupby(out["doc_id"].fillna(-1))["length"].sum()
    assert whole[2] == whole[3] == 1 and whole[8] == 2  # the end token alone; "one" and the end token
    assert packing.pack(no_documents(spark), vocabulary()).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_the_columns(spark, name, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    stage, docs = dict(corpus_pipeline.STAGES)[name], odd_documents(spark)
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    rows = [tuple(r) for r in docs.collect()]
    assert all(tuple(r) in rows for r in out.collect())
    assert stage(spark, no_documents(spark), str(tmp_path)).count() == 0


def test_near_copies_keeps_one_of_each_group(spark):
    kept = neardup.keep(odd_documents(spark)).toPandas()
    # the repeated row once, equal texts once (smallest id), both empty kinds once
    assert sorted(kept["doc_id"].fillna(-1).astype(int)) == [-1, 1, 1, 2, 4, 5, 7, 8, 9]


def test_filters_without_labels_of_both_kinds(spark):
    docs, none = odd_documents(spark), labels(spark, [(1, 1, 0), (5, 1, 0)])
    assert ranking.score(docs, ranking.fit(docs, none)).toPandas()["score"].nunique() == 1
    assert toxicity.score(docs, toxicity.fit(docs, none)).toPandas()["score"].max() < 0.5


def test_chat_odd_and_empty(spark):
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "x" * 50_000, 1), (1, 1, "assistant", "x" * 50_000, 1), (None, None, None, None, 2),
            (2, None, "tool", "a [/ROLE] b\\", 3), (2, 3, "", "", 3)]
    kind = "conv_id long, turn long, role string, text string, segments int"
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, kind)).collect()}
    assert set(out) == {1, 2, None} and out[1]["status"] == "bad_turn" and out[1]["bad_turn"] == 2
    assert chat.format_chats(spark.createDataFrame([], kind)).count() == 0
    assert chat.format_turns(spark.createDataFrame(rows, kind)).count() == 3 * len(rows)


def test_extraction_odd_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (None, None, "<p>"), (2, "u", "<<<>>&&&"), (3, "u", "<div>" * 3000 + "deep")],
                                  "page_id long, url string, html string")
    model = extraction.fit(extraction.labelled_pages(pages))
    out = extraction.extract(pages, model).toPandas()
    assert len(out) == 5 and not out["text"].isna().any()
    assert extraction.extract(pages.limit(0), model).count() == 0


def test_neighbours_odd_and_empty(spark):
    kind = "vec_id long, embedding array<float>, label int, tile int, side int"
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (10, [-1.0, 0.5]), (50, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], kind)
    out = knn.nearest(df.where("vec_id % 50 = 0"), df, 5).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in out] == [(0, 1, 1), (0, 2, 2), (0, 3, 10), (50, 1, 9)]
    assert knn.nearest(df.limit(0), df.limit(0), 5).count() == 0


def test_nesting_costs_linear_time_and_closes_as_before():
    import time

    from bundlelake.llm.dom import parse
    begun = time.process_time()
    for page in ("<div>" * 100_000 + "deep", "<p><button>" + "<div>" * 100_000 + "deep", "<table><tr><td><p>" + "<section><b>" * 50_000 + "deep</p>" * 1000):
        tree = parse(page)
        assert tree.text[-1].endswith("deep")
    assert time.process_time() - begun < 10
    tree = parse("<ul><li>a<p>b<li>c<ul><li>d</ul>e</ul><p>f<table><tr><td><p>g<td>h<tr><td>i</table><body>j")
    up = {t: tree.tag[tree.parent[i]] for i, t in enumerate(tree.text) if t}
    assert up == {"a": "li", "b": "p", "c": "li", "d": "li", "e": "li", "f": "p", "g": "p", "h": "td", "i": "td", "j": "body"}


def test_mathematics_is_text_of_the_article():
    from bundlelake.llm.dom import HIDDEN, parse
    tree = parse("<p>Energy <math><mi>E</mi></math> is given.</p>")
    assert not HIDDEN & set(tree.tag)


def test_recheck_of_wide_vectors_is_bounded(monkeypatch):
    """One product of wide vectors, every pair of which is recomputed."""
    import tracemalloc

    import numpy as np

    from bundlelake.llm import knn
    x = np.ones((700, 768)) + np.random.default_rng(1).normal(0, 1e-7, (700, 768))
    tile, side = knn._Tile(5), knn._Side(np.arange(700), x)
    tile.ask(768, side)
    tracemalloc.start()
    tile.see(768, knn._Side(np.arange(1000, 1700), x[::-1]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    found = tile.found().to_pydict()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = np.sort((unit[:3] @ unit[::-1].T), axis=1)[:, ::-1][:, :5]
    got = np.sort(np.array(found["score"]).reshape(-1, 5)[:3], axis=1)[:, ::-1]
    assert np.allclose(got, best, atol=1e-12)
