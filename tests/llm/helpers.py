"""Inputs that the operators of ``bundlelake.llm`` must stand."""

SF = "/root/testdata/sf0.001"
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "id long, c string, k string, row string, score double, `a.b` string, node long")
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000)) + "."


def odd_documents(spark):
    """Null ids and texts, empty and very long texts, repeated rows, equal
    ids with other texts, and columns with the names of helper columns."""
    fill = (7, "c", "k", "row", 0.5, "dot", 9)
    texts = [(1, "plain words make a plain document of eight", "en", "a"), (1, "plain words make a plain document of eight", "en", "a"),
             (1, "another text under the same number, said the editor", "en", "b"), (2, None, "en", "a"), (3, "", None, None),
             (4, " \n\t ", "de", ""), (None, "a text without a number has its place too", None, "a"), (None, None, None, None),
             (5, LONG, "fr", "hot"), (6, LONG + " end", "fr", "hot"), (7, "ø ß 漢字 <|endoftext|> 🙂 é </s>", "xx", "hot"), (8, "one", "en", "hot"),
             (9, "one two three", "en", "hot"), (10, "one two three", "en", "hot")]
    return spark.createDataFrame([(i, t, la, s, len(t or ""), *fill) for i, t, la, s in texts], DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=((1, 1, 0), (5, 0, 1), (7, 1, None), (None, 1, 1), (8, 0, 0), (8, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
