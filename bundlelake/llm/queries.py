"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator, with production parameters, to its whole
table and derives the digest columns of its contract from the operator's
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.llm import (chat, codebooks, extraction, fim, knn, mixing, neardup, packing, ranking, repetition, tokencount, toxicity,
                            wordbpe)

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- 1: chat formatting -------------------------------------------------------------------

_t = chat.DEFAULT
_esc = "replace(text, '\\', '\\\\')"
for _c in _t.controls():
    _esc = f"replace({_esc}, '{_c}', '{_c[0]}\\{_c[1:]}')"
_role_esc = _esc.replace("replace(text,", "replace(role,")
_around = " ".join(f"WHEN '{r}' THEN {len(m.open) + len(m.close)}" for r, m in _t.roles.items())
_moves = ", ".join(f"('{s}', '{r}')" for s, m in _t.moves.items() for r in m)

OP1_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (
  SELECT *, row_number() OVER w AS n, coalesce(lag(role) OVER w, 'start') AS state FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (
  SELECT *, {_esc} AS esc, {_role_esc} AS role_esc, (state, role) NOT IN ({_moves}) AS bad FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
  CAST(sum(length(esc) + CASE role {_around}
      ELSE {len(_t.other.open) + len(_t.other_sep) + len(_t.other.close)} + length(role_esc) END) AS BIGINT) AS formatted_chars,
  CASE WHEN bool_or(bad) THEN 'bad_turn' WHEN arg_max(role, n) = 'assistant' THEN 'ok' ELSE 'unfinished' END AS status,
  coalesce(min(CASE WHEN bad THEN n - 1 END), -1) AS bad_turn
FROM e GROUP BY conv_id"""


@query("op1_chat_formatting", OP1_SQL)
def op1(spark, sf_dir):
    """Conversations formatted, then read back from the formatted string."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"),
                 F.lit("</s>[INST] ok [/INST]").alias("text")) for i, r in enumerate(("user", "assistant"))]))).select("col.*")
    done = chat.format_chats(rows.unionByName(probe))
    back = done.select("conv_id", "formatted", "status", "bad_turn", chat.read_back(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "status", "bad_turn")


# --- 4: token counts ----------------------------------------------------------------------

@query("op4_token_counts")
def op4(spark, sf_dir):
    """No SQL: byte-pair merging is iterative (tested against the library)."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"), vocabulary(), limit=1024)


# --- 5: repetition coverage -----------------------------------------------------------------

def _covered_sql(n: int) -> str:
    """Words inside a window of n words that the text has twice or more."""
    key = " || ' ' || ".join(f"lead(word, {i}) OVER o" if i else "word" for i in range(n))
    return f"""k{n} AS (SELECT doc_id, i, len, {key} AS k FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
d{n} AS (SELECT doc_id, i, len, k IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k) > 1 AS dup FROM k{n}),
c{n} AS (SELECT doc_id, len, bool_or(dup) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit FROM d{n}),
s{n} AS (SELECT doc_id, count(*) FILTER (hit) AS words, CAST(coalesce(sum(len) FILTER (hit), 0) AS BIGINT) AS chars FROM c{n} GROUP BY 1)"""


_NS = list(repetition.MOST_PERCENT)
_WORDS = r"'[^\x20\x09-\x0D]+'"
OP5_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, i, word, length(word) AS len FROM (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, {_WORDS}) AS words FROM t))),
b AS (SELECT doc_id, count(*) AS n_words, CAST(sum(len) AS BIGINT) AS word_chars FROM w GROUP BY 1),
l AS (SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again,
    length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars FROM (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM t))
  WHERE regexp_matches(line, {_WORDS})),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines,
  CAST(coalesce(sum(chars) FILTER (again), 0) AS BIGINT) AS dup_line_chars FROM l GROUP BY 1),
{", ".join(_covered_sql(n) for n in (3, *_NS))},
f AS (SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(s3.words, 0) AS n_repeat_words,
  {", ".join(f"coalesce(s{n}.chars, 0) AS dup{n}_chars" for n in _NS)},
  coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars
  FROM t LEFT JOIN b USING (doc_id) LEFT JOIN ls USING (doc_id) {" ".join(f"LEFT JOIN s{n} USING (doc_id)" for n in (3, *_NS))}),
v AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MOST_REPEAT_WORDS} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND NOT (100 * n_dup_lines > {repetition.MOST_LINES} * n_lines
  OR 100 * dup_line_chars > {repetition.MOST_LINE_CHARS} * word_chars
  OR {" OR ".join(f"100 * dup{n}_chars > {p} * word_chars" for n, p in repetition.MOST_PERCENT.items())}) AS kept FROM v"""


@query("op5_repetition_coverage", OP5_SQL)
def op5(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents"))


# --- 8: toxicity, 10: quality ---------------------------------------------------------------

@query("op8_toxicity")
def op8(spark, sf_dir):
    """No SQL: a trained model (tested by held-out accuracy)."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op10_quality_ranking")
def op10(spark, sf_dir):
    """No SQL: a trained model (tested by held-out accuracy)."""
    docs = table(spark, sf_dir, "documents")
    return ranking.score(docs, ranking.fit(docs, table(spark, sf_dir, "labels")))


# --- 3: near-duplicates ---------------------------------------------------------------------

@query("op3_near_duplicates")
def op3(spark, sf_dir):
    """No SQL: components over verified pairs (tested against all pairs)."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


# --- 9: nearest neighbours ------------------------------------------------------------------

@query("op9_nearest_neighbours")
def op9(spark, sf_dir):
    """Every fiftieth vector against all.  Not compared with SQL: sums of
    doubles differ in their last digits (tested against brute force)."""
    rows = table(spark, sf_dir, "embeddings")
    return knn.nearest(rows.where(F.col("vec_id") % 50 == 0), rows, k=5)


# --- 7: packing -----------------------------------------------------------------------------

@query("op7_packing")
def op7(spark, sf_dir):
    """No SQL: token ids and curve keys (tested by exact round trip)."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), vocabulary()))


# --- 2: mixing sources to target weights ----------------------------------------------------

@query("op2_source_mixing")
def op2(spark, sf_dir):
    """No SQL: raking is iterative (tested against raking in one array)."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"), vocabulary=vocabulary())


# --- 6: HTML extraction ---------------------------------------------------------------------

@query("op6_html_extraction")
def op6(spark, sf_dir):
    """No SQL: a trained model (tested on pages of known text)."""
    pages = table(spark, sf_dir, "pages")
    model = extraction.fit(extraction.labelled_pages(pages))
    return extraction.extract(pages, model).withColumn("n_chars", F.length("text").cast("long"))


# --- 11: byte-level BPE by distinct words -----------------------------------------------------

@query("op11_distinct_word_bpe")
def op11(spark, sf_dir):
    """No SQL: byte-pair merging is iterative (tested against the library)."""
    import public_tokenizers

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    done = wordbpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


# --- 12: vector codes -------------------------------------------------------------------------

def _lloyd_sql() -> str:
    """All rounds unrolled, over one row per vector, component and entry."""
    parts, entries, rounds = codebooks.PARTS, codebooks.ENTRIES, codebooks.ROUNDS
    ctes = [f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]), true)),
x AS MATERIALIZED (SELECT r, vec_id, label, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS pos,
    CAST(floor(CAST(embedding[i] AS DOUBLE) * {codebooks.SCALE}) AS BIGINT) AS v
  FROM (SELECT *, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, v FROM x WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""d{k} AS MATERIALIZED (SELECT r, part, entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d
  FROM x JOIN b{k} b USING (part, pos) GROUP BY r, part, entry),
a{k} AS MATERIALIZED (SELECT r, part, entry, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1)""")
        if k < rounds:
            ctes.append(f"""s{k} AS MATERIALIZED (SELECT part, entry, pos, CAST(sum(v) AS BIGINT) AS s, count(*) AS c FROM x JOIN a{k} USING (r, part) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, pos, CASE WHEN c IS NULL THEN v ELSE (s - (((s % c) + c) % c)) // c END AS v
  FROM b{k} LEFT JOIN s{k} USING (part, entry, pos))""")
    ctes.append(f"""e AS (SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})""")
    return ("WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN e USING (r) CROSS JOIN h""")


@query("op12_vector_codes", _lloyd_sql())
def op12(spark, sf_dir):
    codes, books = codebooks.compress(table(spark, sf_dir, "embeddings"))
    return codebooks.group_error(codes).select("vec_id", "code", "error", "label_error",
                                               F.lit(codebooks.fingerprint(books)).alias("codebooks_sha256"))


# --- 13: fill-in-middle -------------------------------------------------------------------------

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
OP13_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u FROM documents),
d AS (SELECT *, len(u) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark, sf_dir):
    done = fim.transform(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
