"""Fill-in-middle transformation by one repeated-capture match per text.

A text is a sequence of units: white space with the word after it, or the
white space at the end.  One ``fullmatch`` of ``(unit)*`` with the ``regex``
library keeps the span of every repetition, so ``match.ends(1)`` gives the
number of units and, by index, both cuts; there is no loop over units.  The
quantifiers are possessive: a unit is never given back, so the match stores
spans only and no ways to return.

The draws are digits of a hash of seed and id, so a run can be repeated.
Only the cuts are found in Python; hashing, cutting, putting together and
restoring are DataFrame functions.  No shuffle.

Defined cases: a null text is empty; an empty text and one that holds a
marker stay plain; a null id draws like an empty one; repeated rows are
transformed alike; equal cuts give an empty middle; long texts are matched
whole (about 25 bytes of memory per character); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")


def _cuts(texts: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
    rows = []
    for text, a, b in zip(texts, one, two):
        ends = [0, *UNITS.fullmatch(text).ends(1)]  # ends[i]: characters of the first i units
        a, b = sorted((a % len(ends), b % len(ends)))
        rows.append((len(ends) - 1, ends[a], ends[b] - ends[a]))
    return pd.DataFrame(rows, columns=["n", "prefix_chars", "middle_chars"])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
              percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row:
    ``percent`` of the texts that allow it are cut, ``spm_percent`` of those
    with the suffix first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), digest.alias("digest"))
    rows = rows.select("id", "text", *draw)
    cuts = F.pandas_udf(_cuts, "n long, prefix_chars long, middle_chars long")
    text = F.col("text")
    plain = (text == "") | (F.col("h3") % 100 >= percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(text, F.lit(marker))
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("id", "text", form.alias("form"), cuts("text", "h1", "h2").alias("cut")).select("id", "text", "form", "cut.*")
    a, m = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring(text, F.lit(1), a), F.substring(text, a + 1, m)
    suffix = F.substring(text, a + m + 1, F.length(text))
    output = (F.when(F.col("form") == "plain", text)
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return rows.select(F.col("id").alias(id_col), "n", "form", F.when(cut, F.col("prefix_chars")).alias("prefix_chars"),
                       F.when(cut, F.col("middle_chars")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text again.  A cut text holds no marker, so the three in the
    output part it into an empty string and its three pieces."""
    piece = F.split(output, "<[PSM]>", -1)
    first, second, middle = piece[1], piece[2], piece[3]
    return (F.when(form == "plain", output).when(form == "spm", F.concat(second, middle, first))
            .otherwise(F.concat(first, middle, second)))
