"""Whole input rows carried as one struct, so that no column name of the
input can clash with a helper column or need quoting in a UDF's schema."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"))


def schema(docs: DataFrame, *more: StructField) -> StructType:
    """Of the struct ``row`` and further columns."""
    return StructType([StructField("row", StructType(docs.schema.fields), False), *more])


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column of the rows in a batch whose first column is the struct."""
    return batch.column(0).field(name)


def kept(docs: DataFrame, text_col: str, accept) -> DataFrame:
    """The rows whose texts ``accept(texts)`` marks true, as they were."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(accept(column_of(b, text_col))))

    return packed(docs).mapInArrow(run, schema(docs)).select("row.*")
