"""Shape results for comparison with the SQL oracle: drop run-clock
columns, store instants as zone-less timestamps (the driver's tables are
zone-less and the session runs in UTC), round averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOCK_COLUMNS = ("dbt_processed_at", "dbt_updated_at")


def for_oracle(df: DataFrame, round_cols: tuple[str, ...] = (), digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in CLOCK_COLUMNS:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in round_cols:
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)
