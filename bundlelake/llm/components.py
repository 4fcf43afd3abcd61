"""Connected components of a link table, as Spark joins.

Every node takes the smallest label among itself and its neighbours, then
the label of that label (pointer jumping), until nothing changes.  Each
round is written to the shared folder, so lineage stays short and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.session import scratch_path


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, label): every linked node with the smallest
    node of its component.  An empty link table gives no rows."""
    spark = links.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        at = scratch_path(spark, name)
        df.write.parquet(at)
        return spark.read.parquet(at)

    both = links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))).select("col.*")
    both = written(both.where("u != v").distinct(), "components-links")
    label = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")), "components-labels")
    while True:
        seen = both.join(label.withColumnsRenamed({"u": "v", "l": "lv"}), "v").groupBy("u").agg(F.min("lv").alias("lv"))
        low = label.join(seen, "u").select("u", "l", F.least("l", "lv").alias("m"))
        jump = label.select(F.col("u").alias("m"), F.col("l").alias("lm"))
        new = written(low.join(jump, "m").select("u", F.least("m", "lm").alias("l"), (F.least("m", "lm") != F.col("l")).alias("moved")),
                      "components-labels")
        if not new.where("moved").limit(1).count():
            return new.select(F.col("u").alias("node"), F.col("l").alias("label"))
        label = new.select("u", "l")
