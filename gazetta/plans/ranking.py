"""Positions in a total order without a single task that holds all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[tuple[Column, bool]], name: str = "rank") -> DataFrame:
    """`df` with the 1-based position of each row by keys (column, descending) of which the last is unique.

    Rows are dealt into ranges by the keys and numbered inside; the counts of earlier ranges, one number for each range,
    are added. The ranges are checkpointed first, so both steps see the same ones.
    """
    spark = df.sparkSession
    columns = [f"_k{i}" for i in range(len(keys))]
    dealt = df.withColumns({c: k for c, (k, _) in zip(columns, keys, strict=True)})
    order = [F.col(c).desc() if down else F.col(c).asc() for c, (_, down) in zip(columns, keys, strict=True)]
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gazetta-"))
    dealt = dealt.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = dealt.groupBy("_range").agg(F.count("*").alias("n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_range", "_before")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.join(F.broadcast(before), "_range").withColumn(name, (F.col("_before") + inside).cast("long")).drop("_range", "_before", *columns)
