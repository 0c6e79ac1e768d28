"""Writing of feeds, state tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators.reconcile import feed_order
from gazetta.sources import versions
from gazetta.sources.feed import csv_lines


def write_feed(feed: DataFrame, path: str) -> None:
    """The feed in its order as text parts without header; parts are ordered by range, so joined they are the feed."""
    rows = feed.orderBy(*feed_order())
    csv_lines(rows).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines with sorted keys, as the next version of a table: readers see the old rows until all new ones are there."""
    versions.replace(df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value")), path, form="text")


def append_unique(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append rows whose keys the table lacks; a repeated key is an error before anything is written."""
    spark = df.sparkSession
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("rows to append repeat a key")
    if _exists(spark, path) and not df.join(spark.read.parquet(path).select(*keys), keys, "left_semi").isEmpty():
        raise ValueError("a row to append is there already")
    df.write.mode("append").parquet(path)


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace the rows of one partition value of a plain folder and keep all others; no new rows means that its old ones go.

    Files of the partition go before their successors are all there; `versions.replace` with a part replaces it at one moment.
    """
    spark = df.sparkSession
    if df.isEmpty():
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        return
    df.withColumn(column, F.lit(value)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def save_checked(df: DataFrame, path: str, violations: DataFrame) -> None:
    """Write a state table as JSON lines unless its rules are broken; `violations` has a row for each broken one."""
    if first := violations.limit(3).collect():  # enough to tell
        raise ValueError(f"not saved: {'; '.join(str(r.asDict()) for r in first)}")
    write_json(df, path)


def replaced(old: DataFrame, new: DataFrame, column: str, value: str) -> DataFrame:
    """The table as `replace_partition` leaves it."""
    return old.where(F.col(column) != value).unionByName(new.where(F.col(column) == value))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
