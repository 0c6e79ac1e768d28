"""Helpers for tables that must outlive an executor, and for joins with hot keys."""

from __future__ import annotations

import tempfile
import uuid
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Scratch:
    """Parquet tables in the shared folder that the cluster names in spark.checkpoint.dir.

    A written table cuts the lineage and survives lost executors. Where the setting is missing a temporary folder of
    this process takes its place, on a single machine only: a cluster must name the folder.
    """

    _own: str | None = None

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            Scratch._own = root = Scratch._own or tempfile.mkdtemp(prefix="gazetta-")
        self.spark, self.root = spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table; the shuffle files behind it are not needed any more and go."""
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        was = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(key, was)
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(f"{self.root}/{name}")

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, so that disk stays bounded."""
        for name in names:
            path, files = self._path(name)
            files.delete(path, True)

    def keep(self, *names: str) -> None:
        """Remove all tables but those that the result still reads."""
        path, files = self._path()
        for own in files.listStatus(path):
            if own.getPath().getName() not in names:
                files.delete(own.getPath(), True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Whole texts travel to Python in batches of so many rows and bytes at most, which bounds a worker's memory.

    Smaller limits of the session stay; the setting is read when a plan runs, so it holds from here on.
    """
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", 1 << 25)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def salted_join(many: DataFrame, one: DataFrame, key: str, salt: str, spread: int = 16, hot: int = 2000, keys: DataFrame | None = None) -> DataFrame:
    """Left join of `many` rows to at most one row per key, whose hot keys are spread over `spread` tasks by the column `salt`.

    Keys with more than `hot` rows are hot; only their rows of `one` are repeated, so the copies are fewer than
    rows / hot * spread. `many` is read three times; where it is dear, `keys` are other rows with the same keys to count by.
    """
    counts = (many if keys is None else keys).groupBy(key).count().where(F.col("count") > hot).select(key, F.lit(spread).alias("_n"))
    one = one.join(counts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_n")
    many = many.join(counts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(salt), F.coalesce("_n", F.lit(1))).cast("int")).drop("_n")
    return many.join(one, [key, "_salt"], "left").drop("_salt")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of edges (a, b): rows (id, root), root the smallest id, for every id of an edge.

    Each round hooks every label to its smallest neighbour, jumps pointers until they reach roots and relabels
    the edges by them, so a path of n ids needs a number of rounds in the order of log n; every step is a join
    or a partial aggregate, and nothing is gathered on the driver.
    """
    both = edges.where("a <> b").select("a", "b")
    live = scratch.write(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-live-0")
    labels, step = None, 0
    while labels is None or not live.isEmpty():
        step += 1
        around = live.union(live.select("b", "a"))
        up = around.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("up"))
        up, hop = scratch.write(up, f"{name}-up-{step}-0"), 0
        while True:  # two jumps a time
            jump = lambda x, by: x.join(by.select(F.col("id").alias("up"), F.col("up").alias("top")), "up", "left").select("id", F.coalesce("top", "up").alias("up"), *([F.col("was")] if "was" in x.columns else []))
            next_ = jump(jump(up.withColumn("was", F.col("up")), up), up)
            next_ = scratch.write(next_.select("id", "up", (F.col("up") < F.col("was")).alias("moved")), f"{name}-up-{step}-{hop + 1}")
            scratch.drop(f"{name}-up-{step}-{hop}")
            up, hop = next_.select("id", "up"), hop + 1
            if next_.where("moved").isEmpty():
                break
        if labels is None:  # every id of an edge has a label now
            new = scratch.write(up.select("id", F.col("up").alias("root")), f"{name}-label-{step}")
        else:
            new = scratch.write(labels.join(up.select(F.col("id").alias("root"), "up"), "root", "left").select("id", F.coalesce("up", "root").alias("root")), f"{name}-label-{step}")
        a, b = up.select(F.col("id").alias("a"), F.col("up").alias("x")), up.select(F.col("id").alias("b"), F.col("up").alias("y"))
        left = live.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        left = scratch.write(left, f"{name}-live-{step}")
        scratch.drop(f"{name}-label-{step - 1}", f"{name}-live-{step - 1}", f"{name}-up-{step}-{hop}")
        labels, live = new, left
    return labels


def packed(x) -> bytes:
    """A block of sums: places and values where few differ from zero, else all values, in as few bytes as hold them."""
    import numpy as np

    at, top = np.flatnonzero(x), np.abs(x).max()
    kind = np.dtype(np.uint8 if x.min() >= 0 and top < 256 and (x == np.floor(x)).all() else np.float32 if top < 1 << 24 else np.float64)
    few = len(at) * (2 + kind.itemsize) < len(x) * kind.itemsize
    return bytes([few, kind.itemsize]) + (at.astype(np.uint16).tobytes() + x[at].astype(kind).tobytes() if few else x.astype(kind).tobytes())


def unpacked(total, x: bytes) -> None:
    """Add what `packed` made of a block."""
    import numpy as np

    kind = np.dtype({1: np.uint8, 4: np.float32, 8: np.float64}[x[1]])
    if x[0]:
        n = (len(x) - 2) // (2 + kind.itemsize)
        total[np.frombuffer(x, np.uint16, n, 2)] += np.frombuffer(x, kind, n, 2 + 2 * n)
    else:
        total += np.frombuffer(x, kind, offset=2)


FAN = 256  # tasks whose pieces of a block are added first


def merged_pieces(parts: DataFrame, fold, last) -> DataFrame:
    """(block, sums): the pieces of every block made one, by `fold(block, pieces)` and in the end by `last(block, pieces)`, which both give bytes.

    `parts` has a row (block, part, sums) for each block and task, `part` the task's number. Pieces of FAN tasks become one first, so of each block a task of
    the second round reads one for every FAN tasks. Rows come in order and one by one, so a task holds one block however many they are.
    """

    def over(one):
        def run(batches):
            rows = (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(batch.num_rows))
            for (block, part), own in groupby(rows, key=lambda r: r[:2]):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([one(block, (x for _, _, x in own))], pa.binary())], ["block", "part", "sums"])

        return run

    kind = "block int, part int, sums binary"
    first = parts.select("block", F.floor(F.col("part") / FAN).cast("int").alias("part"), "sums").repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(over(fold), kind)
    return first.withColumn("part", F.lit(0)).repartition("block").sortWithinPartitions("block").mapInArrow(over(last), kind).select("block", "sums")


def dense_sum(df: DataFrame, task_sum, size: int, block: int = 1 << 12, finish=None):
    """Sum of one array of `size` numbers per task, as float64, or what `finish` makes of each block of it.

    `task_sum` turns a task's batches into its array. Arrays travel as blocks, are added by block in parallel, and
    `size` numbers reach the driver, whatever the input. A block has 65536 numbers at most.
    """
    import numpy as np

    finish = finish or (lambda x: x)

    def run(batches):
        total = np.asarray(task_sum(batches))
        task = TaskContext.get().partitionId()
        for k in (k for k in range(0, size, block) if total[k : k + block].any()):
            yield pa.RecordBatch.from_arrays([pa.array([k // block], pa.int32()), pa.array([task], pa.int32()), pa.array([packed(total[k : k + block])], pa.binary())], ["block", "part", "sums"])

    def added(k, pieces):
        total = np.zeros(min(block, size - k * block))
        for x in pieces:
            unpacked(total, x)
        return total

    none = finish(np.zeros(min(block, size)))
    out = [none[: len(none) * min(block, size - k) // min(block, size)] for k in range(0, size, block)]
    parts = df.mapInArrow(run, "block int, part int, sums binary")
    for r in merged_pieces(parts, lambda k, x: packed(added(k, x)), lambda k, x: finish(added(k, x)).tobytes()).toLocalIterator():
        out[r["block"]] = np.frombuffer(r["sums"], none.dtype)
    return np.concatenate(out)
