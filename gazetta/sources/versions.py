"""Tables that are replaced whole: a version is written aside and one rename makes it the table.

Below a table's folder, data of every write lie in a folder of their own, and `_manifest` has a numbered file for each
version, which names the folders that the version consists of, one for each part (a partition value, or '' for a table
without parts). A write ends with the rename of a finished manifest to the next number: before it readers see the old
version whole, behind it the new one. A writer that fails leaves folders that no manifest names; two writers from one version
cannot both take its next number, so the second fails and nothing is lost.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    """The few file operations that a table needs, on whatever store its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """A file that appears whole under a new name, or not at all."""
        aside = self.path(f"_aside-{uuid.uuid4().hex}")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        whole = self.fs.makeQualified(aside)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), self.conf)
        self.fs.mkdirs(self.path(name).getParent())
        try:
            context.rename(whole, self.fs.makeQualified(self.path(name)), self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            self.fs.delete(aside, False)
            raise ValueError("another writer has replaced the table") from e

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """(number, folder of each part) of the latest version, (0, {}) where there is none."""
    files = Files(spark, path)
    names = files.names("_manifest")
    return (int(names[-1]), json.loads(files.read(f"_manifest/{names[-1]}"))) if names else (0, {})


def replace(df: DataFrame, path: str, part: str | None = None, form: str = "parquet", base: tuple[int, dict[str, str]] | None = None) -> int:
    """Replace the table, or one part of it while all others stay, and return the new version's number.

    The version that is replaced is the one read at the start, or `base`; if another writer has been faster, this one fails.
    """
    spark = df.sparkSession
    number, parts = base or current(spark, path)
    folder = f"data-{uuid.uuid4().hex}"
    df.write.format(form).save(f"{path.rstrip('/')}/{folder}")
    parts = {"": folder} if part is None else parts | {part: folder}
    Files(spark, path).publish(f"_manifest/{number + 1:012d}", json.dumps(parts, ensure_ascii=False, sort_keys=True))
    return number + 1


def remove_part(spark: SparkSession, path: str, part: str) -> int:
    """A version without one part."""
    number, parts = current(spark, path)
    Files(spark, path).publish(f"_manifest/{number + 1:012d}", json.dumps({k: v for k, v in parts.items() if k != part}, ensure_ascii=False, sort_keys=True))
    return number + 1


def read(spark: SparkSession, path: str, schema: str, form: str = "parquet", version: int | None = None, column: str | None = None, **options: str) -> DataFrame:
    """The table as its latest version is, or an earlier one; `column` gets each row's part. Without a version it is empty."""
    if version is None:
        _, parts = current(spark, path)
    else:
        parts = json.loads(Files(spark, path).read(f"_manifest/{version:012d}"))
    out = spark.createDataFrame([], schema)
    if parts:
        out = spark.read.format(form).schema(schema).options(**options).load([f"{path.rstrip('/')}/{f}" for f in parts.values()])
    if column is not None:
        named = F.create_map(*(F.lit(v) for p, f in parts.items() for v in (f, p))) if parts else F.create_map().cast("map<string,string>")
        out = out.withColumn(column, F.try_element_at(named, F.regexp_extract("_metadata.file_path", "/(data-[0-9a-f]{32})/", 1)) if parts else F.lit(None).cast("string"))
    return out


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove folders that none of the latest `keep` versions names, and older manifests; for times without a writer. Returns how many folders went."""
    files = Files(spark, path)
    numbers = files.names("_manifest")
    used = {f for n in numbers[-keep:] for f in json.loads(files.read(f"_manifest/{n}")).values()}
    gone = [f for f in files.names("") if f.startswith(("data-", "_aside-")) and f not in used]
    for f in gone:
        files.remove(f)
    for n in numbers[:-keep]:
        files.remove(f"_manifest/{n}")
    return len(gone)
