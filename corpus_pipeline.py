"""Corpus preparation in five stages, each one operator over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of `documents`, the last one the packed
pieces. Between stages rows are written and read again, so a lost executor costs one stage's tasks at most. A row
without an id stands under a number made from its text, above all ids, so it is kept or dropped like any other; of rows that
repeat an id and a text one stays among its near copies; empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.decontam import contaminated
from gazetta.llm.jaccard import jaccard_classes
from gazetta.llm.langid import identify
from gazetta.llm.packing import pack
from gazetta.llm.queries import table, tokenizer
from gazetta.llm.secrets import redact
from gazetta.llm.shared import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; texts without a letter go."""
    return identify(docs).where(~F.col("rejected")).select(docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of their own, `_id`."""
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that 5-word shingles link at a similarity of 0.75."""
    docs = keyed(docs)
    state = jaccard_classes(docs, id_col="_id").groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("doc_id") != F.col("component_id")).alias("_gone"), F.count("*").alias("_times"))
    rest = docs.join(state.where("_gone or _times > 1"), "_id", "left").where("_gone is null or not _gone")
    again = rest.where("_times > 1").withColumn("_text", F.xxhash64("text")).dropDuplicates(["_id", "_text"])
    return rest.where("_times is null").unionByName(again.drop("_text")).select([c for c in docs.columns if c != "_id"])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    docs = keyed(docs)
    hit = contaminated(docs.select(F.col("_id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(hit, "_id", "left_anti").drop("_id")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask for every secret."""
    return redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), added=True)


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks), ("secrets", secrets), ("packing", packing)]
ORACLE_SQL = None  # language identification and SimHash are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
