"""Queries over the whole driver tables, one for each operator, with their settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .ann import nearest
from .chat import format_tree, read_back
from .decontam import contaminated
from .importance import resample
from .jaccard import jaccard_classes
from .langid import identify
from .mixing import score
from .packing import pack
from .pii import report as pii_report
from .quality import classify
from .repair import damaged, repairs
from .secrets import report
from .urls import judge


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op2_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return classify(table(spark, sf_dir, "documents"), labels)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = told.unionByName(spark.createDataFrame(control, "conv_id long, turn long, role string, text string"))
    vocabulary = tokenizer("byte_bpe_50k.json")
    return read_back(*format_tree(rows, vocabulary), vocabulary)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), added=True)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good = labels.where("quality is not null").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good"))
    return judge(table(spark, sf_dir, "pages"), good)


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs(damaged(table(spark, sf_dir, "conversations")))


def op12_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return sql.ORACLES
