"""From raw documents to packed training sequences: quality rules, near-dedup, substring dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicspark.llm.mixing import mixed
from civicspark.llm.near_dedup import one_of_each
from civicspark.llm.packing import pack
from civicspark.llm.quality_rules import good_documents
from civicspark.llm.substring_dedup import without_repeats
from civicspark.session import cut, drop_cut, reading


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mix_sources", mix), ("packing", packing)]

#: Learned rules, banding and packing can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        kept = cut(out)
        drop_cut(out)
        drop_cut(docs)
        docs = kept
    return reading(STAGES[-1][1](spark, docs, sf_dir), docs)
