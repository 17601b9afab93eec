"""A corpus pipeline of five operators: language, near duplicates, benchmark passages, source weights, packed ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, in the columns of documents; the last returns packed
rows. A stage reads all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm import decontaminate, jaccard, langid, mixing, packing
from beaconlake.llm.common import filtered, prepared, read, spare_prefix
from beaconlake.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; it learns from the labelled documents."""
    prepared(spark)
    out = spare_prefix(docs.columns) + "language"
    found = langid.identify(docs, langid.fit(docs), out=out)
    return found.where(~F.col(out + ".rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    prepared(spark)
    return jaccard.without_copies(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    hits = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"), keys=True)
    return filtered(docs, hits.where(F.col("n_hit") > 0).select("key"), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and parts of documents that meet the weights of the sources."""
    prepared(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids of equal length."""
    prepared(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("clean_of_benchmark", clean_of_benchmark),
    ("mixture", mixture), ("packed", packed),
]
# Language identification and tokenizing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
