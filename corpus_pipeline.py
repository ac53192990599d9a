"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointframe.llm.common import materialize
from pointframe.llm.decontaminate import drop_contaminated
from pointframe.llm.exact_dedup import drop_duplicates_exact
from pointframe.llm.jaccard_join import drop_near_duplicates
from pointframe.llm.mixing import mix
from pointframe.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go; the models learn from ``labels``."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return drop_duplicates_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (Jaccard of 5-word shingles 0.8 or more) one document stays."""
    return drop_near_duplicates(docs)


def clean_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per document it takes words of, with how many and where they go."""
    return mix(docs).where("taken > 0").select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "passes", "rest", "taken", "shard", "position")


STAGES = [("toxicity", toxicity), ("exact", exact), ("near", near), ("benchmark", clean_benchmark), ("mix", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# the toxicity scores, the random draw of the mix and the seeds are not expressible in SQL
ORACLE_SQL = None
