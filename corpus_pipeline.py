"""From raw documents to a training mix: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, line_dedup, minhash, mixing, quality
from riskloom.llm.common import same_columns
from riskloom.session import pin
from riskloom.sources.applications import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go. It learns from rows of ``docs`` alone."""
    params = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, params, keep_text=True)
    return same_columns(scored.filter(F.col("_rl_score") >= quality.THRESHOLD), docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from texts, and documents of which nothing else is left."""
    left = line_dedup.without_recurring_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet their weights."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# The quality network and the minhash tables can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
