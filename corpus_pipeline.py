"""A corpus pipeline of five stages, each a Spark job over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineagrid.llm import decontaminate, line_dedup, minhash, mixing, toxicity
from lineagrid.llm.shared import table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under one half; learnt from all labels of documents that are here."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity") < 0.5).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated lines, with n_chars counted anew; those of which nothing is left go."""
    lines = line_dedup.dedup_lines(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return lines.withColumn("n_chars", length).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, once."""
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").dropDuplicates(["doc_id", "text"])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no item of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("kept").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often it takes them."""
    out = mixing.mix(docs).where(F.col("mix_copies") > 0)
    return out.select(*docs.columns, F.col("mix_copies").alias("copies"))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("minhash", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Scores of a fitted model and similarity joins can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
