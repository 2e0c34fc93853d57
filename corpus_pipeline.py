"""From raw documents to a training mix: quality, near duplicates, benchmark passages, secrets, source weights.

Every stage gets the documents its predecessor kept and returns the rows that go on, with the columns of `documents`;
the last one adds the place of each copy in the training run. `run` writes each stage as Parquet and reads it again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import decontaminate, jaccard, mixing, nbsvm, secrets
from paperlake.session import materialize

#: Least score of the quality classifier.
MIN_QUALITY = 0.7
#: The quality model and the order of the mix can't be written in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    return docs.where(nbsvm.score(docs, F.col("text"), model) >= MIN_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar ones stays, the one with the smallest id."""
    return jaccard.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced inside the texts; n_chars follows."""
    cleaned = secrets.redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in training order; what the mix doesn't take goes."""
    return mixing.mix(docs).where(F.col("copy").isNotNull())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secret_spans),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
