"""A training corpus from `documents`, in five stages, each written out and read by the next.

Stages take (spark, docs, sf_dir) and work on all rows they get; all but the last return the columns of documents.
NULL and letterless texts, and texts in no language of the labelled documents, end at the first stage. An empty table
stays empty. Of rows alike in id and text one stays, ties of the mix are drawn by id and text, and further columns are
kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.llm import decontam, langid, mixing, ngram_join, pii
from seatflow.runtime import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in; the model turns away texts in others."""
    model = langid.calibrated(langid.fit(docs), docs)
    own = {c: c if c == "text" else f"own_{c}" for c in docs.columns}  # documents may have a `score` of their own
    found = langid.predicted(docs.withColumnsRenamed(own), model).where(F.col("lang_pred") != langid.UNDECIDED)
    return found.select(*[F.col(name).alias(c) for c, name in own.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram join."""
    return ngram_join.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redacted(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, with the number of copies."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language), ("ngram_join", near_duplicates), ("decontaminate", benchmark),
    ("pii", personal_data), ("mix", mixture),
]
#: SQL can state no stage but the fourth; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
