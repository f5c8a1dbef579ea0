"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldlake.llm import decontaminate, mixing, ngram_join, toxicity
from fieldlake.llm.common import bounded_batches, table
from fieldlake.llm.queries import SHARES, coded_ids, quality_domains
from fieldlake.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _lean(spark: SparkSession, batch: int = 4 << 20) -> None:
    """Whole texts go through every stage: small Arrow batches and row groups keep executors within bounds."""
    bounded_batches(spark, batch)
    spark.conf.set("parquet.block.size", str(16 << 20))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the severity model rejects. It is fitted on the labelled documents among ``docs``."""
    _lean(spark)
    model = toxicity.fit(docs, toxicity.graded_labels(docs, table(spark, sf_dir, "labels")), "grade")
    return docs.filter(~toxicity.rejected(docs["text"], model))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest doc_id."""
    _lean(spark)
    return ngram_join.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    _lean(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its mixing rate says, at least once."""
    _lean(spark)
    model = mixing.train(docs, quality_domains(table(spark, sf_dir, "labels")), "domain")
    return mixing.resample(docs, model, SHARES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token-id files of all documents, and their digests as read back."""
    _lean(spark, 16 << 20)  # blocks of a batch are decoded in step: smaller batches would leave lanes empty
    return coded_ids(docs, together=512)  # the JVM holds more after four stages than alone


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token_ids", encode),
]

#: No stage but the last has an exact SQL form: models, SimHash and graph search decide.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
