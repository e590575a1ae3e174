"""A corpus pipeline: toxic documents out, one of each near-duplicate group, no benchmark passages, secrets masked, mixed to targets.

Each stage reads what the one before wrote, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, secrets, simhash, toxicity
from tidemark.llm.common import stored
from tidemark.llm.queries import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No stage but the last could be said in SQL; the test holds the ids that run() leaves against the stages' own results, and lets 5 % of them be missing.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold of their language."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group; a null id counts as the largest."""
    return simhash.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture reads at all, with their posteriors, tokens, rate and copies."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels")).where(F.col("rate") > 0)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on the documents of a folder, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
