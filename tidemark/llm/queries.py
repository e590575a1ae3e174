"""The registered queries of this subpackage, on the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, codes, collocations, decontam, katz, langid, mixing, packing, secrets, simhash, subword, suffixes, toxicity, twins
from tidemark.llm.common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op11_vector_codes": twins.VECTOR_CODES, "op12_collocations": twins.COLLOCATIONS}
#: The tokenizer of the packed sequences; any file of the `tokenizers` library will do.
TOKENIZER = "byte_bpe_50k.json"


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@registered
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


@registered
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 3))


@registered
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@registered
def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(table(spark, sf_dir, "documents"))


@registered
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


@registered
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@registered
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
