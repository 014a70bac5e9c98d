"""The corpus pipeline over ``documents``: the quality classifier rejects bad
documents, one document of each near-duplicate group stays, the rest is mixed
to target weights, and every text is encoded. Stages but the last return the
columns of documents; mixing repeats a row as often as its rate says."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridelens.llm import byte_bpe, minhash_dedup, mixing, quality
from ridelens.llm.shared import materialise, read

#: Target shares of the expected tokens; the noisy ones went in the first stage.
TARGETS = {"clean": 0.95, "toxic": 0.05}


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash_dedup.keep_one(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its fitted rate says."""
    return mixing.resample(docs, mixing.labelled_domains(read(spark, sf_dir, "labels")), TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every row."""
    return byte_bpe.digests(byte_bpe.encode_and_decode(docs), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("mix_to_targets", mix_to_targets),
    ("encode", encode),
]

#: The stages train models and merge byte pairs; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole of what its predecessor kept, each written
    as Parquet in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
