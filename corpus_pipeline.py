"""Cleaning of a document table for training: the stages below, one after the other.

Each stage is written as a table and read again as the documents of the next. Null texts count as empty throughout;
repeated rows fall to exact deduplication; an empty table passes through. All stages but the last return the columns
that they are given, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pageloom.llm import bpe, decontam, exact_dedup, simhash, toxicity
from pageloom.llm.queries import TOKENIZERS
from pageloom.llm.shared import let_workers_import, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labelled ones that are not held out."""
    let_workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.remove_toxic(docs, toxicity.fit_on(docs, labels))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest id."""
    let_workers_import(spark)
    return exact_dedup.drop_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by SimHash links, the one with the smallest id."""
    let_workers_import(spark)
    return simhash.drop_near_duplicates(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    let_workers_import(spark)
    return decontam.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document ids with their token ids, number of tokens, and digest of the text decoded from the ids."""
    let_workers_import(spark)
    coded = bpe.encode(docs.select("doc_id", "text"), TOKENIZERS + "word_bpe_49k.json", decoded=True)
    return coded.selectExpr("doc_id", "CAST(size(ids) AS BIGINT) AS n_tokens", "ids", "sha2(decoded, 256) AS decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_exact_copies),
    ("simhash_near_dedup", remove_near_copies),
    ("decontamination", remove_leaks),
    ("bpe_encoding", encode),
]

#: Toxicity, SimHash, window search and BPE have no SQL; the tests hold run() against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
