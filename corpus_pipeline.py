"""The pipeline over ``documents``: language, lines, near copies, mix, packing.

Each stage takes the rows that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.boilerplate import dedup_lines
from hourgrid.llm.common import gone_at_exit, shared_folder, ship
from hourgrid.llm.language import UNDETERMINED, identify_language
from hourgrid.llm.mixing import mixed_documents
from hourgrid.llm.packing import pack_documents
from hourgrid.llm.queries import PIECES, WORDS
from hourgrid.llm.simhash import dedup_simhash


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of docs, with n_chars as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that the operator finds in no language."""
    found = identify_language(docs, vocabulary=PIECES)
    return found.filter(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines of many sites, but where they are first."""
    return _with_length(dedup_lines(docs), docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return dedup_simhash(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return _with_length(mixed_documents(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary=WORDS)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Neither trained models, tokenizers nor fingerprints can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored in the shared folder, until
    the session ends."""
    ship(spark)
    shared_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    gone_at_exit(spark, folder)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
