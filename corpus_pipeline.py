"""A corpus pipeline: quality rules, line dedup, near duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
as a Parquet table in the shared folder and reads it back for the next one.
The order that mixing gives is that of the table's files and of the rows in
them; the last stage returns it as a column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, linededup, mixing, neardup, quality
from millrace.llm.common import table, written
from millrace.llm.queries import TOKENIZER


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.filter_quality(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of repeated three-line windows."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources."""
    return mixing.in_mixed_order(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers and digests of each document's ids and decoded text, and its position in the mixture."""
    placed = mixing.with_position(docs)
    key = F.struct(F.col("doc_id").alias("doc_id"), F.col(placed.columns[-1]).alias("mix_position"))
    coded = bpe.bpe_digests(placed.select(key.alias("key"), "text"), TOKENIZER, id_column="key")
    return coded.select("key.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "key.mix_position")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", keep_one_of_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: MinHash candidates and the schedule have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
