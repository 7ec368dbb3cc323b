"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, fim, langid, linededup, lm, media, mixing, neardup, phrases, quality, toxicity, warc
from millrace.llm.common import remainder, scratch_path, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_report(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    net = langid.fit(docs.filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), langid.language(net, F.col("text")).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    records, gaps = warc.read_records(spark, path)
    lost = gaps.limit(1).collect()
    if lost:
        raise ValueError(f"archives just written have gaps, such as {lost[0]}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(table(spark, sf_dir, "documents"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 7) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("training"))
    scores = lm.score_texts(docs, "training", order=3, spread_unseen=True, min_context=2)
    return scores.withColumn("held_out", held_out)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    model = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_linededup": op1_linededup,
    "op2_language": op2_language,
    "op3_jaccard": op3_jaccard,
    "op4_bpe": op4_bpe,
    "op5_mixing": op5_mixing,
    "op6_warc": op6_warc,
    "op7_media": op7_media,
    "op8_lm": op8_lm,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_phrases": op11_phrases,
    "op12_decontamination": op12_decontamination,
    "op13_fim": op13_fim,
}

ORACLE_SQL: dict[str, str] = {
    "op1_linededup": linededup.REPORT_SQL,
    "op6_warc": warc.RECORDS_SQL,
    "op9_quality": quality.REPORT_SQL,
    "op11_phrases": phrases.COLLOCATIONS_SQL,
    "op12_decontamination": decontam.REPORT_SQL,
    "op13_fim": fim.REPORT_SQL,
}
