"""One query per operator over the given tables, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.llm import (
    chat_format, decontamination, html_text, language_id, line_dedup, mixing, periodic_runs,
    token_alignment, quality_classifier, quality_rules, secret_scan, simhash,
    toxicity,
)
from affilix.llm.common import held_out, table
from affilix.llm.sql import ORACLES  # noqa: F401


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_format.digest(chat_format.format_conversations(turns))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), toxicity.PARTS, toxicity.HELD_OUT)
    lexicon = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~kept_back)
    return toxicity.score_documents(docs, lexicon).select("doc_id", kept_back.alias("held_out"), "score", "predicted")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learn_and_identify(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = ~held_out(F.col("doc_id"), toxicity.PARTS, toxicity.HELD_OUT)
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=learn)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), quality_classifier.PARTS, quality_classifier.HELD_OUT)
    model = quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels"), ~kept_back)
    return quality_classifier.score_documents(docs, model).select(
        "doc_id", kept_back.alias("held_out"), "score", "predicted"
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.detect(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_html_text, op3_chat_format, op4_secret_scan, op5_toxicity, op6_language_id, op7_mixing,
    op8_decontaminate, op9_quality_rules, op10_quality_classifier, op11_token_alignment, op12_line_dedup,
    op13_periodic_runs,
)}



def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
