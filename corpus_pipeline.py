"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.llm import decontamination, mixing, secret_scan, simhash, toxicity
from affilix.llm.common import held_out, table
from affilix.session import materialize, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The lexicon is learned from labels of documents that are not held out."""
    learn = ~held_out(F.col("doc_id"), toxicity.PARTS, toxicity.HELD_OUT)
    lexicon = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), learn)
    return toxicity.remove_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents stay, with the length of the new text in ``n_chars``."""
    return secret_scan.redact_documents(docs, scratch_path(spark, "blob_ledger"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its domain probabilities, its rate and the copies to read of it.

    Domains are learned from the table the pipeline starts from, since hardly any toxic example is left of ``docs``. What
    was taken out as toxic is not asked for again.
    """
    learn = ~held_out(F.col("doc_id"), toxicity.PARTS, toxicity.HELD_OUT)
    labels = table(spark, sf_dir, "labels")
    domains = mixing.fit_domains(table(spark, sf_dir, "documents"), labels, learn)
    return mixing.mix(docs, labels, {**mixing.TARGETS, "toxic": 0.0}, keep=docs.columns, learn=learn, domains=domains)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_domains),
]

#: Trained scores and fingerprints have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus_{name}")
    return docs
