"""The corpus pipeline: language, near duplicates, benchmark leaks, secrets, encoding.

Each stage works on all that its predecessor kept and returns the columns of
``documents``; the last one returns the ids of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import bpe, decontaminate, language, secrets, simhash
from threadloom.llm.batches import fresh, ready
from threadloom.session import drop_path, work_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A document goes if its language is undetermined or the belief in the best one is lower.
LEAST_BELIEF = 0.5
#: Words of a shingle, and the bits by which linked fingerprints may differ.
SHINGLE, MOST_BITS = 3, 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learnt languages."""
    ready(spark)
    name, score = fresh("_lang_pred", docs), fresh("_lang_score", docs)
    told = language.identify(docs, name=name, score=score)
    sure = (F.col(name) != language.UNDETERMINED) & (F.col(score) >= LEAST_BELIEF)
    return told.where(sure).drop(name, score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints, the one with the smallest id."""
    ready(spark)
    return simhash.keep_first(docs, radius=MOST_BITS, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    ready(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by ``[secret]`` and n_chars counted anew."""
    ready(spark)
    spans, hidden = fresh("_spans", docs), fresh("_masked", docs)
    masked = secrets.find_secrets(docs, name=spans, masked=hidden)
    changed = F.size(spans) > 0
    return masked.select(
        *[
            F.when(changed, F.col(hidden)).otherwise(F.col("text")).alias("text")
            if c == "text"
            else F.when(changed, F.char_length(hidden).cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids of every document."""
    ready(spark)
    return bpe.encode(docs, TOKENIZER, ("n_tokens", "token_ids"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]
#: Language models, fingerprints and merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; what a stage returns is written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:  # only the newest copy is still read
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
