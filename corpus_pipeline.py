"""A training-corpus pipeline: five stages, each one of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.

1. ``language``: texts without a language (null, or no letter) go, and so do texts that
   share less than ``LEAST_KNOWN`` of their n-grams with the landmarks of the model: other
   scripts, mostly.  Of the texts at sf0.1 none is below 0.73; Chinese, Greek,
   Korean or Russian ones have 0.13 at most.
2. ``near_duplicates``: of each class of the n-gram Jaccard join one text stays, the one
   with the smallest ``doc_id``.
3. ``decontaminate``: texts that hold a window of a benchmark item go.
4. ``secrets``: stretches that hold secrets, encoded ones included, are masked.
5. ``tokens``: SentencePiece ids of every text, checked by decoding.

Null, empty, repeated and very long texts, empty tables and further columns are handled
as the operators say.  No stage has SQL that could state it as a whole (language and
tokens are models), so the result is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm import decontaminate, jaccard, language, pieces, secrets
from tunesmith.llm.catalog import TOKENIZER, table
from tunesmith.llm.common import prepare
from tunesmith.session import store


#: Part of the n-grams of a text that the landmarks must have.
LEAST_KNOWN = 0.35


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts in one of the learnt languages."""
    prepare(spark)
    model = language.train(language.trained_rows(docs), "text", "lang")
    rows = docs.select(F.struct("*").alias("row"), "text")
    done = language.identify(rows, model, least_known=LEAST_KNOWN)
    return done.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each class of near copies."""
    return jaccard.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts without benchmark windows."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    done = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"))
    return done.where("n_hit = 0").select("row.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets of every text."""
    return secrets.redacted(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    """Token ids of every text."""
    done = pieces.encoded(docs.select("doc_id", "lang", "source", "text"), pieces.load_model(model))
    return done.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
