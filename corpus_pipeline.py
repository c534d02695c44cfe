"""From raw documents to token ids: five stages, each one of the llm operators, each written as Parquet and read again by the next.

Rows of ``documents`` (doc_id, text, lang, source, n_chars) go in; all stages but the last return these columns. Nulls, empty tables, repeated rows and
extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.llm import bpe, langid, lines, mixing, setjoin
from tierwork.llm.ship import ship
from tierwork.sources.storage import fresh_dir

KEPT_PIECES = 200_000  # a worker also holds what the stages before left of its memory; fewer pieces only take longer
LEAST_SCORE = 0.3  # pooled probability below which no language is believed


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts, texts without a letter and undecided ones go."""
    return langid.keep_identified(docs, least_score=LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source are taken out; every document stays, its n_chars follow its text."""
    cleaned = lines.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8 the one with the least doc_id stays."""
    return setjoin.keep_one_of_each(docs, shingle=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.repeat_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    return bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, kept=KEPT_PIECES)


def _shipped(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(f.__name__, _shipped(f)) for f in (language, line_dedup, near_duplicates, mix, encode)]
ORACLE_SQL = None  # a trained network and token merges are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        to = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(to)
        docs = spark.read.parquet(to)
    return STAGES[-1][1](spark, docs, sf_dir)
