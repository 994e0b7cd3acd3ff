"""From raw documents to a mixed, encoded corpus.

Each stage works on all rows that its predecessor kept. Stages are written as Parquet and
read back in between, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm import bpe, langid, linededup, mixing, simhash
from rostra.llm.common import ship, training
from rostra.sources.tables import released

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or far from every language go.

    The model learns from the labelled rows among the documents that are not held out.
    """
    ship(spark)
    model = langid.fit(docs.where(training(F.col("doc_id"), 5, 0)))
    kept = langid.predict(docs, model).where(~F.col("rejected"))
    return kept.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template an earlier document has; ``n_chars`` follows."""
    ship(spark)
    kept = linededup.drop_recurring_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Near duplicates have SimHash fingerprints, of shingles of four words, that differ in at
    most four bits.
    """
    ship(spark)
    return simhash.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return found.select("doc_id", "lang", "source", "n_chars", "ids", "n_tokens", same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The first and last stage are beyond SQL; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        # What a stage wrote on its way goes when its documents are written.
        with released(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
