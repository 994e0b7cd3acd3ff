"""Registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rostra.llm import (
    ann, bpe, ctw, exactdedup, hardnegatives, langid, linededup, minhash, mixing, simhash,
    tokencount, urlfilter, whitening,
)
from rostra.llm.common import ship, training
from rostra.sources.tables import checkpoint_folder, materialize

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    import public_tokenizers

    docs = documents(spark, folder).select("doc_id", "text")
    path = public_tokenizers.path(BPE_FILE)
    found = bpe.digests(docs, path, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines whose template an earlier document has."""
    docs = documents(spark, folder).select("doc_id", "text")
    return linededup.drop_recurring_lines(docs)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    ship(spark)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return ann.search(rows, F.pmod(F.col("vec_id"), F.lit(50)) == 0)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against a new digest index."""
    docs = documents(spark, folder).select("doc_id", "text")
    index = exactdedup.DigestIndex(spark, f"{checkpoint_folder(spark)}/digests-{uuid.uuid4().hex}")
    return index.add(docs)


def op6_ctw(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document, learned from six sevenths of them."""
    docs = documents(spark, folder).select("doc_id", "text")
    return ctw.score(docs, training(F.col("doc_id"), 7, 2))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = documents(spark, folder).select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and tokens of every document."""
    import public_tokenizers

    docs = documents(spark, folder).select("doc_id", "text")
    counted = tokencount.count_tokens(docs, tokencount.read_pieces(public_tokenizers.path(PIECE_FILE)))
    return counted.select("doc_id", "n_words", "n_tokens")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every url."""
    texts = documents(spark, folder).select("text")
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return urlfilter.judge(pages, texts).select("page_id", "host", "path", "rule", "verdict", "log_odds")


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    model = langid.fit(docs.where(training(F.col("doc_id"), 5, 0)))
    return langid.predict(docs, model).select(
        "doc_id", (~training(F.col("doc_id"), 5, 0)).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten negatives for each positive of every hundredth vector."""
    ship(spark)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(rows, F.col("vec_id") % 100 == 0, label=label)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the first eight components, one row for each."""
    ship(spark)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = whitening.fit(rows)
    if model is None:
        return spark.createDataFrame([], columns)
    found = materialize(whitening.whiten(rows, model).select("vec_id", "whitened", "deviation"))
    count = model.count()
    shares = F.array(*[F.lit(float(e / model.total)) for e in model.values[:count]]).cast("array<double>")
    return found.select(
        "vec_id", F.posexplode("whitened").alias("at", "white"), F.expr("try_cast(deviation AS long)").alias("deviation")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("white").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(whitening.identity_error(found, count)).alias("identity_error"),
    )


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles and component of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    return minhash.near_duplicates(docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_neighbours": op4_neighbours,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_ctw": op6_ctw,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_url_filter": op9_url_filter,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_minhash": op13_minhash,
}
