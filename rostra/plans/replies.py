"""Replies of a model, each asked for once and kept.

A reply is known by a digest of model and prompt. Equal prompts are one question, known
ones are answered from the stored table, and a prompt that the scorer fails on becomes a
row with its error: the batch goes on, and a later run asks that prompt again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.sources.shipping import ship
from rostra.sources.tables import Tables

TABLE = "silver_model_replies"
SCHEMA = "prompt_digest string, model string, raw_response string, error string"
# Prompts that a scorer gets at once.
BATCH = 64


def prompt_digest(model: str, prompt: Column) -> Column:
    return F.sha2(F.concat(F.lit(model), F.lit("\0"), F.coalesce(prompt, F.lit(""))), 256)


def _answers(scorer: Callable[[list[str]], list[str]], prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(reply, error) of every prompt; a batch that fails is asked one by one."""
    try:
        replies = scorer(prompts)
        if len(replies) != len(prompts):
            raise ValueError(f"{len(replies)} replies to {len(prompts)} prompts")
        return [(reply, None) for reply in replies]
    except Exception as failure:  # noqa: BLE001  a scorer is foreign code
        if len(prompts) == 1:
            return [(None, f"{type(failure).__name__}: {failure}")]
        return [answer for prompt in prompts for answer in _answers(scorer, [prompt])]


def ask(
    rows: DataFrame,
    scorer: Callable[[list[str]], list[str]],
    tables: Tables,
    model: str,
    prompt: str = "prompt",
) -> DataFrame:
    """The rows with ``raw_response`` and ``error``.

    New replies are appended to the table ``silver_model_replies`` before they are used, so
    a run that breaks off afterwards asks nothing twice. Of several stored replies to a
    prompt one without an error counts, else the error is passed on.
    """
    ship(tables.spark)
    tables.create_if_missing(TABLE, SCHEMA)
    digest = prompt_digest(model, F.col(prompt))
    asked = rows.select(digest.alias("prompt_digest"), F.coalesce(prompt, F.lit("")).alias("prompt"))
    # Equal prompts are one row before any text is compared.
    answered = tables.read(TABLE).where("error IS NULL").select("prompt_digest")
    new = asked.dropDuplicates(["prompt_digest"]).join(answered, "prompt_digest", "left_anti")

    def reply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), BATCH):
                part = frame.iloc[start : start + BATCH]
                found = _answers(scorer, part["prompt"].tolist())
                yield pd.DataFrame({
                    "prompt_digest": part["prompt_digest"].tolist(),
                    "model": model,
                    "raw_response": [r for r, _ in found],
                    "error": [e for _, e in found],
                }, dtype=object)

    tables.append(TABLE, new.mapInPandas(reply, SCHEMA))
    stored = tables.read(TABLE).where(F.col("model") == model)
    # A prompt may have failed before it was answered.
    best = stored.groupBy("prompt_digest").agg(
        F.min(F.struct(F.col("error").isNotNull().alias("failed"), "raw_response", "error")).alias("best")
    )
    found = best.select(F.col("prompt_digest").alias("_digest"), "best.raw_response", "best.error")
    return rows.withColumn("_digest", digest).join(found, "_digest", "left").drop("_digest")
