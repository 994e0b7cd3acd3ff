"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte 2-grams and 3-grams: square-rooted counts times
inverse document frequency, scaled to length one. The document frequencies cover every
training row. The centroids are fitted by spherical k-means on a bounded sample of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import append_columns, blocks, byte_view, schema_with

DIMENSIONS = 8192
UNDETERMINED = "und"
# Texts that are vectors at the same time.
_CHUNK = 128


def _folding() -> np.ndarray:
    """Byte to byte: A-Z to a-z, everything else of ASCII to a space."""
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    table[:65] = table[91:97] = table[123:128] = 32
    return table


def _grams(column: pa.Array, dimensions: int) -> Iterator[np.ndarray]:
    """Hashed gram numbers of every text; shorter texts than a gram have none of it."""
    data, offsets = byte_view(column)
    codes = _folding()[data]
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x165667B1)
    shift = np.uint32(32 - dimensions.bit_length() + 1)
    two = (two * np.uint32(0x9E3779B1)) >> shift
    three = (three * np.uint32(0x9E3779B1)) >> shift
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield np.concatenate([two[a : max(a, b - 1)], three[a : max(a, b - 2)]])


def _counts(column: pa.Array, dimensions: int) -> Iterator[np.ndarray]:
    """Matrices of gram counts, a few texts at a time."""
    rows = []
    for grams in _grams(column, dimensions):
        rows.append(np.bincount(grams, minlength=dimensions))
        if len(rows) == _CHUNK:
            yield np.array(rows)
            rows = []
    if rows:
        yield np.array(rows)


def _vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    rows = np.sqrt(counts, dtype=np.float32) * weights
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(lengths > 0, lengths, 1)[:, None]


@dataclass(frozen=True)
class Model:
    """Weights of the grams, centroids with their languages, and the least accepted cosine."""

    weights: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: float


def _k_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centres are rows far from each other."""
    centres = [rows.mean(axis=0)]
    nearest = rows @ centres[0]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, rows @ centres[-1])
    centres = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = rows[own == c].mean(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]
    return centres


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: str = "doc_id",
    sample_rows: int = 2000,
    centroids: int = 4,
    dimensions: int = DIMENSIONS,
    strictness: float = 0.25,
) -> Model:
    """Learn from the rows whose text and language are not null.

    Document frequencies are counted over all of them. The centroids are fitted on at
    most ``sample_rows`` rows, the same number for each language, picked by a hash of
    ``order`` and the text, so that reruns agree. A text is rejected when its best
    cosine is less than ``strictness`` times what one per cent of the sample fall short of.
    Without any row, the model has no language and rejects every text.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(order).cast("string"), F.col(text)).alias("pick"),
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(dimensions, np.int64)
        n = 0
        for block in blocks(batches, "text"):
            for counts in _counts(block.column("text"), dimensions):
                seen += (counts > 0).sum(axis=0)
                n += len(counts)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {
                "gram": np.append(held, -1).astype(np.int32),
                "n": np.append(seen[held], n),
            }
        )

    # One row per gram number, so at most ``dimensions`` + 1 of them reach the driver.
    table = rows.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(
        F.sum("n").alias("n")
    )
    found = {r["gram"]: r["n"] for r in table.collect()}
    total = found.pop(-1, 0)
    per_gram = np.zeros(dimensions)
    per_gram[list(found)] = list(found.values())
    weights = np.log((1 + total) / (1 + per_gram)).astype(np.float32) + 1

    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model(weights, np.zeros((0, dimensions), np.float32), [], 1.0)
    quota = max(1, sample_rows // len(languages))
    # The share of each language that is expected to give a little more than its quota;
    # what is more is put back below.
    share = F.element_at(
        F.create_map(*[
            F.lit(v) for name in languages for v in (name, min(1.0, (quota + 4 * quota**0.5 + 10) / sizes[name]))
        ]),
        F.col("lang"),
    )
    spread = F.pmod(F.col("pick"), F.lit(1 << 30)) / float(1 << 30)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            held, values = [], []
            for counts in _counts(block.column("text"), dimensions):
                for row in counts:
                    held.append(np.flatnonzero(row).astype(np.int32))
                    values.append(row[held[-1]].astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": block.column("lang"),
                    "pick": block.column("pick"),
                    "grams": pa.array(held, pa.list_(pa.int32())),
                    "counts": pa.array(values, pa.list_(pa.int32())),
                }
            )

    sample = (
        rows.where(spread < share)
        .mapInArrow(sparse, "lang string, pick long, grams array<int>, counts array<int>")
        .toArrow()
    )
    names = np.array(sample["lang"].to_pylist())
    spot = sample["pick"].to_numpy() % (1 << 30)
    grams, counts = sample["grams"].to_pylist(), sample["counts"].to_pylist()
    centres, owners, cosines = [], [], []
    for name in languages:
        own = np.flatnonzero(names == name)
        own = own[np.argsort(spot[own], kind="stable")][:quota]
        matrix = np.zeros((len(own), dimensions), np.float32)
        for i, row in enumerate(own.tolist()):
            matrix[i, grams[row]] = counts[row]
        matrix = _vectors(matrix, weights)
        if len(matrix):
            found_centres = _k_means(matrix, centroids)
            centres.append(found_centres)
            owners += [name] * len(found_centres)
            cosines.append((matrix @ found_centres.T).max(axis=1))
    least = strictness * float(np.quantile(np.concatenate(cosines), 0.01))
    return Model(weights, np.concatenate(centres).astype(np.float32), owners, least)


def predict(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    A null text and one without a letter are ``und`` with score 0 and rejected. Others
    get the language of their nearest centroid, ties to the smaller name; they are
    rejected when even that one is farther than the model accepts. Without a learned
    language everything is ``und``. Columns of these names are replaced.
    """
    new = ["lang_pred string", "score double", "rejected boolean"]
    rows = rows.drop("lang_pred", "score", "rejected")
    # A model has a fixed number of grams and a few centroids per language.
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}")
        known = shared.value
        dimensions = len(known.weights)
        for block in blocks(batches, text):
            column = block.column(text)
            best, nearest = [], []
            for counts in _counts(column, dimensions):
                if known.languages:
                    cosines = _vectors(counts, known.weights) @ known.centroids.T
                    nearest += np.argmax(cosines, axis=1).tolist()
                    best += np.clip(cosines.max(axis=1), 0, 1).tolist()
            texts = column.to_pylist()
            told = [bool(known.languages) and t is not None and letter.search(t) is not None for t in texts]
            names = [known.languages[nearest[i]] if ok else UNDETERMINED for i, ok in enumerate(told)]
            scores = [best[i] if ok else 0.0 for i, ok in enumerate(told)]
            yield append_columns(
                block,
                lang_pred=pa.array(names, pa.string()),
                score=pa.array(scores, pa.float64()),
                rejected=pa.array([not ok or s < known.least for ok, s in zip(told, scores, strict=True)]),
            )

    return rows.mapInArrow(run, schema_with(rows, *new))
