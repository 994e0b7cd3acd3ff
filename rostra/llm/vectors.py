"""Vectors in Arrow batches as matrices, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrices(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Width, row numbers and matrix of the vectors of each width.

    Vectors that are null or empty, or hold a null or non-finite entry, are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(lengths) - lengths
    for width in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == width)
        matrix = flat[starts[rows][:, None] + np.arange(width)]
        whole = np.isfinite(matrix).all(axis=1)
        if whole.any():
            yield width, rows[whole], matrix[whole]


def floored(matrix: np.ndarray, scale: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Entries times ``scale``, rounded down, of the rows whose entries are all within ``most``; which rows."""
    scaled = np.floor(matrix * float(scale))
    fits = (np.abs(scaled) <= most).all(axis=1)
    return scaled[fits].astype(np.int64), fits


def usual_width(counts: DataFrame) -> tuple[int, int] | None:
    """The ``width`` that most rows (``n``) have, of several the least, and its rows; None without rows."""
    found = counts.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "width").first()
    return None if found is None else (found["width"], int(found["n"]))
