"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the ASCII white space that separates words.
SPACES = "\\x20\\x09-\\x0D"
# Characters of text that a task works on at once; a longer text is a block of its own.
BLOCK_CHARS = 4_000_000


def n_words(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def training(doc_id: Column, modulus: int, held_out: int) -> Column:
    """True for rows whose crc32 of the id (as text; null as empty) is not held out."""
    digits = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(digits.cast("binary")), F.lit(modulus)) != held_out


def schema_with(rows: DataFrame, *columns: str) -> str:
    """DDL of the rows' own columns followed by new ones."""
    own = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return ", ".join([*own, *columns])


def packed(rows: DataFrame) -> Column:
    """All columns as one struct, so that columns beside it cannot clash with theirs."""
    return F.struct(*[F.col(f"`{name.replace('`', '``')}`") for name in rows.columns])


# What this Python worker keeps from one task to the next, by key: one thing at most.
_kept: dict[str, Any] = {}


def kept(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once for each worker and key; what was kept under another key goes."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget(but: str | None = None) -> None:
    """Give back what this worker keeps under another key. Spark hands the same workers to all
    operators in turn, so what one keeps would lie beside what the next one needs."""
    if _kept and but not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_CHARS, keeps: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts have about ``limit`` bytes together.

    ``keeps`` is the key of what the caller has ``kept``; anything else is given back.
    """
    forget(keeps)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is empty."""
    whole = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return raw[first : int(offsets[-1]) if len(offsets) else 0], offsets - first


def lower_table() -> np.ndarray:
    """Byte to byte, A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def append_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions that were started without it."""
    context = spark.sparkContext
    if getattr(context, "_rostra_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rostra-")) / "rostra.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._rostra_shipped = True
