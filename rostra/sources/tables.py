"""Parquet tables: guarded writes, versioned rewrites, schema evolution, staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version="
PUBLISHED = "_PUBLISHED"
# Digests and ids make up much of a table; zstd halves their hexadecimal digits, Spark's default keeps them.
COMPRESSION = "zstd"


def write_table(
    rows: DataFrame, path: str, require_rows: bool = True, partition_by: list[str] | None = None
) -> int:
    """Replace ``path`` and return the number of rows written.

    The rows are written beside the old ones and counted meanwhile, so the plan runs
    once; only then the folders change places. An empty result raises when rows are
    required, and a failure at any point leaves the old rows as they were.
    """
    spark = rows.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    counted = Observation()
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(beside)
    written = counted.get["rows"]
    new, files = _located(spark, beside)
    if require_rows and not written:
        files.delete(new, True)
        raise RuntimeError(f"no rows for {path}")
    target, _ = _located(spark, path)
    old, _ = _located(spark, f"{beside}.old")
    if files.exists(target) and not files.rename(target, old):
        raise RuntimeError(f"{path} cannot be replaced")
    try:
        if not files.rename(new, target):
            raise RuntimeError(f"{path} cannot be written")
    except Exception:
        if files.exists(old):
            files.rename(old, target)
        raise
    files.delete(old, True)
    spark.catalog.refreshByPath(path)
    return written


def _located(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def spread(rows: DataFrame) -> DataFrame:
    """Scan split over all cores when its files give fewer partitions than that.

    For work that is heavy per row, such as searching texts. A large table already
    has more partitions than cores and is returned as it is, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


class Tables:
    """Named Parquet tables under one root, each a sequence of published versions.

    A rewrite may read the table it replaces: the new version is written beside the
    old one and becomes current only when it is complete. Readers of the old
    version are not disturbed, and a failed job leaves nothing visible.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self, name: str, folder: str) -> list[str]:
        path, files = _located(self.spark, f"{self.root}/{name}/{folder}")
        return sorted(e.getPath().getName() for e in files.listStatus(path)) if files.exists(path) else []

    def _versions(self, name: str) -> list[tuple[int, str, bool]]:
        """Published versions in order: number, folder, and whether it adds to the one before.

        A version is published by a file named by its number that tells the other two. It
        comes into being whole, by a rename.
        """
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString
        found = []
        for leaf in self._entries(name, PUBLISHED):
            path, files = _located(self.spark, f"{self.root}/{name}/{PUBLISHED}/{leaf}")
            stream = files.open(path)
            try:
                kind, folder = text(stream, "UTF-8").split("-", 1)
            finally:
                stream.close()
            found.append((int(leaf), folder, kind == "added"))
        return sorted(found)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def _current(self, name: str) -> list[str]:
        """Folders of the last whole version and of what was added since."""
        folders: list[str] = []
        for _, folder, added in self._versions(name):
            folders = [*folders, folder] if added else [folder]
        return folders

    def read(self, name: str) -> DataFrame:
        folders = self._current(name)
        if not folders:
            raise LookupError(f"no table {name} under {self.root}")
        return self.spark.read.option("mergeSchema", len(folders) > 1).parquet(
            *[f"{self.root}/{name}/{folder}" for folder in folders]
        )

    def _publish(self, name: str, rows: DataFrame, require_rows: bool, kind: str) -> DataFrame:
        number = max((n for n, _, _ in self._versions(name)), default=0) + 1
        folder = f"{VERSION}{number:06d}-{uuid.uuid4().hex}"
        write_table(rows, f"{self.root}/{name}/{folder}", require_rows)
        # The marker is named by its number alone and comes into being by one rename, which
        # succeeds for one writer only: a run that breaks off before it leaves nothing that counts.
        beside, files = _located(self.spark, f"{self.root}/{name}/{folder}/_marker")
        out = files.create(beside, False)
        out.write(bytearray(f"{kind}-{folder}".encode()))
        out.close()
        marker, _ = _located(self.spark, f"{self.root}/{name}/{PUBLISHED}/{number:06d}")
        files.mkdirs(marker.getParent())
        if files.exists(marker) or not files.rename(beside, marker):
            raise FileExistsError(f"version {number} of {name} exists: another writer published it")
        return self.read(name)

    def write(self, name: str, rows: DataFrame, require_rows: bool = True) -> DataFrame:
        """Write and publish a new version, and return it as read back from storage."""
        return self._publish(name, rows, require_rows, "whole")

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """Publish a version that has the rows of the last one and these; only these are written."""
        return self._publish(name, rows, False, "added")

    def expire(self, name: str) -> int:
        """Delete the folders of versions that the current one does not need; returns how many."""
        keep = {*self._current(name), PUBLISHED}
        published = {folder for _, folder, _ in self._versions(name)}
        gone = [leaf for leaf in self._entries(name, "") if leaf in published - keep]
        for leaf in gone:
            path, files = _located(self.spark, f"{self.root}/{name}/{leaf}")
            files.delete(path, True)
        return len(gone)

    def create_if_missing(self, name: str, schema: T.StructType | str) -> DataFrame:
        if not self.exists(name):
            self.write(name, self.spark.createDataFrame([], schema), require_rows=False)
        return self.read(name)


def write_colocated(
    rows: DataFrame, table: str, path: str, key: str, buckets: int, placed: bool = False
) -> DataFrame:
    """Store rows bucketed and sorted by a key, and return the table as read back.

    Tables with the same key and number of buckets meet in joins, aggregates and windows
    on that key where they lie: none of them is shuffled. A bucket is written by one task,
    as one file, whatever the number of shuffle partitions; take as many buckets as keep
    the largest one within a task. ``table`` is a name in the session's catalog for the
    files under ``path``; dropping it leaves the files.

    ``placed`` rows come from a join or an aggregate by the key, of as many partitions as
    buckets: they are written from where they lie, and not shuffled again.
    """
    if not placed:
        rows = rows.repartition(buckets, F.pmod(F.hash(key), F.lit(buckets)))
    writer = rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
    writer = writer.option("compression", COMPRESSION)
    writer.mode("overwrite").saveAsTable(table)
    return rows.sparkSession.table(table)


def with_missing_columns(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add typed NULL columns that are not there yet; existing ones are left alone."""
    missing = {
        name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in rows.columns
    }
    return rows.withColumns(missing) if missing else rows


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own, once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="rostra-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Folders that each open ``released`` block has written, the innermost last.
_open_blocks: list[list[str]] = []


def materialize(rows: DataFrame) -> DataFrame:
    """Compute once, write to the shared folder and read back.

    Everything built on the result sees the same rows, whichever executor is lost.
    """
    location = f"{_session_folder(rows.sparkSession)}/{uuid.uuid4().hex}"
    if _open_blocks:
        _open_blocks[-1].append(location)
    rows.write.option("compression", COMPRESSION).parquet(location)
    written = rows.sparkSession.read.schema(rows.schema).parquet(location)
    written._rostra_location = location
    return written


def release(*tables: DataFrame) -> None:
    """Remove what ``materialize`` wrote for these tables, which nothing reads any more."""
    for rows in tables:
        folder, files = _located(rows.sparkSession, rows._rostra_location)
        files.delete(folder, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose ``materialize`` folders are removed at its end.

    Gives a function that writes a result to outlive the block: ``keep(rows)`` belongs
    to the enclosing block, if there is one.
    """
    mine: list[str] = []
    _open_blocks.append(mine)

    def keep(rows: DataFrame) -> DataFrame:
        _open_blocks.remove(mine)
        try:
            return materialize(rows)
        finally:
            _open_blocks.append(mine)

    try:
        yield keep
    finally:
        _open_blocks.remove(mine)
        for location in mine:
            folder, files = _located(spark, location)
            files.delete(folder, True)


def _session_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/rostra-{spark.sparkContext.applicationId}"


def clear_materialized(spark: SparkSession) -> None:
    """Remove what ``materialize`` has written in this session, once its results are stored."""
    folder, files = _located(spark, _session_folder(spark))
    files.delete(folder, True)
