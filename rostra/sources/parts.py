"""Tables in parts: rewritten where keys were touched, and nowhere else.

A row lies in the part that a hash of its key names. An upsert reads and writes the parts
of its source rows alone, and exchanges their folders; files of all other parts stay
as they are. Parts are many enough that a batch meets a fraction of a table, and their
number is fixed for the life of a table, so a list of parts is always small.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostra.sources.tables import COMPRESSION, _located, materialize, release, write_table

PART = "part"
PARTS = 64
# Columns that rows have during an upsert, beside the part.
_NEW, _SLOT, _COPIES, _VALUE = "_new_in_upsert", "_slot_in_upsert", "_copies_in_upsert", "_value_in_upsert"
# Bytes of files that one task of an upsert takes of a part.
_TASK_BYTES = 32_000_000


def key_hash(*columns: str) -> Column:
    """One number for a key of one or several columns, NULL or not. Keys that share it are treated alike."""
    return F.xxhash64(*[F.col(c).isNull() for c in columns], *columns)


class PartedTable:
    """A Parquet table under ``path`` with the columns of ``schema``, in parts by ``key``.

    A run that breaks off while it replaces parts leaves each of them old or new; the
    same call again gives the same rows, as sources replace rows and do not add to them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], parts: int = PARTS):
        if PART in schema.names:
            raise ValueError(f"a column named {PART} would be taken for the number of the part")
        self.spark, self.path, self.schema, self.key, self.parts = spark, path.rstrip("/"), schema, key, parts

    def part(self) -> Column:
        return F.pmod(key_hash(*self.key), F.lit(self.parts)).cast("int")

    def _placed(self, rows: DataFrame) -> DataFrame:
        # Spark splits a part that is much larger than others and joins small ones.
        return rows.select(*self.schema.names, self.part().alias(PART)).hint("rebalance", PART)

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """All rows, or those of some parts; files of the others are not opened."""
        folder, files = _located(self.spark, self.path)
        if not files.exists(folder):
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self.path)
        if parts is not None:
            rows = rows.where(F.col(PART).isin(parts))
        return rows.drop(PART)

    def write(self, rows: DataFrame) -> None:
        """Replace the whole table."""
        write_table(self._placed(rows), self.path, require_rows=False, partition_by=[PART])

    def parts_of(self, rows: DataFrame, part: Column | None = None) -> list[int]:
        """Parts that the keys of the rows lie in."""
        placed = rows.select((self.part() if part is None else part).alias(PART)).distinct()
        return sorted(r[PART] for r in placed.collect())

    def replace(self, rows: DataFrame, parts: list[int], placed: bool = False) -> None:
        """From now on the given parts hold these rows, which must lie in them.

        ``placed`` rows have the number of their part, and are written from where they lie, as are rows with its column.
        """
        if not parts:
            return
        # The rows may come from the files that are replaced, so they are written beside them,
        # once; then the folders of the parts change places.
        beside = f"{self.path}.{uuid.uuid4().hex}"
        placed_rows = rows if placed or PART in rows.columns else self._placed(rows)
        placed_rows.write.option("compression", COMPRESSION).partitionBy(PART).parquet(beside)
        folder, files = _located(self.spark, self.path)
        aside, _ = _located(self.spark, f"{beside}.old")
        files.mkdirs(folder)
        files.mkdirs(aside)
        for number in parts:
            new, target, old = (
                _located(self.spark, f"{root}/{PART}={number}")[0] for root in (beside, self.path, f"{beside}.old")
            )
            if files.exists(target) and not files.rename(target, old):
                raise RuntimeError(f"{target} cannot be replaced")
            # A part without rows has no folder.
            if files.exists(new) and not files.rename(new, target):
                if files.exists(old):
                    files.rename(old, target)
                raise RuntimeError(f"{target} cannot be written")
        files.delete(_located(self.spark, beside)[0], True)
        files.delete(aside, True)
        self.spark.catalog.refreshByPath(self.path)

    def upsert(self, source: DataFrame) -> list[int]:
        """Source rows replace stored rows of the same key, the others are added; returns the parts touched.

        A key is that of the table, and must not occur twice in the source. Null keys match nothing.
        """
        source = materialize(source.select(*self.schema.names))
        parts = self.parts_of(source)
        # Stored and source rows are shuffled once, to where their part is written, and meet there.
        both = (
            self.read(parts).withColumn(_NEW, F.lit(0)).unionByName(source.withColumn(_NEW, F.lit(1)))
            .withColumns({PART: self.part(), _SLOT: self._slot(source)})
            .repartition(PART, _SLOT)
            .withColumn(_COPIES, F.sum(_NEW).over(Window.partitionBy(PART, _SLOT, *self.key)))
        )
        stays = (F.col(_NEW) == 1) | (F.col(_COPIES) == 0) | self._null_key()
        if len(self.key) == 1:
            (key,) = self.key
            both = both.where(self._unique(key, F.lit(True)))
        self.replace(both.where(stays).select(*self.schema.names, PART), parts, placed=True)
        release(source)
        return parts

    def _null_key(self) -> Column:
        return reduce(lambda x, y: x | y, [F.col(c).isNull() for c in self.key])

    def _held(self, *paths: str) -> int:
        """Bytes of the files below these folders."""
        found = [_located(self.spark, path) for path in paths]
        return sum(files.getContentSummary(folder).getLength() for folder, files in found if files.exists(folder))

    def _slot(self, source: DataFrame) -> Column:
        """Which of the tasks of its part takes a row; more of them where the files of table and source are large."""
        slots = 1 + self._held(self.path, source._rostra_location) // (self.parts * _TASK_BYTES)
        # Null keys match nothing, so such rows may lie anywhere; those of a source are checked for repetition.
        alone = self._null_key() & ((F.col(_NEW) == 0) | F.lit(len(self.key) > 1))
        plain = [f.name for f in self.schema.fields if isinstance(f.dataType, T.AtomicType)]
        return F.pmod(F.when(alone, F.hash(*self.key, *plain)).otherwise(F.hash(*self.key)), F.lit(slots))

    def update(self, source: DataFrame, changes: dict[str, Column]) -> list[int]:
        """Set columns of the stored rows that have a source row, see ``merge_update``; returns the parts touched."""
        (key,) = self.key
        # Only what is set is stored and meets the rows, as in an upsert.
        value = F.struct(*[new.alias(name) for name, new in changes.items()]).alias(_VALUE)
        source = materialize(source.select(key, value))
        parts = self.parts_of(source)
        both = (
            self.read(parts).withColumn(_NEW, F.lit(0))
            .unionByName(source.withColumn(_NEW, F.lit(1)), allowMissingColumns=True)
            .withColumns({PART: self.part(), _SLOT: self._slot(source)})
            .repartition(PART, _SLOT)
        )
        same_key = Window.partitionBy(PART, _SLOT, key)
        met = both.withColumns(
            {_COPIES: F.sum(_NEW).over(same_key), _VALUE: F.first(_VALUE, ignorenulls=True).over(same_key)}
        ).where(self._unique(key, F.col(_NEW) == 0))
        matched = (F.col(_COPIES) > 0) & F.col(key).isNotNull()
        set_ = {c: F.when(matched, F.col(_VALUE)[c]).otherwise(F.col(c)) for c in changes if c in self.schema.names}
        self.replace(met.withColumns(set_).select(*self.schema.names, PART), parts, placed=True)
        release(source)
        return parts

    def _unique(self, key: str, stays: Column) -> Column:
        """Whether a row stays; source rows that share a key fail the query, also those that would not stay."""
        twice = F.raise_error(F.concat(F.lit(f"more than one source row for {key} "), F.col(key)))
        return F.when((F.col(_NEW) == 1) & (F.col(_COPIES) > 1), twice.cast("boolean")).otherwise(stays)

    def replace_groups(self, touched: DataFrame, rows: DataFrame, many: bool = False) -> list[int]:
        """Exchange whole groups: ``touched`` has the ``key`` (see ``key_hash``) of each, ``rows`` what they have now.

        ``many`` touched groups of few rows each are shuffled with stored and new rows, once, to where their part
        is written, and meet them there. New rows of other groups are left out then.
        """
        parts = self.parts_of(touched, F.pmod("key", F.lit(self.parts)).cast("int"))
        if not many:
            kept = self.read(parts).withColumn("key", key_hash(*self.key)).join(touched, "key", "left_anti")
            self.replace(kept.select(*self.schema.names).unionByName(rows.select(*self.schema.names)), parts)
            return parts
        names, own = self.schema.names, key_hash(*self.key).alias("key")
        slots = 1 + 2 * self._held(self.path) // (self.parts * _TASK_BYTES)
        both = (
            self.read(parts).select(*names, own, F.lit(0).alias(_NEW))
            .unionByName(rows.select(*names, own, F.lit(1).alias(_NEW)))
            .unionByName(touched.select("key", F.lit(2).alias(_NEW)), allowMissingColumns=True)
            .withColumns({PART: F.pmod("key", F.lit(self.parts)).cast("int"), _SLOT: F.pmod(F.hash("key"), F.lit(slots))})
            .repartition(PART, _SLOT)
            .withColumn(_COPIES, F.max(_NEW).over(Window.partitionBy(PART, _SLOT, "key")))
        )
        stays = F.when(F.col(_COPIES) == 2, F.col(_NEW) == 1).otherwise(F.col(_NEW) == 0)
        self.replace(both.where(stays).select(*names, PART), parts)
        return parts
