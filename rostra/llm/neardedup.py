"""Near-dedup by the Jaccard similarity of word shingles, exact.

Texts are near duplicates if their sets of five-word shingles have a Jaccard similarity of
0.8 or more. Every such pair is found, by two prefix filters one after the other. The
first takes the shingles of the smallest hashes, three in ten of a text, of which two
similar texts have many in common. The second takes the rarest of these, so that two
similar texts share one at least, while passages that many texts have seldom count.

Texts that share such a shingle are a bucket. Its members are compared exactly with a few
leaders, then with more, until all members are linked or each has led: no link between
two groups is missed, and a group of copies does not give all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import append_columns, blocks, schema_with
from rostra.llm.components import linked_in_buckets
from rostra.llm.simhash import keep_first, shingle_hashes
from rostra.sources.tables import materialize

SHINGLE = 5
SIMILARITY = 0.8


def _least_common(size: int | Column, similarity: float):
    """So many shingles of a text are in any similar one at least."""
    if isinstance(size, Column):
        return F.ceil(size * F.lit(similarity) - 1e-9)
    return int(np.ceil(size * similarity - 1e-9))


def _prefix_size(n: int, similarity: float) -> int:
    """A tenth of the shingles more than can be missing in a similar text."""
    return n - _least_common(n, similarity) + max(1, n // 10)


def _set_of(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def _marked(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """doc_id and content with two hashes of the set of shingles, its size and its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for block in blocks(batches, "text"):
            sets = [_set_of(t, shingle) for t in block.column("text").to_pylist()]
            named = [xxh3_128_intdigest(s.tobytes()) for s in sets]
            halves = np.array([(x >> 64, x & (1 << 64) - 1) for x in named], np.uint64).reshape(-1, 2).view(np.int64)
            parts = [s[: _prefix_size(len(s), similarity)] if len(s) else s for s in sets]
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield append_columns(
                block.drop_columns(["text"]),
                high=pa.array(halves[:, 0]),
                low=pa.array(halves[:, 1]),
                size=pa.array([len(s) for s in sets], pa.int64()),
                prefix=pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("content"), "text")
    schema = schema_with(rows.drop("text"), "high long, low long, size long, prefix array<long>")
    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _buckets(one: DataFrame, similarity: float) -> DataFrame:
    """``bucket``, ``node`` and ``size``: similar nodes have a shingle in common here."""
    items = one.select("node", "size", F.explode("prefix").alias("shingle"))
    common = items.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Two prefixes have so many shingles in common at least; the smallest similar text counts.
    least = F.greatest(F.lit(1), F.floor(_least_common(F.col("size"), similarity) / 10))
    frequent = Window.partitionBy("node").orderBy(F.desc("n"), "shingle")
    return (
        items.join(common, "shingle")
        .withColumn("at", F.row_number().over(frequent))
        .where(F.col("at") >= least)
        .select(F.col("shingle").alias("bucket"), "node", "size")
    )


def _sets(docs: DataFrame, places: DataFrame, shingle: int) -> DataFrame:
    """``node`` and ``shingles`` of the nodes whose text is at ``doc_id`` and ``content``."""
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_content"), "text")
    at = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_content") == F.col("content"))
    found = texts.join(places, at).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = [_set_of(t, shingle).view(np.int64) for t in block.column("text").to_pylist()]
            yield append_columns(block.drop_columns(["text"]), shingles=pa.array(sets, pa.list_(pa.int64())))

    # A row that is given twice is here twice.
    return found.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = both + 1e-9 >= (F.size("of_a") + F.size("of_b") - both) * F.lit(similarity)
    near = F.least("a_size", "b_size") + 1e-9 >= F.greatest("a_size", "b_size") * F.lit(similarity)
    return pairs.where(near).join(a, "a").join(b, "b").where(enough).select(*pairs.columns)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id``, ``content`` and ``group`` of every row.

    Rows of a ``group`` are reachable from each other over texts whose Jaccard similarity
    is ``similarity`` or more. Shingles are of lower-cased (A-Z) words; a text of fewer
    words is one shingle, and texts without words, null ones too, are one group.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = materialize(_marked(docs, shingle, similarity))
    # Equal sets are one node, named by one of its rows.
    nodes = materialize(marked.groupBy("high", "low").agg(F.min("row").alias("node")))
    one = marked.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumn("node", F.col("row"))
    members = materialize(_buckets(one, similarity))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    asked = members.join(shared, "bucket", "left_semi").select("node").distinct()
    places = one.join(asked, "node", "left_semi").select("node", "doc_id", "content")
    sets = materialize(_sets(docs, places, shingle))
    groups = linked_in_buckets(members, lambda pairs: _similar(pairs, sets, similarity))
    groups = groups.withColumnRenamed("component", "group")
    return (
        marked.select("doc_id", "content", "high", "low")
        .join(nodes, ["high", "low"])
        .join(groups, "node", "left")
        .select("doc_id", "content", F.coalesce("group", "node").alias("group"))
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group: that of the smallest id; of several rows with it, the one
    whose text has the smallest hash, and of equal ones any."""
    return keep_first(docs, near_duplicates(docs, doc_id, text, **how), doc_id, text)
