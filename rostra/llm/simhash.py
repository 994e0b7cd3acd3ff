"""Near-dedup: SimHash fingerprints and a binary trie joined with itself.

The trie holds the distinct fingerprints. Pairs of its nodes go down together, with the
number of bits in which their paths differ; a pair beyond the error budget is pruned.
The budget grows from block to block of the fingerprint, 0, 1, .. up to the whole of it:
whatever bits differ, some rotation of the blocks keeps within all of these, so one trie
per rotation finds every link. The first two blocks are one equi-join on flipped paths;
below it only the surviving pairs are joined with their children.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import append_columns, blocks, packed, schema_with
from rostra.llm.components import connected_components
from rostra.sources.tables import materialize

BITS = 64
SHINGLE = 4
MAX_BITS = 4
# Fixed value: seed of the shingle hashes.
SEED = 42


def _bit_majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(((ones * 2 > len(hashes)).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the words of the lower-cased (A-Z) text, ``shingle`` at a time; of fewer words, one."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(whole, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    ends = (ends - 1).tolist()
    n = len(words) - shingle + 1
    return np.fromiter(
        (xxh64_intdigest(whole[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])), np.uint64, n
    )


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text, by the majority of its shingles' hashes; 0 without words."""
    return _bit_majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows with ``bits long``, the fingerprint; a text without words has 0."""
    docs = docs.drop("bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            found = [fingerprint_of(t, shingle) for t in block.column(text).to_pylist()]
            yield append_columns(block, bits=pa.array(np.array(found, np.uint64).view(np.int64)))

    return docs.mapInArrow(run, schema_with(docs, "bits long"))


def _rotated(bits: Column, by: int) -> Column:
    if not by:
        return bits
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by))


def _depths(cuts: list[int]) -> list[int]:
    """Depth, for each number of blocks, that so many blocks reach in every rotation."""
    sizes = [b - a for a, b in pairwise(cuts)] * 2
    n = len(cuts) - 1
    return [min(sum(sizes[i : i + length]) for i in range(n)) for length in range(1, n + 1)]


def links_by_trie(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints that differ in at most ``max_bits`` bits.

    ``prints`` has a column ``bits`` without repetitions, and may have ``known``, a
    number of the group to which a fingerprint is already known to be linked. Nodes
    whose leaves are all of one group are not paired, so links inside of it may be
    missing; every link between two groups is found.
    """
    turns = max_bits + 1
    cuts = [round(BITS * i / turns) for i in range(turns + 1)]
    depths = _depths(cuts)
    known = F.col("known") if "known" in prints.columns else F.col("bits")
    paths = F.array(*[
        F.struct(F.lit(i).alias("turn"), _rotated(F.col("bits"), cuts[i]).alias("path")) for i in range(turns)
    ])
    leaves = prints.select(known.alias("known"), F.explode(paths).alias("leaf")).select("leaf.*", "known")

    def nodes(depth: int, name: str, above: int = 0) -> DataFrame:
        """Nodes at a depth, with their ancestors at another and the groups below them."""
        node = F.shiftrightunsigned("path", BITS - depth) if depth < BITS else F.col("path")
        return (
            leaves.groupBy("turn", node.alias(f"{name}_node"))
            .agg(F.min("known").alias(f"{name}_low"), F.max("known").alias(f"{name}_high"))
            .withColumn(name, F.shiftrightunsigned(f"{name}_node", depth - above))
        )

    def useful(pairs: DataFrame, budget: int) -> DataFrame:
        """Child pairs within the budget that can still link two groups, each pair once."""
        spread = ~(
            (F.col("a_low") == F.col("a_high"))
            & (F.col("b_low") == F.col("b_high"))
            & (F.col("a_low") == F.col("b_low"))
        )
        once = (F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node"))
        within = F.bit_count(F.col("a_node").bitwiseXOR(F.col("b_node"))) <= budget
        return pairs.where(once & within & spread).select("turn", "a_node", "b_node")

    if max_bits == 0:
        return prints.select(F.col("bits").alias("a"), F.col("bits").alias("b")).where(F.lit(False))
    a, b = nodes(depths[1], "a", depths[1]), nodes(depths[1], "b", depths[1])
    flipped = F.array(*[
        F.col("a").bitwiseXOR(F.lit(bit).cast("long"))
        for bit in [0, *(1 << i for i in range(depths[1] - depths[0]))]
    ])
    # Where the paths differ, both orders come up; one is kept.
    pairs = a.withColumn("b", F.explode(flipped)).join(b, ["turn", "b"]).where("a <= b")
    pairs = useful(pairs, 1)
    for level in range(2, turns):
        parents = pairs.select("turn", F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        above, depth = depths[level - 1], depths[level]
        pairs = useful(
            parents.join(nodes(depth, "a", above), ["turn", "a"]).join(nodes(depth, "b", above), ["turn", "b"]),
            level,
        )
    back = F.coalesce(*[
        F.when(
            F.col("turn") == i,
            F.array(*[_rotated(F.col(c), (BITS - cuts[i]) % BITS) for c in ("a_node", "b_node")]),
        )
        for i in range(turns)
    ])
    return (
        pairs.where("a_node <> b_node")
        .select(F.array_sort(back).alias("pair"))
        .select(F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b"))
        .distinct()
    )


def _near_stars(prints: DataFrame) -> DataFrame:
    """Links of fingerprints that agree outside one of 16 windows of four bits.

    Such fingerprints are all within four bits of each other, so one star per set of
    them stands for all of its links.
    """
    windows = F.explode(F.array(*[F.lit(i) for i in range(BITS // 4)]))
    masked = F.col("bits").bitwiseAND(F.expr("~shiftleft(15L, window * 4)"))
    spread = prints.withColumn("window", windows).withColumn("masked", masked)
    centres = spread.groupBy("window", "masked").agg(F.min("bits").alias("b"), F.max("bits").alias("top"))
    return (
        spread.join(centres.where("b < top"), ["window", "masked"])
        .select(F.col("bits").alias("a"), "b")
        .where("a <> b")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id``, ``content``, ``bits``, ``fingerprint``, ``group`` and ``component_id`` of every row.

    ``fingerprint`` is ``bits`` in hex, and ``component_id`` the smallest id reachable over
    fingerprints that differ in at most ``max_bits`` bits, the row's own included; rows of
    a ``group`` are reachable from each other. ``content`` is a hash of the text. Texts
    without words, null ones too, have fingerprint 0 and are linked like others. A null
    id takes part but is the smallest only where all ids of a component are null. Rows
    are passed one to one, repeated ones too.
    """
    marked = materialize(
        fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
        .select("doc_id", "bits", F.xxhash64("text").alias("content"))
    )
    prints = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("doc_id")))
    known = prints.select("bits", F.col("bits").alias("known"))
    near = prints.limit(0).select(F.col("bits").alias("a"), F.col("bits").alias("b"))
    if max_bits >= 4:
        near = materialize(_near_stars(prints.select("bits")).distinct())
        groups = connected_components(near).withColumnsRenamed({"node": "bits", "component": "group"})
        known = prints.join(groups, "bits", "left").select("bits", F.coalesce("group", "bits").alias("known"))
        near = groups.select(F.col("bits").alias("a"), F.col("group").alias("b"))
    links = near.unionByName(links_by_trie(materialize(known), max_bits))
    groups = connected_components(links).withColumnsRenamed({"node": "bits", "component": "group"})
    grouped = prints.join(groups, "bits", "left").select("bits", "doc_id", F.coalesce("group", "bits").alias("group"))
    # One row per fingerprint; every row with it has its group.
    least = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    decided = materialize(grouped.join(least, "group").select("bits", "group", "component_id"))
    found = marked.join(decided, "bits")
    return found.select(
        "doc_id", "content", "bits", _hex(F.col("bits")).alias("fingerprint"), "group", "component_id"
    )


def _hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_first(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of each ``group`` of ``doc_id`` and ``content``: the smallest id, then hash."""
    # A null id is the smallest of a component only where all are null.
    first = (
        found.groupBy("group")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("content"))).alias("best"))
        .select(F.struct(F.col("best.doc_id").alias("id"), F.col("best.content").alias("content")).alias("kept"))
    )
    kept = F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("content"))
    return (
        docs.select(packed(docs).alias("row"), kept.alias("kept"))
        .join(first, "kept", "left_semi")
        .dropDuplicates(["kept"])
        .select("row.*")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each component: that of the smallest id; of several rows with it, the one
    whose text has the smallest hash, and of equal ones any."""
    return keep_first(docs, near_duplicates(docs, doc_id, text, **how), doc_id, text)
