"""Near-dedup by one-permutation MinHash.

The shingles of a text are hashed once. The hashes fall into bins by their leading bits,
and the least of each bin is the signature of the text; an empty bin takes the value of
the first full one in an order of its own, which is drawn at random and the same for all
texts (optimal densification). Bands of the signature are buckets. In a bucket every text
is linked with one centre, so candidate edges are stars: as many as the bucket has texts.
Each edge is confirmed on the full sets of shingles. Texts of a bucket that the centre did
not make one group may still be similar to each other. Then the shingles in which each
differs from the centre are mostly the same, and the rarest of them are shared: pairs are
made by these shingles, not by the bucket (see ``_pairs_by_differences``). So two similar texts
that share a bucket are linked whatever the centre is.

Two texts at the least similarity share no bucket with a probability of about 1e-10.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import append_columns, blocks, schema_with
from rostra.llm.components import linked_in_buckets
from rostra.sources.tables import materialize, release

SHINGLE = 3
# Least similarity in per cent: 100 * intersection >= SIMILARITY * union.
SIMILARITY = 85
BANDS, ROWS = 48, 6
# Bytes of words, and of shingle sets, that a task remembers.
_WORD_BYTES, _SET_BYTES = 16_000_000, 64_000_000


class Shingler:
    """Sets of word shingles as sorted distinct 64-bit hashes; knows the hashes of words it met."""

    def __init__(self, shingle: int = SHINGLE):
        from xxhash import xxh64_intdigest

        self.shingle, self._hash = shingle, xxh64_intdigest
        self._known: dict[bytes, int] = {}
        self._bytes = 0
        random = np.random.default_rng(11)
        # One odd factor for each word of a shingle, and one term for each shorter text.
        self._factors = random.integers(0, 1 << 63, shingle, np.uint64) * np.uint64(2) + np.uint64(1)
        self._short = random.integers(0, 1 << 63, shingle + 1, np.uint64)

    def _word(self, word: bytes) -> int:
        found = self._hash(word, 5)
        if self._bytes > _WORD_BYTES:
            self._known.clear()
            self._bytes = 0
        self._known[word] = found
        self._bytes += len(word) + 100
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self._known.get
        hashes = np.array([known(w) or self._word(w) for w in words], np.uint64)
        n = max(1, len(words) - self.shingle + 1)
        mixed = np.zeros(n, np.uint64)
        for i in range(min(self.shingle, len(words))):
            mixed += hashes[i : i + n] * self._factors[i]
        if len(words) < self.shingle:
            mixed += self._short[len(words)]
        # Bins go by the leading bits, so all bits are mixed once more.
        for _ in range(2):
            mixed ^= mixed >> np.uint64(33)
            mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return np.unique(mixed)


class Signer:
    """Signatures of shingle sets, and the keys of their bands."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        random = np.random.default_rng(12)
        # Bins that an empty bin asks, one after the other.
        self._asked = np.array([random.permutation(self.bins) for _ in range(self.bins)], np.int32)
        self._factors = random.integers(0, 1 << 63, (bands, rows), np.uint64) * np.uint64(2) + np.uint64(1)
        self._terms = random.integers(0, 1 << 63, bands, np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The least hash of every bin; ``hashes`` are sorted, and not empty."""
        bin_of = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(bin_of.astype(np.int64), prepend=-1))
        full = np.zeros(self.bins, bool)
        least = np.zeros(self.bins, np.uint64)
        at = bin_of[first].astype(np.int64)
        full[at], least[at] = True, hashes[first]
        empty = np.flatnonzero(~full)
        if len(empty):
            asked = self._asked[empty]
            least[empty] = least[asked[np.arange(len(empty)), full[asked].argmax(axis=1)]]
        return least

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One number for each band."""
        parts = self.signature(hashes).reshape(self.bands, self.rows)
        mixed = (parts * self._factors).sum(axis=1, dtype=np.uint64) + self._terms
        mixed ^= mixed >> np.uint64(32)
        return mixed * np.uint64(0x9E3779B97F4A7C15)


def signed(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id and content with two hashes of the set of shingles, its size and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        shingles, signer = Shingler(shingle), Signer(bands, rows)
        for block in blocks(batches, "text"):
            sets = [shingles(t) for t in block.column("text").to_pylist()]
            named = [xxh3_128_intdigest(s.tobytes()) for s in sets]
            halves = np.array([(x >> 64, x & (1 << 64) - 1) for x in named], np.uint64).reshape(-1, 2).view(np.int64)
            keys = [signer.keys(s) if len(s) else np.zeros(0, np.uint64) for s in sets]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
            yield append_columns(
                block.drop_columns(["text"]),
                high=pa.array(halves[:, 0]),
                low=pa.array(halves[:, 1]),
                size=pa.array([len(s) for s in sets], pa.int64()),
                buckets=pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            )

    narrow = docs.select("doc_id", F.xxhash64("text").alias("content"), "text")
    return narrow.mapInArrow(run, schema_with(narrow.drop("text"), "high long, low long, size long, buckets array<long>"))


def _buckets(one: DataFrame) -> DataFrame:
    """``bucket``, ``node`` and ``size`` of the buckets with two nodes or more."""
    # A short text can have one key in two bands.
    items = one.select("node", "size", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = items.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    return items.join(shared.select("bucket"), "bucket", "left_semi")


def _with_sets(
    pairs: DataFrame,
    texts: DataFrame,
    shingle: int,
    schema: str,
    look: Callable[[pa.RecordBatch, Iterator[tuple[np.ndarray, np.ndarray]]], pa.RecordBatch],
) -> DataFrame:
    """What ``look`` makes of blocks of the pairs ``a``, ``b`` and the two sets of each."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(a, "a").join(b, "b").select(*pairs.columns, "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle)
        known: dict[int, np.ndarray] = {}
        held = 0

        def set_of(node: int, text: str) -> np.ndarray:
            nonlocal held
            if node not in known:
                if held > _SET_BYTES:
                    known.clear()
                    held = 0
                known[node] = shingles(text)
                held += known[node].nbytes
            return known[node]

        for batch in batches:
            for block in blocks([batch], "a_text"):
                nodes = zip(block.column("a").to_pylist(), block.column("b").to_pylist())
                given = zip(block.column("a_text").to_pylist(), block.column("b_text").to_pylist())
                sets = ((set_of(x, x_text), set_of(y, y_text)) for (x, y), (x_text, y_text) in zip(nodes, given))
                yield look(block.drop_columns(["a_text", "b_text"]), sets)

    return both.mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    sized = pairs.where(F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * similarity)

    def look(block: pa.RecordBatch, sets: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        near = []
        for first, second in sets:
            shared = len(first) + len(second) - len(np.union1d(first, second))
            near.append(100 * shared >= similarity * (len(first) + len(second) - shared))
        return block.filter(pa.array(near, pa.bool_()))

    return _with_sets(sized, texts, shingle, schema_with(sized), look)


def _differences(members: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Members with the shingles that they or their head have alone, and how many of these can be the first in common.

    Similar sets of m shingles together differ in at most m (100 - similarity) / (100 + similarity).
    Of two members in different groups one is not similar to the head. Where it differs from the head
    in n shingles, any similar set does so in n - ``most`` at least and shares these. A member
    that is similar to the head shares (n + 1) / 2 with any such one, less half of what its size and
    that of the head differ. Whatever order the shingles have, the first one that two sets share
    has as many after it as they share besides.
    """

    def look(block: pa.RecordBatch, sets: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        differing, leading = [], []
        for own, head in sets:
            apart = np.setxor1d(own, head, assume_unique=True)
            n, both = len(apart), len(own) + len(head)
            if 100 * (both - n) >= similarity * (both + n):
                shared = -(-(n + 1 - abs(len(own) - len(head))) // 2)
            else:
                most = (len(own) + 100 * len(own) // similarity) * (100 - similarity) // (100 + similarity)
                shared = n - most
            differing.append(apart.view(np.int64))
            leading.append(n - max(1, shared) + 1)
        return append_columns(
            block, leading=pa.array(leading, pa.int32()), differing=pa.array(differing, pa.list_(pa.int64()))
        )

    pairs = members.withColumnsRenamed({"node": "a", "head": "b"})
    schema = schema_with(pairs, "leading int, differing array<long>")
    return _with_sets(pairs, texts, shingle, schema, look).withColumnsRenamed({"a": "node", "b": "head"})


def _pairs_by_differences(members: DataFrame, similarity: int) -> DataFrame:
    """Pairs of members of one head, in different groups, that may be similar.

    ``members`` are ``_differences``. Shingles that one group has alone come first, as they make no pair,
    then the rarest; only the leading ones of each member meet. A pair is left out where the
    first shingle that it shares leaves too few after it.
    """
    far = members.withColumn("n", F.size("differing"))
    each = far.withColumn("shingle", F.explode("differing")).drop("differing")
    meeting = (
        each.groupBy("head", "shingle")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("many"))
        .where("low < high")
        .select("head", "shingle", "many")
    )
    # Those that one group has alone are only counted.
    ranked = (
        each.join(meeting, ["head", "shingle"])
        .groupBy("head", "node", "size", "group", "n", "leading")
        .agg(F.sort_array(F.collect_list(F.struct("many", "shingle"))).alias("met"))
        .withColumn("alone", F.col("n") - F.size("met"))
        .withColumn("met", F.slice("met", 1, F.greatest(F.col("leading") - F.col("alone"), F.lit(0))))
        .select("head", "node", "size", "group", "n", "alone", F.posexplode("met").alias("at", "first"))
        # This one and those of the member that come after it.
        .withColumn("left", F.col("n") - F.col("alone") - F.col("at"))
        .select("head", "first.shingle", "node", "size", "group", "n", "left")
    )
    of = ranked.withColumnsRenamed({c: f"of_{c}" for c in ("node", "size", "group", "n", "left")})
    both = F.col("size") + F.col("of_size")
    shared_twice = F.col("n") + F.col("of_n") - both + 2 * F.ceil(similarity * both / (100 + similarity))
    return (
        ranked.join(of, ["head", "shingle"])
        .where(F.col("group") != F.col("of_group"))
        .where(F.col("node") > F.col("of_node"))
        .where(F.least("size", "of_size") * 100 >= F.greatest("size", "of_size") * similarity)
        .where(shared_twice <= 2 * F.least("left", "of_left"))
        .select("node", "of_node", "size", "of_size", "group", "of_group")
        .toDF("a", "b", "a_size", "b_size", "a_group", "b_group")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Texts are linked if their sets of shingles, of lower-cased (A-Z) words, have a
    similarity of ``similarity`` per cent or more; a text of fewer words is one shingle.
    ``component_id`` is the smallest id reachable over links, the row's own included, and
    ``kept`` whether it is the row's own. Texts without words, null ones too, have no
    shingles and are linked with nothing. A null id takes part, but is the smallest only
    where all ids of a component are null; such rows are all kept. Rows are passed one to
    one, repeated ones too, and other columns play no part.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = materialize(signed(docs, shingle, bands, rows).withColumn("row", F.monotonically_increasing_id()))
    wordy = marked.where("size > 0")
    # Equal sets are one node, named by one of its rows; its text can be found by two columns.
    nodes = materialize(
        wordy.groupBy("high", "low")
        .agg(F.min(F.struct("row", "doc_id", "content")).alias("place"), F.min("doc_id").alias("least"))
        .select("high", "low", "least", F.col("place.row").alias("node"), F.col("place.doc_id"), F.col("place.content"))
    )
    one = wordy.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    members = materialize(_buckets(one.select(F.col("row").alias("node"), "size", "buckets")))
    places = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("doc_id").alias("place_id"), "content"
    )
    own = docs.withColumn("own", F.xxhash64("text"))
    at = F.col("doc_id").eqNullSafe(F.col("place_id")) & (F.col("own") == F.col("content"))
    # A row that is given twice is found twice.
    texts = materialize(own.join(places, at).select("node", "text").dropDuplicates(["node"]))
    differing: list[DataFrame] = []

    def rest(left: DataFrame) -> DataFrame:
        differing.append(materialize(_differences(left, texts, shingle, similarity)))
        return _pairs_by_differences(differing[0], similarity)

    groups = linked_in_buckets(members, lambda pairs: _confirmed(pairs, texts, shingle, similarity), rest)
    grouped = nodes.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    decided = materialize(grouped.join(least, "group").select("high", "low", "component_id"))
    release(members, texts, *differing)
    found = wordy.select("doc_id", "size", "high", "low").join(decided, ["high", "low"])
    alone = marked.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    return (
        found.select("doc_id", "size", "component_id").unionByName(alone)
        .select("doc_id", F.col("size").alias("n_shingles"), "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
