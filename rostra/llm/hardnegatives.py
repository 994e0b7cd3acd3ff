"""Hard negatives by a multiway hyperplane tree with sibling ranges.

Every split point of the tree takes the rows nearest to it. It also stores, for each of
its siblings' subtrees, the range of distances from itself to the rows there. A search
window is an annulus around an anchor: a subtree is passed over if its range, seen from
any of the split points, does not meet the annulus widened by the anchor's distance to
that point. What is left are leaves, and these are scanned exactly.

Nearness is the inner product of integer vectors. With one more coordinate that brings
all vectors to the same length, it becomes a distance: d^2 = |a|^2 + M^2 - 2 <a, x>, so a
window of scores is an annulus of distances.

The tree is grown on a bounded sample; all rows are dealt to its leaves, and the ranges
cover all rows. A leaf is cut into parts of bounded size, each of which meets its anchors
in one group, so that a leaf with a third of all rows is many groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.vectors import floored, matrices, usual_width
from rostra.sources.tables import materialize

# The tree is grown on at most so many rows; every row is dealt to a leaf.
SAMPLE_ROWS = 10_000
FANOUT = 12
# Sampled rows of a leaf at least, rows of the table in it, and levels of splits at most.
_SAMPLED, _LEAF_ROWS, _LEVELS = 64, 1024, 4
# Rows and anchors that meet in one group.
_ROWS, _ANCHORS = 8192, 512
SCALE = 256
# Scores are longs: the squared length of an integer vector stays below this.
_LONGEST = 1 << 62


@dataclass
class Node:
    """Split points (rows of ``Tree.points``) and, for each, the number of a child node or -1 - that of a leaf."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)


@dataclass
class Tree:
    """Nodes, the root first, split points of all, and ranges ``[node][point, subtree]``."""

    nodes: list[Node]
    points: np.ndarray
    squares: np.ndarray
    length: float
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)

    def lift(self, squares: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length**2 - squares, 0))

    def far(self, node: Node, x: np.ndarray, squares: np.ndarray, lifted: bool) -> np.ndarray:
        """Distances of rows (lifted, of one length) or anchors (as they are) to a node's split points."""
        dots = x @ self.points[node.points].T
        if lifted:
            dots = dots + np.outer(self.lift(squares), self.lift(self.squares[node.points]))
            squares = np.full(len(x), self.length**2)
        return np.sqrt(np.maximum(squares[:, None] + self.length**2 - 2 * dots, 0))

    @property
    def slack(self) -> float:
        """More than the rounding error of a distance."""
        return 1e-5 * self.length


def _split_points(points: np.ndarray, squares: np.ndarray, tree: Tree, members: np.ndarray, random) -> np.ndarray:
    """Split points far from each other, chosen greedily among a few times as many rows."""
    asked = random.permutation(members)[: 4 * FANOUT]
    lifted = np.column_stack([points[asked], tree.lift(squares[asked])])
    chosen = [0]
    nearest = np.full(len(asked), np.inf)
    while len(chosen) < FANOUT:
        nearest = np.minimum(nearest, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
        far = int(nearest.argmax())
        if nearest[far] <= 0:
            break
        chosen.append(far)
    return asked[chosen]


def grow(points: np.ndarray, length: float, rows: int, seed: int = 3) -> Tree:
    """A tree on integer vectors sampled from a table of ``rows``, the longest of which has ``length``."""
    leaf_rows = max(_SAMPLED, len(points) * _LEAF_ROWS // rows)
    points = points.astype(np.float64)
    squares = (points * points).sum(axis=1)
    tree = Tree([], points, squares, length)
    random = np.random.default_rng(seed)
    leaves = 0

    def branch(members: np.ndarray, level: int) -> int:
        nonlocal leaves
        chosen = members[:0]
        if not level or len(members) > leaf_rows and level < _LEVELS:
            chosen = _split_points(points, squares, tree, members, random)
        if level and len(chosen) < 2:
            leaves += 1
            return -leaves
        node = Node(chosen)
        number = len(tree.nodes)
        tree.nodes.append(node)
        own = tree.far(node, points[members], squares[members], True).argmin(axis=1)
        node.children = [branch(members[own == j], level + 1) for j in range(len(chosen))]
        return number

    branch(np.arange(len(points)), 0)
    # Only split points are kept.
    used = np.unique(np.concatenate([node.points for node in tree.nodes]))
    for node in tree.nodes:
        node.points = np.searchsorted(used, node.points)
    tree.points, tree.squares = points[used], squares[used]
    return tree


def deal(tree: Tree, x: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Leaf of every row, and the ranges of the nodes on the rows' ways."""
    leaf = np.zeros(len(x), np.int32)
    ranges = {}

    def down(number: int, rows: np.ndarray) -> None:
        node = tree.nodes[number]
        far = tree.far(node, x[rows], squares[rows], True)
        own = far.argmin(axis=1)
        m = len(node.points)
        low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        for j, child in enumerate(node.children):
            at = own == j
            if at.any():
                low[:, j], high[:, j] = far[at].min(axis=0), far[at].max(axis=0)
                if child < 0:
                    leaf[rows[at]] = -1 - child
                else:
                    down(child, rows[at])
        ranges[number] = (low, high)

    if len(x):
        down(0, np.arange(len(x)))
    return leaf, ranges


def visit(
    tree: Tree, x: np.ndarray, squares: np.ndarray, of: np.ndarray, inner: np.ndarray, outer: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Windows and leaves that may hold rows of them.

    Window ``w`` is the annulus from ``inner[w]`` to ``outer[w]`` around anchor ``of[w]``.
    """
    windows, leaves = [], []

    def down(number: int, alive: np.ndarray) -> None:
        node = tree.nodes[number]
        asked, back = np.unique(of[alive], return_inverse=True)
        far = tree.far(node, x[asked], squares[asked], False)[back]
        reach = (far + outer[alive, None] + tree.slack)[:, :, None]
        least = (np.maximum(far - outer[alive, None], inner[alive, None] - far) - tree.slack)[:, :, None]
        meets = ((tree.low[number][None] <= reach) & (tree.high[number][None] >= least)).all(axis=1)
        for j, child in enumerate(node.children):
            at = alive[meets[:, j]]
            if not len(at):
                continue
            if child < 0:
                windows.append(at)
                leaves.append(np.full(len(at), -1 - child, np.int32))
            else:
                down(child, at)

    for first in range(0, len(of), 4096):
        down(0, np.arange(first, min(first + 4096, len(of))))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *windows]), np.concatenate([none.astype(np.int32), *leaves])


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where all partial sums are whole numbers below 2^53."""
    longest = float((a.astype(float) ** 2).sum(axis=1).max(initial=0) * (b.astype(float) ** 2).sum(axis=1).max(initial=0))
    if longest < 2.0**104:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score and rising id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort([ids[at], -scores[at]])[:k]]
    return np.lexsort([ids, -scores])[:k]


def _integers(rows: DataFrame, scale: int) -> DataFrame:
    """Rows that can take part: ``row`` (equal for repeated rows), ``id``, ``label``, ``asks``, ``x``, ``square``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, matrix in matrices(batch.column("v")):
                x, fits = floored(matrix, scale, 2.0**31 - 1)
                square = (x.astype(np.float64) ** 2).sum(axis=1)
                short = square < _LONGEST * 0.99
                x, at = x[short], at[fits][short]
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width, pa.int32())
                own = batch.select(["id", "label", "asks"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.ListArray.from_arrays(offsets, pa.array(x.ravel().astype(np.int32))),
                     pa.array((x * x).sum(axis=1), pa.int64())],
                    names=["id", "label", "asks", "x", "square"],
                )

    found = rows.mapInArrow(run, "id long, label long, asks boolean, x array<int>, square long")
    return found.select(F.xxhash64("id", "label", "x").alias("row"), "*")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), np.int64).reshape(-1, width)


def _dealt(rows: DataFrame, shared, width: int) -> DataFrame:
    """The rows with their ``leaf``; after the last of a task one row of ``ranges`` alone."""
    schema = pa.schema([
        ("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("asks", pa.bool_()),
        ("x", pa.list_(pa.int32())), ("square", pa.int64()), ("leaf", pa.int32()),
        ("ranges", pa.list_(pa.struct([("node", pa.int32()), ("at", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            x = _matrix(batch.column("x"), width).astype(np.float64)
            leaf, ranges = deal(tree, x, batch.column("square").to_numpy().astype(np.float64))
            for number, (low, high) in ranges.items():
                before = seen.get(number, (low, high))
                seen[number] = (np.minimum(low, before[0]), np.maximum(high, before[1]))
            arrays = [*batch.columns, pa.array(leaf), pa.nulls(batch.num_rows, schema.field("ranges").type)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
        told = [
            {"node": number, "at": at, "low": float(low.ravel()[at]), "high": float(high.ravel()[at])}
            for number, (low, high) in seen.items() for at in np.flatnonzero(np.isfinite(low.ravel())).tolist()
        ]
        yield pa.RecordBatch.from_pylist([{"ranges": told}], schema=schema)

    ddl = (
        "row long, id long, label long, asks boolean, x array<int>, square long, leaf int, "
        "ranges array<struct<node: int, at: int, low: double, high: double>>"
    )
    return materialize(rows.mapInArrow(run, ddl))


def _with_ranges(tree: Tree, dealt: DataFrame) -> Tree:
    """The tree with ranges over all rows; they are as many as the tree has pairs of siblings."""
    told = dealt.select(F.explode("ranges").alias("r")).groupBy("r.node", "r.at")
    found = told.agg(F.min("r.low").alias("low"), F.max("r.high").alias("high")).collect()
    tree.low = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
    tree.high = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
    for r in found:
        tree.low[r["node"]].ravel()[r["at"]] = r["low"]
        tree.high[r["node"]].ravel()[r["at"]] = r["high"]
    return tree


@dataclass(frozen=True)
class _Sample:
    """Rows that every task knows, each once; they give a first bound for a search."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    x: np.ndarray


# A window: lowest and highest score, and whether it asks for the anchor's own label.
_WINDOW = "array<struct<key: long, low: long, high: long, same: boolean, k: int>>"


def _routed(asked: DataFrame, tree_of, sample_of, width: int) -> DataFrame:
    """One row for each anchor and leaf that may hold rows of its windows, lower bounds raised by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample = tree_of.value, sample_of.value
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                x = _matrix(batch.column("x"), width)
                ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
                squares = batch.column("square").to_numpy().astype(np.float64)
                scores = _scores(x, sample.x)
                raised, of, inner, outer = [], [], [], []
                for i, windows in enumerate(batch.column("windows").to_pylist()):
                    s = scores[i]
                    other = sample.id != ids[i]
                    for w in windows:
                        inside = other & ((sample.label == labels[i]) == w["same"]) & (s >= w["low"]) & (s <= w["high"])
                        known = s[inside]
                        low = int(np.partition(known, len(known) - w["k"])[len(known) - w["k"]]) if len(known) >= w["k"] else w["low"]
                        raised.append({**w, "low": low})
                        of.append(i)
                        near = squares[i] + tree.length**2 - 2.0 * min(w["high"], _LONGEST)
                        far = squares[i] + tree.length**2 - 2.0 * max(low, -_LONGEST)
                        inner.append(max(near, 0) ** 0.5)
                        outer.append(max(far, 0) ** 0.5)
                of = np.array(of, np.int64)
                found, leaves = visit(tree, x.astype(np.float64), squares, of, np.array(inner), np.array(outer))
                # Windows of one anchor that lead to one leaf go there together.
                order = np.lexsort([found, leaves, of[found]])
                found, leaves = found[order], leaves[order]
                cuts = np.flatnonzero((np.diff(of[found], prepend=-1) != 0) | (np.diff(leaves, prepend=-1) != 0)).tolist()
                groups = [[raised[w] for w in found[a:b].tolist()] for a, b in zip(cuts, [*cuts[1:], len(found)])]
                own = batch.select(["row", "id", "label", "x"]).take(pa.array(of[found][cuts]))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(leaves[cuts]), pa.array(groups, _WINDOW_TYPE)],
                    names=["row", "id", "label", "x", "leaf", "windows"],
                )

    ddl = f"row long, id long, label long, x array<int>, leaf int, windows {_WINDOW}"
    return asked.mapInArrow(run, ddl)


_WINDOW_TYPE = pa.list_(pa.struct([
    ("key", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("same", pa.bool_()), ("k", pa.int32()),
]))


def _scan(routed: DataFrame, dealt: DataFrame, parts: dict[int, int], width: int) -> DataFrame:
    """``anchor`` (row), ``key``, ``id`` and ``score`` of what each leaf part has for each window."""
    routed = materialize(routed)
    asking = {r["leaf"]: -(-r["count"] // _ANCHORS) for r in routed.groupBy("leaf").count().collect()}

    def lookup(table: dict[int, int]) -> Column:
        pairs = [F.lit(x) for pair in table.items() for x in pair]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col("leaf")), F.lit(0)) if pairs else F.lit(0)

    def part(count: Column, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.greatest(count, F.lit(1))).cast("int")

    def every(count: Column) -> Column:
        return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")))

    # Copies of a row share its id, and so its part.
    base = dealt.select("leaf", "row", "id", "label", "x", part(lookup(parts), "id").alias("vp"), every(lookup(asking)).alias("qp"))
    asks = routed.select("leaf", "row", "id", "label", "x", "windows", part(lookup(asking), "row").alias("qp"), every(lookup(parts)).alias("vp"))

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "key": [], "id": [], "score": []}
        if anchors.num_rows and rows.num_rows:
            _, once = np.unique(rows["row"].to_numpy(), return_index=True)
            x = _matrix(rows["x"], width)[once]
            ids, labels = rows["id"].to_numpy()[once], rows["label"].to_numpy()[once]
            asking = _matrix(anchors["x"], width)
            told = zip(*(anchors[c].to_pylist() for c in ("row", "id", "label", "windows")))
            scores = _scores(asking, x)
            for i, (row, own, label, windows) in enumerate(told):
                s = scores[i]
                for w in windows:
                    at = np.flatnonzero((s >= w["low"]) & (s <= w["high"]) & (ids != own) & ((labels == label) == w["same"]))
                    at = at[_first(s[at], ids[at], w["k"])]
                    out["anchor"] += [row] * len(at)
                    out["key"] += [w["key"]] * len(at)
                    out["id"] += ids[at].tolist()
                    out["score"] += s[at].tolist()
        return pa.table(out, schema=pa.schema([(name, pa.int64()) for name in out]))

    keys = ["leaf", "vp", "qp"]
    return (
        asks.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInArrow(run, "anchor long, key long, id long, score long")
    )


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    scale: int = SCALE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Negatives of each anchor and positive that score from ``least`` to ``most`` per cent of the positive.

    Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score`` and ``negative_score``. Components are multiplied by ``scale`` and
    rounded down; a score is the inner product, exact. Positives are the first rows of the
    anchor's label, negatives the first rows of other labels within the window, by falling
    score, then rising id. Fewer rows than asked for give fewer results, and an anchor
    without positives or a window without rows gives none.

    Rows with a null id, label or vector, or with a null or non-finite component take no
    part, nor do empty vectors, vectors of another length than most (of several lengths as
    frequent, the shortest) and those whose score with themselves is no long. Rows that
    agree in id, label and vector count once; of rows that share an id otherwise each
    counts, but never for an anchor of that id.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    label = F.col(label) if isinstance(label, str) else label
    given = rows.select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("v"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    whole = materialize(_integers(given, scale))
    usual = usual_width(whole.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")))
    if usual is None:
        return spark.createDataFrame([], schema)
    width, n = usual
    whole = whole.where(F.size("x") == width)
    # The rows of the least hashes, which are a random choice.
    share = min(1.0, (sample_rows + 4 * sample_rows**0.5) / n)
    pick = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    chosen = whole.where(pick < int(share * (1 << 30)) + 1).select(pick.alias("pick"), "row", "id", "label", "x").toArrow()
    order = np.lexsort([chosen["row"].to_numpy(), chosen["pick"].to_numpy()])
    order = order[np.unique(chosen["row"].to_numpy()[order], return_index=True)[1]][:sample_rows]
    points = _matrix(chosen["x"], width)[order] if len(order) else np.zeros((1, width), np.int64)
    length = float(whole.agg(F.max("square")).first()[0]) ** 0.5
    tree = grow(points, length, n)
    # Both are bounded by the sample and the width.
    context = spark.sparkContext
    dealt = _dealt(whole, context.broadcast(tree), width)
    tree_of = context.broadcast(_with_ranges(tree, dealt))
    sample_of = context.broadcast(_Sample(*(chosen[c].to_numpy()[order] for c in ("row", "id", "label")), points[: len(order)]))
    dealt = dealt.where("row IS NOT NULL")
    parts = {r["leaf"]: -(-r["count"] // _ROWS) for r in dealt.groupBy("leaf").count().collect()}
    anchors = materialize(dealt.where("asks").select("row", "id", "label", "x", "square").dropDuplicates(["row"]))

    def search(asked: DataFrame, k: int) -> DataFrame:
        """``row``, ``key``, ``id``, ``score`` and ``rank`` of the first of each window."""
        found = _scan(_routed(asked, tree_of, sample_of, width), dealt, parts, width)
        ranked = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), "id")
        return (
            found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .withColumnRenamed("anchor", "row")
        )

    def window(key: Column, low: Column, high: Column, same: bool, k: int) -> Column:
        return F.struct(key.cast("long").alias("key"), low.cast("long").alias("low"), high.cast("long").alias("high"),
                        F.lit(same).alias("same"), F.lit(k).alias("k"))

    first = window(F.lit(0), F.lit(-_LONGEST), F.lit(_LONGEST), True, positives)
    near = materialize(search(anchors.withColumn("windows", F.array(first)), positives))
    # 100 n >= least p and 100 n <= most p in whole numbers; below zero no n is within both.
    hundreds, rest = F.expr("score div 100"), F.expr("score % 100")
    low = hundreds * least + F.ceil(rest * least / 100)
    high = hundreds * most + F.floor(rest * most / 100)
    windows = near.where("score >= 0").withColumns({"low": low.cast("long"), "high": high.cast("long")}).where("low <= high")
    each = windows.groupBy("row").agg(
        F.collect_list(window(F.col("rank"), F.col("low"), F.col("high"), False, negatives)).alias("windows")
    )
    found = search(anchors.join(each, "row"), negatives)
    told = near.select("row", F.col("rank").cast("long").alias("key"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(told, ["row", "key"])
        .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
