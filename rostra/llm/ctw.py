"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision has a tree of contexts, the bytes before
it, up to a depth; a node holds Krichevsky-Trofimov estimates from its visits in the
training texts. The weighted probability of a node is half its own and half the product
of its children's, so a prediction mixes the estimates of all depths on its path by how
well each explains the training texts.

``score`` keeps every context that a training text visited. The tree is never in one
place: a path is written nearest byte first, so the contexts that share their two nearest
bytes are a subtree, and each subtree is a group of its own. Only the levels above are
shared, which the number of bytes bounds and not the corpus.

``fit`` makes a tree for one process instead. There a node has at least one in
``support`` of all visits, and visits of other children are pooled in one child, so that
the mixture stays a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import blocks, byte_view, lower_table
from rostra.sources.tables import materialize

DEPTH = 5
SUPPORT = 1 << 17
# A byte that UTF-8 never has ends every text, and a zero byte stands before its first.
_END, _START = 255, 0
# Bytes of text that make one row of the intermediate table, and whose grams are worked
# on at once.
_BLOCK, _PART = 12_000_000, 1_000_000
# Nearest bytes of a context that name its subtree.
_TOP = 2
# Groups that the subtrees are dealt to; most have few paths.
_GROUPS = 512
# Distinct grams that a task gathers before it sends them on.
_HELD = 2_000_000
_CACHE_BITS = 21


def _grams(column: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams (``depth`` bytes and the byte after them) of all positions, and their row."""
    return _packed(*byte_view(column), depth, [8 * back for back in range(depth + 1)])


def _paths(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams with their context nearest byte first, so that a shorter context is a prefix."""
    return _packed(data, offsets, depth, [0, *[8 * (depth + 1 - back) for back in range(1, depth + 1)]])


def _packed(data: np.ndarray, offsets: np.ndarray, depth: int, shifts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(offsets)
    n = len(lengths)
    row = np.repeat(np.arange(n), lengths + 1)
    line = np.full(len(data) + n * (depth + 1), _START, np.uint8)
    # A row has ``depth`` start bytes, its text and the end byte.
    first = offsets[:-1] + np.arange(n) * (depth + 1) + depth
    line[np.arange(len(data)) + np.repeat(first - offsets[:-1], lengths)] = lower_table()[data]
    line[first + lengths] = _END
    at = np.arange(len(row)) + np.repeat(np.arange(1, n + 1) * depth, lengths + 1)
    grams = np.zeros(len(line), np.uint64)
    for back in range(depth, -1, -1):
        grams[depth:] |= line[depth - back : len(line) - back].astype(np.uint64) << np.uint64(shifts[back])
    return grams[at], row


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps up where it is good to 1e-11."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    steps = sum(np.log(x + i) for i in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Tree:
    """Open-addressed table: probability that the next bit is one, at the end of a path.

    A key is the depth, the context and the decision (a one and the bits of the byte so
    far). Key 0 is no key.
    """

    depth: int
    bits: int
    keys: np.ndarray
    ones: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Probabilities of the keys, NaN for those that are not in the tree."""
        found = np.full(len(keys), np.nan, np.float32)
        open_ = np.arange(len(keys))
        slot = _slot(keys, self.bits)
        while len(open_):
            held = self.keys[slot]
            hit = held == keys[open_]
            found[open_[hit]] = self.ones[slot[hit]]
            going = ~hit & (held != 0)
            open_ = open_[going]
            slot = (slot[going] + 1) & (len(self.keys) - 1)
        return found

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each gram after those before it."""
        total = np.zeros(len(grams))
        byte = grams & np.uint64(255)
        for decision in range(8):
            node = np.uint64(1 << decision) | byte >> np.uint64(8 - decision)
            one = np.full(len(grams), np.nan, np.float32)
            for depth in range(self.depth, -1, -1):
                left = np.flatnonzero(np.isnan(one))
                if not len(left):
                    break
                context = (grams[left] >> np.uint64(8)) & np.uint64((1 << (8 * depth)) - 1)
                one[left] = self.find(_key(depth, context, node[left]))
            one = np.where(np.isnan(one), 0.5, one.astype(np.float64))
            bit = (byte >> np.uint64(7 - decision)) & np.uint64(1)
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return total


def _key(depth: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return np.uint64((depth + 1) << 56) | context.astype(np.uint64) << np.uint64(8) | node.astype(np.uint64)


def build_tree(nodes: pa.Table, depth: int) -> Tree:
    """Mix the nodes (``depth``, ``context``, ``node``, ``zeros``, ``ones``) of a tree that is closed
    under parents."""
    levels = []
    column = {name: nodes[name].to_numpy() for name in ("depth", "context", "node", "zeros", "ones")}
    for d in range(depth + 1):
        own = column["depth"] == d
        context, node = column["context"][own].astype(np.uint64), column["node"][own].astype(np.uint64)
        keys = _key(d, context, node)
        order = np.argsort(keys)
        level = {"keys": keys[order], "zeros": column["zeros"][own][order].astype(float)}
        level["ones"] = column["ones"][own][order].astype(float)
        if d:
            shorter = context[order] & np.uint64((1 << (8 * (d - 1))) - 1)
            level["parent"] = np.searchsorted(levels[d - 1]["keys"], _key(d - 1, shorter, node[order]))
        levels.append(level)
    for d in range(depth, -1, -1):
        level = levels[d]
        n = len(level["keys"])
        own = kt(level["zeros"], level["ones"])
        below, zeros, ones = np.zeros(n), level["zeros"].copy(), level["ones"].copy()
        if d < depth:
            child = levels[d + 1]
            below += np.bincount(child["parent"], child["weighted"], minlength=n)
            zeros -= np.bincount(child["parent"], child["zeros"], minlength=n)
            ones -= np.bincount(child["parent"], child["ones"], minlength=n)
        # The children that are not in the tree share one.
        below += kt(zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        level["weighted"] = own if d == depth else weighted
        level["stop"] = np.ones(n) if d == depth else np.exp(own - math.log(2) - weighted)
        estimate = (level["ones"] + 0.5) / (level["zeros"] + level["ones"] + 1)
        level["estimate"] = estimate
        pooled = (ones + 0.5) / (zeros + ones + 1)
        level["pooled"] = np.where(zeros + ones > 0, pooled, estimate)
    size = sum(len(level["keys"]) for level in levels)
    bits = max(4, (2 * size).bit_length())
    table, values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.float32)
    mixed, left = None, None
    for d, level in enumerate(levels):
        before = mixed[level["parent"]] if d else np.zeros(len(level["keys"]))
        part = left[level["parent"]] if d else np.ones(len(level["keys"]))
        mixed = before + part * level["stop"] * level["estimate"]
        left = part * (1 - level["stop"])
        _insert(table, values, level["keys"], (mixed + left * level["pooled"]).astype(np.float32), bits)
    return Tree(depth, bits, table, values)


def _insert(table: np.ndarray, values: np.ndarray, keys: np.ndarray, ones: np.ndarray, bits: int) -> None:
    """Put distinct keys into free slots, each into the first one from its own on."""
    slot = _slot(keys, bits)
    while len(keys):
        free = table[slot] == 0
        _, first = np.unique(slot[free], return_index=True)
        chosen = np.flatnonzero(free)[first]
        table[slot[chosen]], values[slot[chosen]] = keys[chosen], ones[chosen]
        rest = np.ones(len(keys), bool)
        rest[chosen] = False
        keys, ones, slot = keys[rest], ones[rest], slot[rest]
        slot = np.where(table[slot] == 0, slot, (slot + 1) & (len(table) - 1))


def fit(training: DataFrame, text: str = "text", depth: int = DEPTH, support: int = SUPPORT) -> Tree:
    """Count the training texts and mix a tree that is small enough for one process, see above.

    Null texts count as empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([n for _, n in held])[order]
            starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
            return keys[starts], np.add.reduceat(n, starts)

        def sent(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"gram": keys.view(np.int64), "n": n})

        for block in blocks(batches, "text", _PART):
            grams, _ = _grams(block.column("text"), depth)
            grams.sort()
            starts = np.flatnonzero(np.diff(grams, prepend=grams[:1] ^ np.uint64(1)))
            held.append((grams[starts], np.diff(starts, append=len(grams))))
            if sum(len(keys) for keys, _ in held) > _HELD:
                held = [merged()]
                if len(held[0][0]) > _HELD // 2:
                    yield sent(*held.pop())
        if held:
            yield sent(*merged())

    counted = materialize(
        training.select(F.col(text).alias("text"))
        .mapInArrow(count, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )
    visits = counted.agg(F.sum("n")).first()[0] or 0
    least = F.lit(visits / support)
    levels = None
    for d in range(depth, -1, -1):
        gram = F.col("gram").bitwiseAND(F.lit((1 << (8 * (d + 1))) - 1))
        of_context = Window.partitionBy("context")
        shared = (
            counted.groupBy(gram.alias("gram"))
            .agg(F.sum("n").alias("n"))
            .select(F.shiftrightunsigned("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit(255)).alias("byte"), "n")
            # At most 256 rows per context; only what can hold a node goes on.
            .withColumn("visits", F.sum("n").over(of_context))
            .where(F.col("visits") >= least)
        )
        decisions = F.explode(F.array(*[
            F.struct(
                F.lit(1 << i).bitwiseOR(F.shiftright("byte", 8 - i)).alias("node"),
                F.shiftright("byte", 7 - i).bitwiseAND(F.lit(1)).alias("bit"),
            )
            for i in range(8)
        ]))
        level = (
            shared.select("context", "n", decisions.alias("x"))
            .groupBy("context", "x.node")
            .agg(
                F.sum(F.when(F.col("x.bit") == 0, F.col("n")).otherwise(0)).alias("zeros"),
                F.sum(F.when(F.col("x.bit") == 1, F.col("n")).otherwise(0)).alias("ones"),
            )
            .where(F.col("zeros") + F.col("ones") >= least)
            .select(F.lit(d).alias("depth"), "context", "node", "zeros", "ones")
        )
        levels = level if levels is None else levels.unionByName(level)
    # At most 8 * (depth + 1) * support nodes.
    return build_tree(levels.toArrow(), depth)


class _Scorer:
    """Scores of one Python worker, with the grams it met last."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.grams = np.full(1 << _CACHE_BITS, 1 << 63, np.uint64)
        self.logs = np.zeros(1 << _CACHE_BITS)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        slot = _slot(grams, _CACHE_BITS)
        logs = self.logs[slot]
        missed = np.flatnonzero(self.grams[slot] != grams)
        if len(missed):
            new, at = np.unique(grams[missed], return_inverse=True)
            found = self.tree.log10(new)
            logs[missed] = found[at]
            slot = _slot(new, _CACHE_BITS)
            self.grams[slot], self.logs[slot] = new, found
            # Where several grams fell on a slot, grams and logs have the same last one.
        return logs


_ROW = (
    "block long, row binary, words array<binary>, trained array<long>, "
    "packs array<struct<context:int,data:binary>>, text binary, sizes binary"
)
_PACK = pa.list_(pa.struct([("context", pa.int32()), ("data", pa.binary())]))


def _pack(paths: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending paths and their training visits; bytes of one place lie together, as most are zero."""
    both = np.stack([np.diff(paths, prepend=np.uint64(0)), n.astype(np.uint64)])
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes())


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    apart = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 8, -1)
    steps, n = np.ascontiguousarray(apart.transpose(0, 2, 1)).view(np.uint64)[..., 0]
    return np.cumsum(steps, dtype=np.uint64), n.astype(np.int64)


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``_PART`` bytes together."""
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + _PART, side="right")) - 1)
        yield start, stop
        start = stop


def _visits(data: np.ndarray, offsets: np.ndarray, trains: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths of a block, ascending, and how often its training rows visit each."""
    found, counts = [], []
    for start, stop in _parts(offsets):
        paths, row = _paths(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], depth)
        # A path has at most seven bytes, so the mark of its row fits beside it.
        marked = paths << np.uint64(1) | trains[start:stop][row].astype(np.uint64)
        marked.sort()
        distinct, n = _sums(marked >> np.uint64(1), (marked & np.uint64(1)).astype(np.int64))
        found.append(distinct)
        counts.append(n)
    return _merged(found, counts)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Words of a block in the order they come first, the word at every place, and words per row."""
    codes: dict[bytes, int] = {}
    whole, coded, sizes = data.tobytes(), [], []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        words = whole[start:stop].lower().split()
        coded.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int32, len(words)))
        sizes.append(len(words))
    return codes, np.concatenate(coded), np.array(sizes, np.int64)


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys of an ascending array, and the sums of the values of each."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
    return keys[starts], *[np.add.reduceat(v, starts) if len(starts) else v for v in values]


def _merged(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths of several lists, ascending, and the sums of their visits."""
    paths, n = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(paths, kind="stable")
    return _sums(paths[order], n[order])


def _decision(paths: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and node of the i-th decision, which ascend with the paths, and its bit."""
    byte = paths & np.uint64(255)
    node = np.uint64(1 << i) | byte >> np.uint64(8 - i)
    return paths & ~np.uint64(255) | node, byte >> np.uint64(7 - i) & np.uint64(1)


def _subtree(paths: np.ndarray, n: np.ndarray, depth: int) -> list[list[dict[str, np.ndarray]]]:
    """Levels from ``_TOP`` to ``depth`` for each of the eight decisions, weighted from the leaves up."""
    shorter = []
    for d in range(_TOP, depth + 1):
        cut = (paths >> np.uint64(8 * (depth - d + 1))) << np.uint64(8) | paths & np.uint64(255)
        order = np.argsort(cut, kind="stable")
        shorter.append(_sums(cut[order], n[order]))
    decisions = []
    for i in range(8):
        levels = []
        for cut, visits in shorter:
            keys, bit = _decision(cut, i)
            keys, zeros, ones = _sums(keys, visits * (bit == 0), visits * (bit == 1))
            level = {"keys": keys, "zeros": zeros, "ones": ones, "own": kt(zeros.astype(float), ones.astype(float))}
            level["estimate"] = (ones + 0.5) / (zeros + ones + 1)
            if levels:
                above = (keys >> np.uint64(16)) << np.uint64(8) | keys & np.uint64(255)
                level["parent"] = np.searchsorted(levels[-1]["keys"], above)
            levels.append(level)
        levels[-1]["weighted"] = levels[-1]["own"]
        for level, child in zip(levels[-2::-1], levels[:0:-1]):
            below = np.bincount(child["parent"], child["weighted"], minlength=len(level["keys"]))
            level["weighted"] = np.logaddexp(level["own"], below) - math.log(2)
        decisions.append(levels)
    return decisions


@dataclass(frozen=True)
class _Upper:
    """Depths 0 and 1, by the nearest byte and node: what is mixed so far, the share left to
    deeper contexts, and the probability of a one where no deeper context was visited."""

    mixed: np.ndarray
    left: np.ndarray
    one: np.ndarray


def _mix_upper(nodes: pa.Table) -> _Upper:
    """Mix the sums over the subtrees (``near``, ``node``, ``zeros``, ``ones``, ``below``)."""
    near, node = nodes["near"].to_numpy(), nodes["node"].to_numpy()
    zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
    for grid, name in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        grid[near, node] = nodes[name].to_numpy()

    def level(zeros, ones, below):
        own = kt(zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        return weighted, np.exp(own - math.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1)

    # A node without visits has the log probability 0 on both sides.
    weighted, stop, estimate = level(zeros, ones, below)
    _, stop0, estimate0 = level(zeros.sum(0), ones.sum(0), np.where(zeros + ones > 0, weighted, 0).sum(0))
    mixed, left = stop0 * estimate0, 1 - stop0
    one = np.where(zeros + ones > 0, mixed + left * estimate, estimate0)
    return _Upper(mixed + left * stop * estimate, left * (1 - stop), one)


def _log10(asked: np.ndarray, n: np.ndarray, depth: int, upper: _Upper) -> np.ndarray:
    """Log10 probabilities of the ascending paths of whole subtrees, all levels mixed."""
    total = np.zeros(len(asked))
    near = asked >> np.uint64(8 * depth)
    seen = n > 0
    decisions = _subtree(asked[seen], n[seen], depth)
    for i, levels in enumerate(decisions):
        node, bit = _decision(asked, i)
        one = upper.one[near, node & np.uint64(255)]
        mixed = left = None
        for d, level in enumerate(levels, _TOP):
            if not len(level["keys"]):
                break
            if mixed is None:
                above = level["keys"] >> np.uint64(16), level["keys"] & np.uint64(255)
                before, part = upper.mixed[above], upper.left[above]
            else:
                before, part = mixed[level["parent"]], left[level["parent"]]
            stop = np.ones(len(before)) if d == depth else np.exp(level["own"] - math.log(2) - level["weighted"])
            mixed, left = before + part * stop * level["estimate"], part * (1 - stop)
            value = mixed + left * level["estimate"]
            keys = (asked >> np.uint64(8 * (depth - d + 1))) << np.uint64(8) | node & np.uint64(255)
            at = np.minimum(np.searchsorted(level["keys"], keys), len(level["keys"]) - 1)
            one = np.where(level["keys"][at] == keys, value[at], one)
        total += np.log10(np.where(bit == 1, one, 1 - one))
    return total


def _path_scores(packs: DataFrame, depth: int) -> DataFrame:
    """``of``, ``context`` and ``logs`` of the packs: log10 probabilities of their paths under
    the tree of all of them."""

    def count(packs: pa.Table) -> pa.Table:
        paths, n = _merged(*zip(*[_unpack(pack.as_py()) for pack in packs["data"]]))
        out: dict[str, list[np.ndarray]] = {name: [] for name in ("near", "node", "zeros", "ones", "below")}
        for top, *_ in _subtree(paths[n > 0], n[n > 0], depth):
            out["near"].append((top["keys"] >> np.uint64(16)).astype(np.int32))
            out["node"].append((top["keys"] & np.uint64(255)).astype(np.int32))
            for name, column in (("zeros", "zeros"), ("ones", "ones"), ("below", "weighted")):
                out[name].append(top[column])
        return pa.table({name: np.concatenate(values) for name, values in out.items()})

    # A number of partitions of its own: packs are small for the work they are.
    partitions = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packs.withColumn("group", F.pmod(F.hash("context"), F.lit(_GROUPS))).repartition(partitions, "group")
    nodes = dealt.groupBy("group").applyInArrow(count, "near int, node int, zeros long, ones long, below double")
    # At most 256 bytes with 255 nodes each, whatever the corpus.
    sums = nodes.groupBy("near", "node").agg(*[F.sum(name).alias(name) for name in ("zeros", "ones", "below")])
    shared = packs.sparkSession.sparkContext.broadcast(_mix_upper(sums.toArrow()))

    def look_up(packs: pa.Table) -> pa.Table:
        distinct, n = _merged(*zip(*[_unpack(pack.as_py()) for pack in packs["data"]]))
        logs = _log10(distinct, n, depth, shared.value).astype(np.float32)
        found = [logs[np.searchsorted(distinct, _unpack(pack.as_py())[0])].tobytes() for pack in packs["data"]]
        return pa.table({"of": packs["of"], "context": packs["context"], "logs": pa.array(found, pa.binary())})

    return dealt.groupBy("group").applyInArrow(look_up, "of long, context int, logs binary")


def score(
    docs: DataFrame,
    is_training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
) -> DataFrame:
    """Scores of all texts under models learned from those of ``is_training``.

    Returns, row by row, ``doc_id`` (a number), ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``. Texts are lower-cased
    (A-Z); a null text is empty. ``score`` is the log10 probability of all bytes of the
    text and its end under the context tree, ``bits_per_byte`` its code length. The base
    model is a unigram over words and the end, with one added to each count; ``n_known``
    are the tokens that occur in training, the end included once there is a training
    text. Without training rows all counts are 0 and every bit is even.
    """
    if not _TOP <= depth <= 6:
        raise ValueError(f"depth must be from {_TOP} to 6")
    marked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(is_training, F.lit(False)).alias("trains")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3)
        number = TaskContext.get().partitionId() << 32
        for block in blocks(batches, "text", _BLOCK):
            data, offsets = byte_view(block.column("text"))
            trains = block.column("trains").to_numpy(zero_copy_only=False)
            paths, n = _visits(data, offsets, trains, depth)
            context = (paths >> np.uint64(8 * (depth + 1 - _TOP))).astype(np.int32)
            starts = np.flatnonzero(np.diff(context, prepend=-1))
            packs = [
                {"context": context[start], "data": _pack(paths[start:stop], n[start:stop])}
                for start, stop in zip(starts, [*starts[1:], len(paths)])
            ]
            codes, flat, sizes = _words(data, offsets)
            trained = np.bincount(flat[np.repeat(trains, sizes)], minlength=len(codes))
            ids = block.column("doc_id")
            known = np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, 0)
            rows = np.stack([
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), trains.astype(np.int64), known.astype(np.int64)
            ])
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int64()),
                    "row": pa.array([rows.tobytes()], pa.binary()),
                    "words": pa.array([list(codes)], pa.list_(pa.binary())),
                    "trained": pa.array([trained.tolist()], pa.list_(pa.int64())),
                    "packs": pa.array([packs], _PACK),
                    "text": pa.array([squeeze.compress(data.tobytes())], pa.binary()),
                    "sizes": pa.array([np.diff(offsets).astype(np.int64).tobytes()], pa.binary()),
                }
            )
            number += 1

    coded = materialize(marked.mapInArrow(cut, _ROW))
    packs = coded.select(F.col("block").alias("of"), F.inline("packs"))
    words = coded.select(
        F.col("block").alias("of"), F.posexplode(F.arrays_zip("words", "trained")).alias("code", "x")
    ).select("of", "code", F.col("x.words").alias("word"), F.col("x.trained").alias("trained"))
    # One row per block and word; a frequent word is summed before the shuffle.
    counts = materialize(words.where("trained > 0").groupBy("word").agg(F.sum("trained").alias("c")))
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = marked.where("trains").count()
    n_tokens, vocabulary = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    # A word that does not come back has no count.
    looked_up = words.join(counts, "word").select("of", "code", "c", F.lit(None).cast("binary").alias("logs"))
    # Rows of a block: its words with their counts, and its subtrees (count -1) with their logs.
    found = looked_up.unionByName(
        _path_scores(packs, depth).select("of", F.col("context").alias("code"), F.lit(-1).cast("long").alias("c"), "logs")
    )

    def sums(texts: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in _RESULT}
        is_word = pc.greater_equal(found["c"], 0)
        of_words, of_paths = found.filter(is_word), found.filter(pc.invert(is_word)).sort_by("code")
        logs = np.concatenate([np.frombuffer(x.as_py(), np.float32) for x in of_paths["logs"]])
        for block in texts.to_pylist():
            ids, trains, missing = np.frombuffer(block["row"], np.int64).reshape(3, -1)
            data = np.frombuffer(zstandard.ZstdDecompressor().decompress(block["text"]), np.uint8)
            length = np.frombuffer(block["sizes"], np.int64)
            offsets = np.concatenate([[0], np.cumsum(length)])
            paths, _ = _visits(data, offsets, trains == 1, depth)
            score_ = np.zeros(len(ids))
            for start, stop in _parts(offsets):
                own, row = _paths(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], depth)
                order = np.argsort(own)
                score_[start:stop] = np.bincount(row[order], logs[np.searchsorted(paths, own[order])], minlength=stop - start)
            distinct, codes, sizes = _words(data, offsets)
            c = np.zeros(len(distinct), np.int64)
            c[of_words["code"].to_numpy()] = of_words["c"].to_numpy()
            row = np.repeat(np.arange(len(ids)), sizes)
            below = n_tokens + vocabulary + 1
            base = np.bincount(row, np.log10((c[codes] + 1) / below), minlength=len(ids))
            out["doc_id"] += [None if gone else i for i, gone in zip(ids.tolist(), missing.tolist())]
            out["held_out"] += (trains == 0).tolist()
            out["n_tokens"] += (sizes + 1).tolist()
            known = np.bincount(row, c[codes] > 0, minlength=len(ids)).astype(np.int64)
            out["n_known"] += (known + (ends > 0)).tolist()
            out["train_tokens"] += [n_tokens] * len(ids)
            out["base_score"] += (base + math.log10((ends + 1) / below)).tolist()
            out["score"] += score_.tolist()
            out["bits_per_byte"] += (-score_ / math.log10(2) / (length + 1)).tolist()
        return pa.table(out, schema=pa.schema([(n, _RESULT[n]) for n in _RESULT]))

    return (
        coded.select("block", "row", "text", "sizes")
        .groupBy("block")
        .cogroup(found.groupBy("of"))
        .applyInArrow(
            sums,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double, bits_per_byte double",
        )
    )


_RESULT = {
    "doc_id": pa.int64(),
    "held_out": pa.bool_(),
    "n_tokens": pa.int64(),
    "n_known": pa.int64(),
    "train_tokens": pa.int64(),
    "base_score": pa.float64(),
    "score": pa.float64(),
    "bits_per_byte": pa.float64(),
}
