"""Mixing of sources to target weights by nested hash-threshold histograms.

Every document has a place on a line, a hash of its id. A source that takes part of its
documents takes those below a threshold on that line. The threshold is found without
sorting: sizes are summed by source and range of the line, a running sum over the ranges
finds the one in which the budget ends, and only that range is cut finer, until it
cannot be divided further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import n_words, packed
from rostra.sources.tables import materialize

# Fixed values of the production mix: weights of the sources in the order of their names,
# repeating; what they share, as part of all sizes; and the most copies of a source.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
# The line has 48 bits, four levels of 4,096 ranges.
_DIGITS, _LEVELS = 12, 4


def place(doc_id: Column) -> Column:
    """48-bit place of an id; a null id is placed like an empty one."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_copies: int = MOST_COPIES,
) -> DataFrame:
    """``target double`` for every row (``source``, ``source_size``) of a table of sources.

    Sources have the weights in turn, in the order of code points, a null source last.
    They divide ``share`` of all sizes by weight; a target stops at ``most_copies`` times
    its source's size, and the excess is shared by weight until none is above. Sorted by
    size over weight, the sources that stop come first: the level at which the others
    stand follows from running sums. One row per source passes through one task here.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    weighted = weighted.withColumn("most", F.col("source_size").cast("double") * most_copies)
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The first source that does not stop sets the level of all after it.
    free = F.min(
        F.when(F.col("most") > F.col("level") * F.col("weight"), F.struct("rank", "level"))
    ).over(everything)
    return (
        weighted.withColumns({"level": level, "rank": F.row_number().over(filling)})
        .withColumn("free", free)
        .withColumn(
            "target",
            F.when(F.col("rank") >= F.col("free.rank"), F.col("free.level") * F.col("weight")).otherwise(F.col("most")),
        )
        .select("source", "source_size", "target")
    )


def _thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source``, ``below``: places below it are taken.

    ``docs`` has source, size and place; ``budgets`` has source and budget, 0 or more.
    Documents at one place are taken together. The last of them is taken if that comes
    at least as near to the budget as leaving it.
    """
    # Where the budget ends so far: places from ``start`` on, after ``spent`` words.
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("spent"))
    by_place = Window.partitionBy("source").orderBy("range")
    for level in range(1, _LEVELS + 1):
        shift = _DIGITS * (_LEVELS - level)
        within = docs.join(state.select("source", "start"), _same_source(docs, state)).select(
            docs["source"], "size", F.shiftright("place", shift).alias("range"), "start"
        )
        if level > 1:
            within = within.where(F.shiftright("range", _DIGITS) == F.shiftright("start", shift + _DIGITS))
        histogram = within.groupBy("source", "range").agg(F.sum("size").alias("size"))
        last = level == _LEVELS
        running = (
            histogram.withColumnRenamed("source", "of")
            .join(state, F.col("of").eqNullSafe(F.col("source")))
            .drop("of")
            .withColumn("until", F.col("spent") + F.sum("size").over(by_place))
        )
        # The first range in which the budget is passed; at the last level also its size.
        passed = running.where(F.col("until") > F.col("budget")).groupBy("source").agg(
            F.min(F.struct("range", "until", "size")).alias("at")
        )
        at = F.col("at.range")
        before = F.col("at.until") - F.col("at.size")
        left = state.withColumnRenamed("source", "of").join(
            passed, F.col("of").eqNullSafe(F.col("source")), "left"
        )
        if last:
            nearer = F.col("at.until") - F.col("budget") <= F.col("budget") - before
            below = F.when(F.col("at").isNull(), F.lit(1 << (_DIGITS * _LEVELS))).otherwise(
                at + nearer.cast("long")
            )
            return left.select(F.col("of").alias("source"), below.cast("long").alias("below"))
        # A budget that is never passed ends behind everything.
        state = materialize(
            left.select(
                F.col("of").alias("source"),
                "budget",
                F.coalesce(F.shiftleft(at, shift), F.lit(1 << (_DIGITS * _LEVELS))).cast("long").alias("start"),
                F.coalesce(before, F.col("spent")).alias("spent"),
            )
        )
    raise AssertionError


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_copies: int = MOST_COPIES,
) -> DataFrame:
    """The rows with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words, 0 for a null text. A source whose target is ``k``
    whole sizes and a rest takes every document ``k`` times and once more those below
    its threshold, so ``copies`` is at most ``most_copies`` and ``taken`` is
    ``copies * size``. A null source is a source; a source without words has target 0
    and copies nothing. Reruns agree, as a document's place depends on its id alone;
    rows of one id are taken together. Columns of those names are replaced.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    docs = docs.drop(*new)
    narrow = materialize(
        docs.select(
            F.col(source).cast("string").alias("source"),
            n_words(F.col(text)).alias("size"),
            place(F.col(doc_id)).alias("place"),
        )
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = materialize(targets(sizes, weights, share, most_copies))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    whole = F.least(whole, F.lit(most_copies)).cast("long")
    budgets = aims.withColumn("whole", whole).withColumn(
        "budget", F.col("target") - F.col("whole") * F.col("source_size")
    )
    below = _thresholds(narrow, budgets.where("budget > 0").select("source", "budget"))
    plan = materialize(
        budgets.join(below.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("of"), "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below")
        )
    )
    copies = F.when(
        F.col("source_size") > 0, F.col("whole") + (F.col("place") < F.col("below")).cast("long")
    ).otherwise(F.lit(0).cast("long"))
    return (
        docs.select(
            packed(docs).alias("row"),
            n_words(F.col(text)).alias("size"),
            F.col(source).cast("string").alias("own"),
            place(F.col(doc_id)).alias("place"),
        )
        .join(plan, F.col("own").eqNullSafe(F.col("of")), "left")
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("row.*", *new)
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """Every row of a mix as often as it is taken, without the columns that ``mix`` added."""
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    rows = packed(mixed.drop("size", "source_size", "target", "copies", "taken"))
    return mixed.where("copies > 0").select(rows.alias("row"), each).select("row.*")
