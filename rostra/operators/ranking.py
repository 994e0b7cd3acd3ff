"""Row selection and ranking that stay distributed when one group is huge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group. Spark keeps one candidate per key and task before
    the shuffle, so a group of any size reaches its final task as a handful of rows."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


# More ranges than this make the range expression unwieldy.
MAX_BUCKETS = 512


def split_points(rows: DataFrame, order: list[str], buckets: int) -> list[tuple]:
    """Up to ``buckets - 1`` points that cut the ordering of ``rows`` into even ranges.

    The sample holds 16 rows per bucket, those with the smallest hash of the ordering
    columns: uniform over rows, the same on every run, and bounded wherever it travels.
    A share of the hashes that holds a few times as many is cut out first, so that a task
    sends no more than its part of them.
    """
    if buckets < 2:
        return []
    share = max(1, rows.count() // (64 * buckets))
    sample = (
        rows.select(*order)
        .where(F.pmod(F.xxhash64(*order), F.lit(share)) == 0)
        .orderBy(F.xxhash64(*order), *order)
        .limit(16 * buckets)
    )
    picked = sorted(tuple(row) for row in sample.dropna().collect())
    cuts = [picked[len(picked) * i // buckets] for i in range(1, buckets)] if picked else []
    return sorted(set(cuts))


def range_bucket(order: list[str], points: list[tuple]) -> Column:
    """Number of split points at or before a row's position, by binary search."""
    position = F.struct(*order)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        bound = F.struct(*[F.lit(v).alias(c) for v, c in zip(points[middle], order)])
        return F.when(position < bound, search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(points))


def ranked_in_groups(
    rows: DataFrame,
    group: list[str],
    tie_order: list[str],
    rankings: dict[str, list[tuple[str, str]]],
    buckets: int | None = None,
    sample_from: DataFrame | None = None,
) -> DataFrame:
    """Add one exact ``row_number`` per entry of ``rankings``.

    Every ranking orders a group by its own low-cardinality columns (name, ``asc``
    or ``desc``) and then by the shared ``tie_order``. A plain window would sort a
    whole group in one task. Here rows are spread over cells (group, columns common
    to all rankings, range of the tie order); a row's rank is the number of rows in
    earlier cells plus its place in its own cell. The cell counts are aggregated
    before they are shuffled, and all rankings share one shuffle of the rows: cells that
    lie in one partition are a list there, in which a row finds its own.

    ``rows`` are read twice, for the counts and for the places: give stored ones where they
    are costly to derive.

    ``sample_from`` may name a cheaper table with the tie columns, from which the
    ranges are chosen; the choice balances the cells and never changes a rank. There
    are as many ranges as shuffle partitions unless ``buckets`` says otherwise.
    """
    if buckets is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(partitions, MAX_BUCKETS)
    sampled = rows if sample_from is None else sample_from
    bucket = range_bucket(tie_order, split_points(sampled, tie_order, buckets))
    rows = rows.withColumn("_bucket", bucket)
    leading = {name: [column for column, _ in order] for name, order in rankings.items()}
    finest = list(dict.fromkeys(column for columns in leading.values() for column in columns))
    common = [column for column in finest if all(column in c for c in leading.values())]
    cell = [*group, *finest, "_bucket"]

    def rows_before(name):
        order = [
            F.col(column).desc() if direction == "desc" else F.col(column).asc()
            for column, direction in rankings[name]
        ]
        up_to_here = (
            Window.partitionBy(*group)
            .orderBy(*order, "_bucket")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )
        here = Window.partitionBy(*group, *leading[name], "_bucket")
        return F.sum("_rows").over(up_to_here) - F.sum("_rows").over(here)

    # Cells that share these columns meet the rows by one number, so that neither is moved again.
    spot = [*group, *common, "_bucket"]
    rows = rows.withColumn("_spot", F.xxhash64(*[F.col(c).isNull() for c in spot], *spot))
    counts = rows.groupBy("_spot", *cell).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = (
        counts.select("_spot", *cell, *[rows_before(name).alias(f"_before_{name}") for name in rankings])
        .groupBy("_spot")
        .agg(F.collect_list(F.struct(*cell, *[f"_before_{name}" for name in rankings])).alias("_cells"))
    )

    def place(name):
        in_cell = Window.partitionBy("_spot", *group, *leading[name], "_bucket").orderBy(*tie_order)
        return F.row_number().over(in_cell)

    placed = rows.repartition("_spot").withColumns({f"_place_{name}": place(name) for name in rankings})
    own = F.filter("_cells", lambda o: reduce(lambda a, b: a & b, [o[c].eqNullSafe(F.col(c)) for c in cell]))
    found = placed.join(offsets, "_spot", "left").withColumn("_own", F.get(own, F.lit(0))).drop("_cells")
    ranks = {
        name: (F.col("_own")[f"_before_{name}"] + F.col(f"_place_{name}")).cast("int") for name in rankings
    }
    return found.select(
        *[column for column in rows.columns if column not in ("_bucket", "_spot")],
        *[rank.alias(name) for name, rank in ranks.items()],
    )
