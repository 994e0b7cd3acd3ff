"""Connected components of a link table, by joins and aggregates alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.sources.tables import materialize, release

# After the first round, so many times more members of a bucket lead in each.
MORE_LEADERS = 32


def connected_components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every linked node.

    ``links`` has columns ``a`` and ``b``, not null; direction, repetition and loops do
    not matter. Large-star and small-star steps alternate: each links the neighbours of
    a node to the smallest of them, until every node hangs from the root of a star. Every
    step is an aggregate and an equi-join whose result is written to the shared folder,
    and released when the next one is there; a node with very many neighbours is split
    by the join, never gathered. The links of the result stay in the shared folder.
    """
    links = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(rounds):
        if _are_stars(links):
            break
        large = materialize(_large_star(links))
        release(links)
        links = materialize(_small_star(large))
        release(large)
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _are_stars(links: DataFrame) -> bool:
    """Whether each node is the larger end of one link or the smaller end of any number, not both."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    both = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least one, or to the node."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node and the node itself go to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    small = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return small.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def linked_in_buckets(
    members: DataFrame,
    similar: Callable[[DataFrame], DataFrame],
    rest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``node`` and ``component`` of nodes that are similar to another of their bucket.

    ``members`` has distinct ``bucket`` and ``node`` with the ``size`` of the node;
    ``similar`` gets pairs ``a``, ``b`` with ``a_size``, ``b_size`` and the groups ``a_group``,
    ``b_group`` they are known to be in, and returns those rows that are linked. Members are
    compared with one leader of their bucket, then with 32, and so on, until the bucket is
    one component or each member has led: every link between two components is found,
    though not every link inside of one. Between rounds a component is one group, so that
    later rounds only link groups.

    ``rest`` may take the place of all rounds but the first. It gets ``head``, the leader of
    the first round, ``node``, ``size`` and ``group``, distinct, of the other members of all buckets
    that are not yet one group, and returns the pairs that may be similar: every link between
    two groups whose members share a bucket must be among them.
    """
    key, leaders = F.xxhash64("node"), 1
    groups = None
    led = [] if rest is None else [F.col("head").alias("past")]
    members = materialize(members.select("bucket", "node", "size", F.col("node").alias("group")))
    while True:
        heads = (
            members.groupBy("bucket")
            .agg(
                F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("n"),
                F.min(F.struct(key.alias("key"), "node")).alias("head"),
            )
            .where("low < high")
            .select("bucket", "n", F.col("head.node").alias("head"))
        )
        leads = (F.col("node") == F.col("head")) | (F.pmod(key, F.col("n")) < leaders - 1)
        last = rest is not None and groups is not None
        gone = ["n"] if led and not last else ["n", "head"]
        open_ones = materialize(members.join(heads, "bucket").withColumn("leads", leads).drop(*gone))
        release(members)
        if open_ones.isEmpty():
            release(open_ones)
            break
        if last:
            pairs = rest(open_ones.select(F.col("past").alias("head"), "node", "size", "group").distinct())
        else:
            pairs = _pairs_of_leaders(open_ones, key)
        found = similar(pairs).select(F.col("a_group").alias("a"), F.col("b_group").alias("b"))
        merged = connected_components(found).withColumnsRenamed({"node": "group", "component": "into"})
        before, groups = groups, materialize(
            merged.toDF("node", "component") if groups is None else _merged(groups, merged)
        )
        if before is not None:
            release(before)
        if last:
            release(open_ones)
            break
        members = materialize(
            open_ones.where(~F.col("leads"))
            .join(merged, "group", "left")
            .select("bucket", "node", "size", F.coalesce("into", "group").alias("group"), *led)
        )
        release(open_ones)
        leaders *= MORE_LEADERS
    if groups is None:
        return members.select("node", F.col("node").alias("component")).limit(0)
    return groups


def _pairs_of_leaders(open_ones: DataFrame, key: Column) -> DataFrame:
    """Each member with the leaders of its bucket that are in another group."""
    first = open_ones.where("leads").select(
        "bucket", F.struct(key.alias("key"), "node", "size", "group").alias("of"), F.col("group").alias("of_group")
    )
    return (
        open_ones.withColumn("own", F.struct(key.alias("key"), "node", "size", "group"))
        .join(first, "bucket")
        .where(F.col("group") != F.col("of_group"))
        # The first leader has the least key of its bucket, so it is ``b``.
        .select(F.greatest("own", "of").alias("a"), F.least("own", "of").alias("b"))
        .distinct()
        .select("a.node", "b.node", "a.size", "b.size", "a.group", "b.group")
        .toDF("a", "b", "a_size", "b_size", "a_group", "b_group")
    )


def _merged(groups: DataFrame, merged: DataFrame) -> DataFrame:
    """Groups of nodes after some groups went into others."""
    moved = groups.join(merged.withColumnRenamed("group", "component"), "component", "left")
    old = moved.select("node", F.coalesce("into", "component").alias("component"))
    # A node that was its own group so far is not among the groups.
    new = merged.join(groups.select(F.col("node").alias("group")), "group", "left_anti")
    return old.unionByName(new.select(F.col("group").alias("node"), F.col("into").alias("component")))
