"""Gold tables kept up to date: documents that changed decide what is aggregated again.

Counts could be added and subtracted, but a minimum, a maximum or a rank cannot: a group
that a changed document belongs to, or belonged to, is aggregated whole. All other groups
keep their rows, and parts of a table without a touched group keep their files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.operators.joins import join_bridge_expand
from rostra.plans import gold
from rostra.plans.documents import DATE_COLUMNS
from rostra.plans.gold import PERIOD
from rostra.sources.parts import PARTS, PartedTable, key_hash
from rostra.sources.tables import materialize, released


@dataclass(frozen=True)
class Star:
    """The tables that gold is aggregated from, at one point in time."""

    mentions: DataFrame
    documents: DataFrame
    dates: DataFrame
    categories: DataFrame
    contexts: DataFrame
    audit: DataFrame
    creator_bridge: DataFrame
    creators: DataFrame
    subject_bridge: DataFrame
    subjects: DataFrame


# Tables of a star that have rows for each document.
PER_DOCUMENT = ("mentions", "documents", "contexts", "audit", "creator_bridge", "subject_bridge")

# Columns that decide which rows are aggregated or ranked together. A table may cut its
# groups finer, by columns that go with a mention.
PERIOD_GROUP = [*PERIOD, "figure_id"]
GROUPS = {
    "mentions_by_period": PERIOD_GROUP,
    "stance_by_period": PERIOD_GROUP,
    "top_contexts": ["figure_id", "publication_year", "publication_month"],
    "stance_by_document": ["document_id"],
    "stance_by_creator": [*PERIOD, "figure_id", "creator_id"],
    "stance_by_subject": [*PERIOD, "figure_id", "subject_id"],
}
# Bridge, dimension, id, name and source of a member table.
MEMBERS = {
    "stance_by_creator": ("creator_bridge", "creators", "creator_id", "creator_name", "creator_source"),
    "stance_by_subject": ("subject_bridge", "subjects", "subject_id", "subject", "subject_source"),
}


def _from_mentions(name: str, star: Star) -> DataFrame:
    if name == "mentions_by_period":
        return gold.figure_mentions_by_period(star.mentions, star.dates, star.categories)
    if name == "stance_by_period":
        return gold.figure_stance_by_period(star.mentions, star.dates, star.categories)
    if name == "stance_by_document":
        return gold.figure_stance_by_document(star.mentions, star.documents, star.dates, star.categories)
    return gold.top_stance_contexts(
        star.mentions, star.documents, star.dates, star.contexts, star.categories, star.audit
    )


def _by_member(name: str, by_document: DataFrame, star: Star, placed: bool = False) -> DataFrame:
    bridge, members, *columns = MEMBERS[name]
    return gold.figure_stance_by_member(by_document, getattr(star, bridge), getattr(star, members), *columns, placed)


def changed_documents(before: Star, after: Star) -> DataFrame:
    """``document_id`` of every document some row of which was added, removed or altered.

    Compares one number per document and table, so only narrow rows are joined. A NULL
    ``document_id`` is none.
    """

    def state(rows: DataFrame) -> DataFrame:
        columns = sorted(rows.columns)
        row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
        return rows.groupBy("document_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("state")
        )

    def differing(table: str) -> DataFrame:
        old, new = state(getattr(before, table)), state(getattr(after, table))
        same = F.col("o.n").eqNullSafe(F.col("n.n")) & F.col("o.state").eqNullSafe(F.col("n.state"))
        joined = old.alias("o").join(new.alias("n"), "document_id", "full").where(~same)
        return joined.select("document_id").where("document_id IS NOT NULL")

    return reduce(DataFrame.unionByName, [differing(t) for t in PER_DOCUMENT]).distinct()


class GoldTables:
    """Gold tables in parts below ``root``: built once, then refreshed by documents.

    In a ``colocated`` star the tables with rows for each document are stored in buckets by it (``write_colocated``).
    The rows by document are then aggregated where they lie, and not read from their table, which is in other parts.
    """

    def __init__(
        self, spark: SparkSession, root: str, names: tuple[str, ...] = tuple(GROUPS), parts: int = PARTS, colocated: bool = False
    ):
        self.spark, self.root, self.parts, self.colocated = spark, root.rstrip("/"), parts, colocated
        # Member tables are aggregated from the table by document, which comes first.
        wanted = {*names, *(["stance_by_document"] if set(names) & set(MEMBERS) else [])}
        self.names = sorted(wanted, key=lambda name: name in MEMBERS)

    def _table(self, name: str, rows: DataFrame) -> PartedTable:
        return PartedTable(self.spark, f"{self.root}/{name}", rows.schema, GROUPS[name], self.parts)

    def _plan(self, name: str, star: Star) -> DataFrame:
        """A table as it is aggregated in full."""
        if name in MEMBERS:
            return _by_member(name, self._by_document(star), star, self.colocated)
        return _from_mentions(name, star)

    def _by_document(self, star: Star) -> DataFrame:
        """The rows of the table by document, which has been brought to this star."""
        return _from_mentions("stance_by_document", star) if self.colocated else self.read("stance_by_document", star)

    def read(self, name: str, star: Star) -> DataFrame:
        """A stored table; the star only gives its columns."""
        if name in MEMBERS:
            return self._table(name, _by_member(name, _from_mentions("stance_by_document", star), star)).read()
        return self._table(name, _from_mentions(name, star)).read()

    def build(self, star: Star) -> None:
        """Aggregate all tables in full."""
        for name in self.names:
            rows = self._plan(name, star)
            self._table(name, rows).write(rows)

    def refresh(self, before: Star, after: Star, changed: DataFrame) -> dict[str, list[int]]:
        """Bring the tables from one star to the other; returns the parts that were written.

        ``changed`` has the ``document_id`` of every document of which some row differs, see
        ``changed_documents``. After a run that broke off the same call finishes the work:
        touched groups follow from the stars and what they are aggregated from, and not
        from how far the gold tables have come.
        """
        written = {}
        with released(self.spark):
            changed = materialize(changed.select("document_id").distinct())
            for name in self.names:
                if name in MEMBERS:
                    touched, rows = self._member_groups(name, before, after, changed)
                elif name == "stance_by_document":
                    touched = changed.select(key_hash("document_id").alias("key"))
                    rows = _from_mentions(name, _restricted(after, lambda m: m.join(changed, "document_id", "left_semi")))
                else:
                    touched, rows = self._period_groups(name, before, after, changed)
                # The groups are needed twice, the rows once.
                many = name == "stance_by_document" or name in MEMBERS
                written[name] = self._table(name, rows).replace_groups(materialize(touched.distinct()), rows, many)
        return written

    def _period_groups(self, name: str, before: Star, after: Star, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Groups that a mention of a changed document is in, was in, and what they have now."""
        group = GROUPS[name]

        def keyed(star: Star) -> DataFrame:
            dated = star.mentions.drop(*DATE_COLUMNS).join(
                star.dates.select("date_key", "period_label", *DATE_COLUMNS), "date_key", "left"
            )
            return dated.withColumn("key", key_hash(*group))

        touched = materialize(
            reduce(
                DataFrame.unionByName,
                [keyed(star).join(changed, "document_id", "left_semi").select("key") for star in (before, after)],
            ).distinct()
        )
        # Mentions keep their own columns; the dates only say in which group they are.
        dates = after.dates.select("date_key", "period_label", *DATE_COLUMNS)

        def within(mentions: DataFrame) -> DataFrame:
            periods = dates.select("date_key", F.struct("period_label", *DATE_COLUMNS).alias("_date"))
            columns = [F.col(f"_date.{c}") if c in (*PERIOD, *DATE_COLUMNS) else F.col(c) for c in group]
            key = F.xxhash64(*[c.isNull() for c in columns], *columns)
            found = mentions.join(periods, "date_key", "left").withColumn("key", key)
            return found.join(touched, "key", "left_semi").select(*mentions.columns)

        return touched, _from_mentions(name, _restricted(after, within))

    def _member_groups(self, name: str, before: Star, after: Star, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
        bridge, members, member_id, member_name, source = MEMBERS[name]
        group = GROUPS[name]

        def keys(star: Star, rows: DataFrame) -> DataFrame:
            expanded = join_bridge_expand(rows, getattr(star, bridge), [member_id, source], placed=self.colocated)
            return expanded.withColumn("key", key_hash(*group))

        narrow = ["document_id", *PERIOD, "figure_id"]
        # What the table by document had for the changed documents follows from the star before.
        of_changed = [
            keys(star, _from_mentions("stance_by_document", _restricted(
                star, lambda m: m.join(changed, "document_id", "left_semi"))).select(*narrow)).select("key")
            for star in (before, after)
        ]
        by_document = self._by_document(after)
        # A member that is called otherwise now touches all of its groups.
        old = getattr(before, members).select(member_id, F.col(member_name).alias("_old"))
        renamed = (
            getattr(after, members).select(member_id, F.col(member_name).alias("_new")).join(old, member_id, "full")
            .where(~F.col("_new").eqNullSafe(F.col("_old"))).select(member_id)
        )
        expanded = keys(after, by_document.select(*narrow))
        of_renamed = expanded.join(renamed, member_id, "left_semi").select("key")
        touched = materialize(reduce(DataFrame.unionByName, [*of_changed, of_renamed]).distinct())
        asked = materialize(expanded.join(touched, "key", "left_semi").select("document_id").distinct())
        # Documents of a touched group are in others as well, which are incomplete here; they are left out in the end.
        return touched, _by_member(name, by_document.join(asked, "document_id", "left_semi"), after, self.colocated)


def _restricted(star: Star, mentions: Callable[[DataFrame], DataFrame]) -> Star:
    others = {f.name: getattr(star, f.name) for f in fields(star)}
    return Star(**others | {"mentions": mentions(star.mentions)})
