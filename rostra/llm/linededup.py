"""Line dedup by a tree of line templates.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading
tokens. Tokens with a digit are fields from the start. In a leaf, a line joins the
template of another if most of its tokens are the same at the same places; where the
lines of a template differ, it has a field of variable content. Lines whose template
occurs in two or more documents are dropped, except in the first of them.

No leaf is ever gathered. Lines that are similar enough to share a template agree in one
of a few segments, so a line is compared with lines of the leaf that have the same
segment: with one of them, then with more, until all of them are linked or each has been
compared with all others. Templates are the components of what was similar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.common import let
from rostra.llm.common import SPACES, packed
from rostra.llm.components import linked_in_buckets
from rostra.sources.tables import materialize

# Leading tokens that choose a branch below the token count.
DEPTH = 4
# Lines with fewer tokens recur by chance and are left alone.
LEAST_TOKENS = 4
# Part of the tokens in which lines of one template agree.
SIMILARITY = 0.8
FIELD = "<*>"


def _normal(line: Column) -> Column:
    """Tokens of a line joined by one space, those with a digit as fields."""
    word = f"[^{SPACES}]*"
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, f"{word}[0-9]{word}", FIELD)).otherwise(line)

    def spaced(text):
        odd = (
            F.contains(text, F.lit("  "))
            | F.startswith(text, F.lit(" "))
            | F.endswith(text, F.lit(" "))
            | text.rlike("[\\x09-\\x0D]")
        )
        return F.when(odd, F.trim(F.regexp_replace(text, f"[{SPACES}]+", " "))).otherwise(text)

    return let(masked, spaced)


def _lines(docs: DataFrame, least_tokens: int, depth: int) -> DataFrame:
    """id, content, at, leaf and a hash of the tokens, for lines that are long enough.

    Lines are told apart by both hashes, 128 bits together. Everything is worked out in
    the array of lines, once per line, so that only numbers are exploded.
    """

    def hashed(normal):
        gaps = F.octet_length(normal) - F.octet_length(F.replace(normal, F.lit(" "), F.lit("")))
        return let(
            F.when(normal == "", 0).otherwise(gaps + 1),
            lambda n: F.struct(
                n.alias("n"),
                F.xxhash64(n, F.substring_index(normal, " ", depth)).alias("leaf"),
                F.xxhash64(normal).alias("same"),
            ),
        )

    lines = F.transform(F.split("text", "\n"), lambda line: let(_normal(line), hashed))
    return (
        docs.select("id", "content", F.posexplode(lines).alias("at", "line"))
        .where(F.col("line.n") >= least_tokens)
        .select("id", "content", "at", "line.leaf", "line.same")
    )


def _similar(lines: DataFrame, depth: int, similarity: float) -> DataFrame:
    """``node`` and ``component`` of lines (``node``, ``leaf``, ``tokens``) that share a template."""
    size = F.size("tokens")
    # So many tokens may differ; with one segment more than that, one has no difference.
    allowed = F.floor(F.lit(1 - similarity) * size + 1e-9).cast("int")
    tail = F.greatest(size - depth, F.lit(0))

    def start(i: Column) -> Column:
        return F.floor(i * F.col("tail") / (F.col("allowed") + 1)).cast("int")

    segment = F.transform(
        F.sequence(F.lit(0), F.col("allowed")),
        lambda i: F.xxhash64("leaf", i, F.slice(F.col("tokens"), start(i) + depth + 1, start(i + 1) - start(i))),
    )
    segments = (
        lines.withColumns({"allowed": allowed, "tail": tail})
        .where("tail > 0")
        .select("node", size.alias("size"), F.explode(segment).alias("bucket"))
    )
    shared = segments.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = materialize(segments.join(shared.select("bucket"), "bucket", "left_semi").distinct())

    def linked(pairs: DataFrame) -> DataFrame:
        of_a = lines.select(F.col("node").alias("a"), F.col("leaf").alias("a_leaf"), F.col("tokens").alias("a_tokens"))
        of_b = lines.select(F.col("node").alias("b"), F.col("leaf").alias("b_leaf"), F.col("tokens").alias("b_tokens"))
        differing = F.size(F.filter(F.zip_with("a_tokens", "b_tokens", lambda x, y: x != y), lambda d: d))
        return (
            pairs.join(of_a, "a")
            .join(of_b, "b")
            .where("a_leaf = b_leaf")
            .where(differing <= F.floor(F.lit(1 - similarity) * F.size("a_tokens") + 1e-9))
            .select(*pairs.columns)
            .distinct()
        )

    return linked_in_buckets(members, linked)


def recurring_lines(
    docs: DataFrame,
    depth: int = DEPTH,
    least_tokens: int = LEAST_TOKENS,
    similarity: float = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """Lines to drop and the templates they have.

    ``docs`` has ``id`` (not null), ``content`` (a hash of the text) and ``text``. The first
    table has ``id``, ``content`` and ``at``, the number of a line from 0; the second ``template``, ``first``
    (the id that keeps it) and ``n``, the number of lines with it.
    """
    narrow = materialize(_lines(docs, least_tokens, depth))
    # Equal lines once, with one place where their text can be found; they meet before the
    # lines of a leaf do, as one line may be that of most documents.
    equal = materialize(
        narrow.groupBy("leaf", "same").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("id").alias("first"),
            F.max("id").alias("last"),
            F.min(F.struct("id", "content", "at")).alias("place"),
        )
    )
    leaves = equal.groupBy("leaf").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    distinct = equal.join(leaves.where("first < last").select("leaf"), "leaf", "left_semi")
    lines = F.collect_list(F.struct("place.at", "leaf", "same", "n", "first", "last"))
    places = distinct.groupBy("place.id", "place.content").agg(lines.alias("lines"))
    # The texts of those places: only documents that have one are cut again, and the cut
    # is a column of the join, so that it is made once.
    cut = docs.select("id", "content", F.split("text", "\n").alias("cut"))
    lines = F.transform("lines", lambda p: F.struct(p.alias("of"), F.get("cut", p["at"]).alias("line")))
    distinct = materialize(
        cut.join(places, ["id", "content"])
        .select(F.explode(lines).alias("line"))
        .select("line.of.*", F.split(_normal(F.col("line.line")), " ").alias("tokens"))
        .withColumn("node", F.xxhash64("leaf", "same"))
        .drop("at")
    )
    groups = _similar(distinct, depth, similarity)
    grouped = materialize(
        distinct.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
    )
    # A document that is given twice gives its lines twice here.
    recurring = (
        grouped.select("group", "node", "n", "first", "last").distinct()
        .groupBy("group")
        .agg(F.min("first").alias("group_first"), F.max("last").alias("group_last"), F.sum("n").alias("lines"))
        .where("group_first < group_last")
    )
    decided = materialize(grouped.join(recurring, "group"))
    drops = (
        narrow.join(decided.select("leaf", "same", "group_first").distinct(), ["leaf", "same"])
        .where(F.col("id") > F.col("group_first"))
        .select("id", "content", "at")
    )
    fields = (
        decided.select("group", "group_first", "lines", F.posexplode("tokens").alias("at", "token"))
        .groupBy("group", "group_first", "lines", "at")
        .agg(F.when(F.min("token") == F.max("token"), F.min("token")).otherwise(F.lit(FIELD)).alias("token"))
        .groupBy("group", "group_first", "lines")
        .agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("parts"))
    )
    templates = fields.select(
        F.array_join(F.transform("parts", lambda p: p["token"]), " ").alias("template"),
        F.col("group_first").alias("first"),
        F.col("lines").alias("n"),
    )
    return drops, templates


def drop_recurring_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    least_tokens: int = LEAST_TOKENS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The documents without the lines whose template an earlier document has.

    "Earlier" is the smaller id; rows of one id count as one document. Rows without an id
    are passed on as they are and do not count. A null text stays null, and a document
    that loses all lines has an empty text. Adds ``n_lines`` and ``n_dropped`` (0 for a
    null text); all other columns are passed on, and columns of those two names are
    replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    content = F.xxhash64(F.col(text))
    drops, _ = recurring_lines(
        docs.select(F.col(doc_id).alias("id"), content.alias("content"), F.col(text).alias("text")).where(
            F.col("id").isNotNull()
        ),
        depth,
        least_tokens,
        similarity,
    )
    gone = drops.groupBy("id", "content").agg(F.collect_set("at").alias("gone"))
    # The lines are cut below the join, so that they are a column and not cut once per line.
    cut = docs.select(
        F.col(doc_id).alias("id"),
        content.alias("content"),
        F.split(F.col(text), "\n").alias("cut"),
        packed(docs.drop(text)).alias("row"),
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get("cut", i)), "\n")
    lost = F.col("gone").isNotNull() & F.col("cut").isNotNull()
    whole = F.when(lost, rest).otherwise(F.array_join("cut", "\n"))
    return cut.join(gone, ["id", "content"], "left").select(
        *[(whole if name == text else F.col(f"row.`{name}`")).alias(name) for name in docs.columns],
        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(lost, F.size("gone")).otherwise(0).cast("long").alias("n_dropped"),
    )
