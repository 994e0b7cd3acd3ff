"""URL filters: rules first, then naive Bayes over segmented host and path tokens.

Host names run words together. A unigram model of words, learned from a text corpus, cuts
every host label by Viterbi; a multinomial naive Bayes classifier, learned from the urls
that a rule decides, scores the words and the tokens of the path of all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import packed
from rostra.sources.tables import materialize

ALLOW, BLOCK = "allow", "block"
# The rules of the production filter as verdict, host, path.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
# Letters in a row, as host labels and words of a text have them.
_LETTERS = "[\\p{L}]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """Host with A-Z in lower case; empty for a null and without ``://``."""
    found = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(found, _CAPITALS, _CAPITALS.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _longest_fit(rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct of rule and verdict of the longest rule that fits ``host`` and ``path``, or null."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [
        F.when(
            ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start),
            F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in longest
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of a corpus: runs of letters in lower case."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({_LETTERS})"), 1)
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segment(label: str, scores: dict[str, float], longest: int, unknown: float | None = None) -> list[str]:
    """Words of the best cut of a label: the largest sum of scores, then the fewest words.

    A letter that no word covers counts as a word of score ``unknown``: a tenth of the
    least probability.
    """
    if unknown is None:
        unknown = min(scores.values(), default=0.0) - math.log(10)
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            score = scores.get(label[start:end], unknown if start == end - 1 else None)
            if score is not None:
                options.append((best[start][0] + score, best[start][1] - 1, start))
        best.append(max(options))
    words, end = [], len(label)
    while end:
        start = best[end][2]
        words.append(label[start:end])
        end = start
    return words[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct ``label`` with ``words``, its best cut under the log shares of all word counts.

    Only those parts of a label that are words reach its row, by a join of all distinct
    parts with the counts; no word is left out for being rare. A part is no longer than
    the longest word.
    """
    whole = counts.agg(F.sum("n").alias("total"), F.min("n").alias("least"), F.max(F.length("word")).alias("longest")).first()
    total, least, longest = whole["total"] or 1, whole["least"] or 1, whole["longest"] or 1
    unknown = math.log(least / total) - math.log(10) if whole["total"] else -math.log(10)
    starts = F.sequence(F.lit(1), F.length("label"))
    spans = F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.length("label") - i + 1)), lambda n: F.substring(F.col("label"), i, n)
    )))
    parts = labels.select("label", F.explode(F.array_distinct(spans)).alias("word"))
    known = parts.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for label, pairs in zip(batch.column("label").to_pylist(), batch.column("known").to_pylist()):
                scores = {p["word"]: math.log(p["n"] / total) for p in pairs or []}
                words.append(segment(label, scores, max(map(len, scores), default=1), unknown))
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "words": pa.array(words, pa.list_(pa.string()))})

    return labels.join(known, "label", "left").select("label", "known").mapInArrow(cut, "label string, words array<string>")


def _parts(text: Column) -> Column:
    """Runs of letters and runs of digits, in order."""
    return F.regexp_extract_all(text, F.lit("([\\p{L}]+|[\\p{Nd}]+)"), 1)


def _numbers(part: Column) -> Column:
    return F.concat(F.lit("#"), F.length(part).cast("string"))


def with_tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Urls (``row``, ``host``, ``path``) as ``row`` and ``token``, one row for each token.

    Tokens are words of the host's labels (``h:``) and parts of the path (``p:``). Digits are
    told by their number alone. Hosts are cut once, whatever the number of their urls.
    """
    is_number = F.col("label").rlike("^[\\p{Nd}]")
    hosts = materialize(urls.select("host").distinct().select("host", F.explode(_parts(F.col("host"))).alias("label")))
    letters = hosts.where(~is_number).select("label").distinct()
    words = segmented(letters, counts).select("label", F.explode("words").alias("word"))
    of_hosts = hosts.where(~is_number).join(words, "label").select("host", "word").unionByName(
        hosts.where(is_number).select("host", _numbers(F.col("label")).alias("word"))
    )
    # A host may hold most of the urls: its tokens meet them here, and Spark can split it.
    of_urls = urls.select("row", "host").join(of_hosts, "host").select("row", F.concat(F.lit("h:"), "word").alias("token"))
    paths = urls.select("row", F.explode(_parts(F.lower("path"))).alias("label"))
    part = F.when(is_number, _numbers(F.col("label"))).otherwise(F.col("label"))
    return of_urls.unionByName(paths.select("row", F.concat(F.lit("p:"), part).alias("token")))


def token_odds(labelled: DataFrame) -> tuple[DataFrame, float]:
    """``token`` and its log ``odds`` of block against allow, and the odds of any other token.

    Multinomial naive Bayes from ``token`` and ``verdict``, one row for each token of a
    url, with one added to each count; one more token stands for all that were not seen.
    """
    blocks = (F.col("verdict") == BLOCK).cast("long")
    counts = materialize(labelled.groupBy("token").agg(F.sum(blocks).alias("blocked"), F.count(F.lit(1)).alias("n")))
    totals = counts.agg(F.sum("blocked").alias("b"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("size")).first()
    blocked, n, size = totals["b"] or 0, totals["n"] or 0, totals["size"] + 1
    base = math.log(n - blocked + size) - math.log(blocked + size)
    odds = F.log(F.col("blocked") + 1) - F.log(F.col("n") - F.col("blocked") + 1) + F.lit(base)
    return counts.select("token", odds.alias("odds")), base


def judge(
    pages: DataFrame,
    texts: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    url: str = "url",
    text: str = "text",
) -> DataFrame:
    """The rows with ``host``, ``path``, ``rule``, ``verdict``, ``n_tokens`` and ``log_odds``.

    A rule holds for its host and all subdomains where the path starts with its path; of
    several, the longest decides. Rows without a rule are blocked if their log odds are
    above 0. Null urls and those without ``://`` have an empty host and path and are
    judged by the prior. Words are learned from ``texts``, the classifier from the rows
    that have a rule. Columns of those names are replaced.
    """
    new = ["host", "path", "rule", "verdict", "n_tokens", "log_odds"]
    pages = pages.drop(*new)
    parsed = pages.select(
        packed(pages).alias("page"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(parsed.withColumn("fit", _longest_fit(rules)))
    verdicts = rows.select("row", F.col("fit.verdict").alias("verdict")).where("verdict IS NOT NULL")
    sizes = {r["verdict"]: r["count"] for r in verdicts.groupBy("verdict").count().collect()}
    prior = math.log((sizes.get(BLOCK, 0) + 1) / (sizes.get(ALLOW, 0) + 1))
    tokens = materialize(with_tokens(rows, materialize(word_counts(texts, text))))
    odds, other = token_odds(tokens.join(verdicts, "row"))
    # A url that repeats a token has it once here, with its number.
    each = tokens.groupBy("row", "token").agg(F.count(F.lit(1)).alias("n"))
    summed = (
        each.join(odds, "token", "left").groupBy("row")
        .agg(F.sum("n").alias("n_tokens"), F.sum(F.col("n") * F.coalesce("odds", F.lit(other))).alias("sum"))
    )
    log_odds = F.lit(prior) + F.coalesce("sum", F.lit(0.0))
    told = F.when(log_odds > 0, BLOCK).otherwise(ALLOW)
    return rows.join(summed, "row", "left").select(
        "page.*", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", told).alias("verdict"),
        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), log_odds.alias("log_odds"),
    )
