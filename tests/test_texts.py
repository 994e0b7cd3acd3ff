"""Metadata XML, cleaning, mentions and contexts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rostra.functions.metadata import parse_metadata_xml
from rostra.operators.contexts import context_window, mention_contexts
from rostra.operators.mentions import find_mentions
from rostra.plans.texts import clean_document_text

XML = (
    "<metadata><title> Discours  avec\n espaces </title><creator>A</creator><creator> B </creator>"
    "<creator>A</creator><subject>x</subject><subject>y</subject><date> 1793 </date>"
    "<language>fre</language><identifier>test1793</identifier>"
    "<identifier-access>http://e/test1793</identifier-access></metadata>"
)


def parse(spark, text):
    frame = spark.createDataFrame([(text,)], "x string")
    return frame.select(parse_metadata_xml("x").alias("p")).first().p


def test_metadata(spark):
    p = parse(spark, XML)
    assert (p.title, p.publication_date_raw, p.metadata_document_id) == (
        "Discours avec espaces", "1793", "test1793")
    assert (p.creator, p.author, p.creators) == ("A", "A", ["A", "B"])
    assert (p.subjects, p.subjects_raw) == (["x", "y"], "x; y")
    assert p.source_url == "http://e/test1793"
    assert (p.metadata_parse_status, p.metadata_parse_error) == ("success", None)


def test_metadata_author_only(spark):
    p = parse(spark, "<m><author>Anonymous Author</author><title/></m>")
    assert (p.creator, p.author, p.creators, p.metadata_authors, p.title) == (
        None, "Anonymous Author", [], ["Anonymous Author"], None)


@pytest.mark.parametrize("text, error", [("", "Empty XML document"), (None, "Empty XML document"),
                                         ("<m><title>x</m>", None), ("junk", None)])
def test_metadata_broken(spark, text, error):
    p = parse(spark, text)
    assert p.metadata_parse_status == "parse_error" and p.metadata_parse_error
    assert error in (None, p.metadata_parse_error)
    assert (p.title, p.creators, p.subjects) == (None, [], [])


def test_quality_flags(spark):
    words = " ".join(["mot"] * 100)
    rows = [("a", ""), ("b", None), ("c", " \n\t"), ("d", words), ("e", words[:-4]),
            ("f", words + " Ã‚"), ("g", "un deux  trois\x0b")]
    frame = spark.createDataFrame(rows, "document_id string, raw_text string")
    got = {r.document_id: r for r in clean_document_text(frame).collect()}
    flags = {k: r.ocr_quality_flag for k, r in got.items()}
    assert flags == {"a": "empty_text", "b": "empty_text", "c": "very_short_text", "d": "usable",
                     "e": "very_short_text", "f": "possible_encoding_artifacts",
                     "g": "very_short_text"}
    assert (got["d"].word_count, got["e"].word_count, got["c"].word_count) == (100, 99, 0)
    assert got["g"].clean_text == "un deux trois"


LEXICON = ["marat", "mar", "m. necker", "necker", "l'ami", "saint-just", "le roi", "roi", "x", "a\\e b"]
TEXTS = {
    "plain": "marat et m. necker, necker! (le roi) le roi de saint-just",
    "edges": "maré marat_ mar mar roi",
    "twins": "ſaint-juſt ſaint-just",
    "inside": "l'ami x-x x-xx x a\\e b",
    "long": " ".join(["x", "le roi", "rien"] * 700),
    "empty": "",
    "none": None,
}


def brute_force():
    found = set()
    for name, text in TEXTS.items():
        for i, variant in enumerate(LEXICON):
            pattern = r"(?<!\w)" + re.escape(variant).replace(r"\ ", r"\s+") + r"(?!\w)"
            for match in re.finditer(pattern, text or "", re.I):
                found.add((name, f"v{i}", match.start(), match.end()))
    return found


@pytest.fixture(scope="module")
def corpus(spark):
    texts = spark.createDataFrame(list(TEXTS.items()), "document_id string, clean_text string")
    variants = spark.createDataFrame(
        [(f"f{i % 2}", f"v{i}", v, v) for i, v in enumerate(LEXICON)],
        "figure_id string, variant_id string, variant string, variant_normalized string",
    )
    texts = texts.withColumns({"clean_text_lower": F.lower("clean_text"), "file_path": F.lit("p")})
    return texts, variants


@pytest.mark.parametrize("slice_bytes", [10**6, 1500])
def test_mentions_equal_brute_force(corpus, slice_bytes):
    texts, variants = corpus
    rows = find_mentions(texts, variants, slice_bytes=slice_bytes).collect()
    got = [(r.document_id, r.variant_id, r.match_start_char, r.match_end_char) for r in rows]
    assert len(got) == len(set(got))
    assert set(got) == brute_force()
    assert len({r.mention_id for r in rows}) == len(rows)


@pytest.mark.parametrize("size", [47, 50_000])
def test_a_lexicon_of_any_size_is_one_plan(spark, size):
    """Random texts and phrases of words, signs and letters beyond ASCII, against a regular expression each."""
    pick = random.Random(size)
    words = ["né", "l", "d", "o'n", "ab", "a", "b", "ÿz", "x1", "_", "&", "§§", "--", "1793", "中", "st."]
    seps = [" ", " ", " ", "-", "'", ", ", " & "]

    def phrase(n):
        return "".join(pick.choice(words) + (pick.choice(seps) if i < n - 1 else "") for i in range(n))

    texts = [phrase(pick.randrange(0, 60)) for _ in range(60)]
    lexicon = list(dict.fromkeys([w for w in words] + ["'a", "a'", "-b-", ", a", "a & b"] + [phrase(pick.randrange(1, 5)) for _ in range(40)]))
    used = lexicon[:47]
    # The rest of a large lexicon occurs in no text.
    lexicon = used + [f"zz{i} {phrase(2)}" for i in range(size - len(used))]
    frame = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "document_id string, clean_text_lower string")
    variants = spark.createDataFrame(
        [("f", f"v{i}", v, v) for i, v in enumerate(lexicon)],
        "figure_id string, variant_id string, variant string, variant_normalized string",
    )
    found = find_mentions(frame, variants)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    want = {
        (f"d{d}", f"v{i}", m.start(), m.end())
        for d, text in enumerate(texts) for i, v in enumerate(used)
        for m in re.finditer(r"(?<!\w)" + re.escape(v) + r"(?!\w)", text)
    }
    got = [(r.document_id, r.variant_id, r.match_start_char, r.match_end_char) for r in found.collect()]
    assert len(want) > 500 and sorted(got) == sorted(want)


def test_both_context_forms_agree(corpus):
    texts, variants = corpus
    fused = find_mentions(texts, variants, contexts=(3, 2))
    columns = ["mention_id", "words_before_actual", "words_after_actual", "context_word_count",
               "context_start_char", "context_end_char", "context_window"]
    joined = mention_contexts(fused, texts, 3, 2)
    assert sorted(fused.select(*columns).collect()) == sorted(joined.select(*columns).collect())


def test_contexts_of_odd_words_and_gaps(spark):
    """Both forms and a plain loop over random words and gaps of any length."""
    pick = random.Random(3)
    rows, expected = [], {}
    for d in range(30):
        parts = []
        for _ in range(pick.randrange(1, 60)):
            parts += [pick.choice(["danton", "x" * pick.randrange(1, 90), "é" * pick.randrange(1, 5)]),
                      " " * pick.choice([1, 1, 1, 2, 150])]
        text = "".join(parts)
        rows.append((f"d{d}", text, f"f{d}"))
        words = [m.span() for m in re.finditer(r"\S+", text)]
        for i, (a, b) in enumerate(words):
            if text[a:b] == "danton":
                left, right = max(0, i - 3), min(len(words) - 1, i + 2)
                expected[f"d{d}:{a}"] = (text[words[left][0]:words[right][1]], i - left, right - i)
    texts = spark.createDataFrame(rows, "document_id string, clean_text string, file_path string")
    mentions = spark.createDataFrame(
        [(key, key.split(":")[0], int(key.split(":")[1]), int(key.split(":")[1]) + 6) for key in expected],
        "mention_id string, document_id string, match_start_char int, match_end_char int")
    got = {r.mention_id: (r.context_window, r.words_before_actual, r.words_after_actual)
           for r in mention_contexts(mentions, texts, 3, 2).collect()}
    assert got == expected


CONTEXTS = [
    ("un deux trois robespierre quatre cinq six", 14, 25, 2, 2,
     ("deux trois robespierre quatre cinq", 2, 2, 5)),
    ("robespierre quatre cinq six", 0, 11, 3, 2, ("robespierre quatre cinq", 0, 2, 3)),
    ("un deux trois danton", 14, 20, 2, 3, ("deux trois danton", 2, 0, 3)),
    ("avant louis capet après", 6, 17, 1, 1, ("avant louis capet après", 1, 1, 4)),
    ("un deux trois", 100, 110, 2, 2, ("", 0, 0, 0)),
    (None, 0, 1, 2, 2, ("", 0, 0, 0)),
    ("un  deux  trois", 4, 8, 1, 1, ("un  deux  trois", 1, 1, 3)),
    ("un deux", 2, 3, 1, 1, ("", 0, 0, 0)),
    ("un deux", 2, 5, 0, 0, ("deux", 0, 0, 1)),
    ("a" * 3000 + " b c", 3001, 3002, 1, 1, ("a" * 3000 + " b c", 1, 1, 3)),
    ("alpha beta " + "x" * 46 + " danton", 58, 64, 2, 0, ("beta " + "x" * 46 + " danton", 2, 0, 3)),
    ("a b c " + "y" * 78 + " danton", 85, 91, 4, 0, ("a b c " + "y" * 78 + " danton", 4, 0, 5)),
    ("a b c" + " " * 200 + "danton", 205, 211, 3, 0, ("a b c" + " " * 200 + "danton", 3, 0, 4)),
    ("x" * 200 + "danton y", 200, 206, 1, 1, ("x" * 200 + "danton y", 0, 1, 2)),
]


@pytest.mark.parametrize("text, start, end, before, after, expected", CONTEXTS)
def test_context_window(spark, text, start, end, before, after, expected):
    frame = spark.createDataFrame([(text, start, end)], "t string, s int, e int")
    c = frame.select(
        context_window(F.col("t"), F.col("s"), F.col("e"), before, after).alias("c")
    ).first().c
    got = (c.context_window, c.words_before_actual, c.words_after_actual, c.context_word_count)
    assert got == expected
    if text and expected[0]:
        assert text[c.context_start_char:c.context_end_char] == expected[0]
