"""Line dedup against all pairs of a leaf."""

import random

from plain import components, masked
from pyspark.sql import functions as F

from rostra.llm import linededup


def plain_kept(docs, depth=4, least=4, similarity=0.8):
    """Number of lines that each document loses, by comparing all lines of a leaf."""
    places = {}
    for i, text in docs:
        for line in text.split("\n"):
            if len(masked(line)) >= least:
                places.setdefault(masked(line), []).append(i)
    lines = list(places)
    links = [
        (a, b) for a in lines for b in lines
        if a < b and len(a) == len(b) and a[:depth] == b[:depth]
        and sum(x != y for x, y in zip(a, b)) <= (1 - similarity) * len(a) + 1e-9
    ]
    group = components(lines, links)
    ids = {}
    for line, found in places.items():
        ids.setdefault(group[line], []).extend(found)
    lost = {i: 0 for i, _ in docs}
    for found in ids.values():
        for i in found:
            lost[i] += i > min(found)
    return lost


def test_links_beside_the_most_frequent_line(spark):
    """Two lines alike whose shared segments are led by lines that are frequent and unlike both."""
    start, tail = "one two three four", "a b c d e f g h i j k".split()
    alike = [" ".join([start, *tail, end]) for end in ("left", "right")]
    # 16 tokens, so 3 may differ, in segments of three: each leader has one segment and no other.
    leaders = [
        " ".join([start, *[t if i // 3 == s else f"{t}{'xyzv'[s]}" for i, t in enumerate(tail)], "end"]) for s in range(4)
    ]
    docs = [(1, alike[0]), (2, alike[1])] + [(10 + k, leaders[k % 4]) for k in range(12)]
    lost = {r.doc_id: r.n_dropped for r in linededup.drop_recurring_lines(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert lost == plain_kept(docs) and lost[2] == 1


def test_all_pairs_of_a_leaf(spark):
    pick = random.Random(3)
    bases = [[pick.choice("abcdef") for _ in range(14)] for _ in range(25)]
    docs = []
    for i in range(150):
        line = list(pick.choice(bases))
        for _ in range(pick.randrange(3)):
            line[pick.randrange(14)] = pick.choice("abcdefuvw")
        docs.append((i, " ".join(["one", "two", "three", "four", *line])))
    found = linededup.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.n_dropped for r in found.collect()} == plain_kept(docs)
    assert found.where(F.col("n_dropped") > 0).count() > 50
