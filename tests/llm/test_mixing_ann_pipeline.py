"""Mixing, nearest neighbours and the pipeline."""

import math
import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from plain import near_duplicates, words
from pyspark.sql import functions as F

from rostra.llm import ann, linededup, mixing, simhash
from rostra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = share * sum(sizes.values())
    while rest > 1e-9 and free:
        total = sum(weight[s] for s in free)
        stopped = {s for s in free if target[s] + rest * weight[s] / total >= most * sizes[s]}
        if not stopped:
            for s in free:
                target[s] += rest * weight[s] / total
            break
        for s in stopped:
            rest -= most * sizes[s] - target[s]
            target[s] = most * sizes[s]
        free -= stopped
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_like_refilling(spark, seed):
    pick = random.Random(seed)
    names = [None, "", "é", "z", "Z", *[f"s{i}" for i in range(pick.randrange(0, 12))]]
    sizes = {n: pick.choice([0, 1, 10, 1000, 50_000]) * pick.randrange(1, 9) for n in names}
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = plain_targets(sizes)
    for r in found.collect():
        assert r.target == pytest.approx(want[r.source], abs=1e-6)


def test_mix(spark):
    pick = random.Random(1)
    docs = [(i, " ".join(["w"] * pick.randrange(1, 80)), "hot" if i % 3 else pick.choice(["a", "b", "c", None])) for i in range(900)]
    docs += [(2000, None, "a"), (2001, " \n", "empty"), (None, "x y", "a"), (None, "x y z", "b"), docs[5], docs[5]]
    rows = [(*d, "mine") for d in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    found = mixing.mix(frame).collect()
    assert len(found) == len(docs)
    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        assert r.size == len(words(r.text)) and r.taken == r.copies * r.size <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], 3 * r.size)
    want = plain_targets(size)
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    out = mixing.repeated(mixing.mix(frame.drop("target")))
    assert out.count() == sum(r.copies for r in found) and out.columns == ["doc_id", "text", "source"]
    assert mixing.mix(frame.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(frame.where("source = 'empty'")).collect()] == [0]


def test_the_mix_is_native(spark):
    rows = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixing.mix(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def neighbours(vectors, queries, k=5):
    out = {}
    for q in queries:
        a = np.array(vectors[q])
        scored = [(-float(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))), i)
                  for i, b in ((i, np.array(v)) for i, v in vectors.items()) if i != q]
        out[q] = sorted(scored)[:k]
    return out


def test_neighbours_of_odd_vectors(spark):
    vectors = {i: [float(i % 3), 1.0, float(i)] for i in range(20)}
    vectors |= {100: vectors[0], 101: vectors[0], 102: [1e200, 1e200, 0.0], 103: [1e-200, 0.0, 0.0]}
    odd = [(50, None), (51, [0.0, 0.0, 0.0]), (52, [1.0, None, 2.0]), (53, [math.nan, 1.0, 1.0]),
           (54, [math.inf, 1.0, 1.0]), (55, []), (56, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    rows = [(i, v, "mine") for i, v in [*vectors.items(), *odd]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = ann.search(frame, F.pmod(F.col("vec_id"), F.lit(50)) == 0, coverage=1.0).collect()
    want = neighbours({i: v for i, v in vectors.items() if i != 102}, [0, 100])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found}
    assert set(q for q, _ in got) == {0, 100}
    assert got[0, 1][0] == 100 and got[0, 2][0] == 101 and got[0, 1][1] == got[0, 2][1]
    for q in (0, 100):
        expected = [(-s, i) for s, i in want[q]]
        assert [i for i, _ in (got[q, r] for r in range(1, 6))][:2] == [i for _, i in expected][:2]
    few = ann.search(frame.where("vec_id in (0, 7, 51)"), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 7)]
    assert ann.search(frame.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert ann.search(frame.limit(0), F.lit(True)).count() == 0
    assert ann.search(frame.where("vec_id in (50, 51)"), F.lit(True)).count() == 0


def test_recall(spark, monkeypatch):
    """Bounded parts of vectors and queries, against brute force."""
    monkeypatch.setattr(ann, "_VECTORS", 60)
    monkeypatch.setattr(ann, "_QUERIES", 7)
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in rows}
    asked = [i for i in vectors if i % 50 == 0]
    want, hits = neighbours(vectors, asked), 0
    found = defaultdict(list)
    for r in QUERIES["op4_neighbours"](spark, folder).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q in asked:
        own = sorted(found[q])
        assert [rank for rank, *_ in own] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for _, i in want[q]})
        for _, i, s in own:
            a, b = np.array(vectors[q]), np.array(vectors[i])
            assert s == pytest.approx(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)), abs=1e-14)
    assert hits >= 0.9 * 5 * len(asked)


def test_repeated_rows_of_the_neighbours(spark):
    """Copies of a query ask once, copies of a candidate count once."""
    pick = np.random.default_rng(8)
    vectors = {i: pick.standard_normal(6).tolist() for i in range(120)}
    rows = list(vectors.items()) + [(50, vectors[50])] * 4 + [(i, vectors[i]) for i in range(40)] * 3
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                       F.pmod(F.col("vec_id"), F.lit(50)) == 0, coverage=1.0).collect()
    want = neighbours(vectors, [0, 50, 100])
    assert {(r.query_id, r["rank"]): r.vec_id for r in found} == {(q, k + 1): i for q in want for k, (_, i) in enumerate(want[q])}
    assert len(found) == 15


NAMES = ["id", "_id", "content", "_content", "cut", "_cut", "gone", "row", "kept", "_kept", "of", "_of", "own", "place", "below",
         "_below", "whole", "_whole", "bucket", "node", "group", "lines", "leaf", "same"]


def test_columns_of_the_caller_do_not_clash(spark):
    """Operators that pass rows on keep columns that are called like their own."""
    texts = ["one two three four five six", "one two three four five six", "another line of some length here\nshort", None, ""]
    rows = spark.createDataFrame([(i, t, "s", 10 + i) for i, t in enumerate(texts)], "doc_id long, text string, source string, n long")
    wide = rows.select("doc_id", "text", "source", *[F.col("n").alias(name) for name in NAMES])
    for operator in (linededup.drop_recurring_lines, simhash.keep_one, mixing.mix, lambda d: mixing.repeated(mixing.mix(d))):
        plain = {r.doc_id: r.text for r in operator(rows.drop("n")).collect()}
        found = operator(wide)
        assert found.columns[: len(wide.columns)] == wide.columns
        got = found.collect()
        assert {r.doc_id: r.text for r in got} == plain
        assert all(r[name] == 10 + r.doc_id for r in got for name in NAMES)


# ---- pipeline ----


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    junk = docs.limit(1).select((F.lit(10**6) + F.col("doc_id")).alias("doc_id"), F.lit("12345 !!").alias("text"),
                                "lang", F.lit(None).cast("string").alias("source"), "n_chars")
    nothing = junk.withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(2 * 10**6).cast("long"))
    given = docs.unionByName(junk).unionByName(nothing)
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "mix_sources", "encode"]
    told = stages["language_id"](spark, given, FOLDER)
    kept = {r.doc_id for r in told.collect()}
    assert told.columns == columns and 10**6 not in kept and 2 * 10**6 not in kept
    assert len(kept) >= 0.99 * docs.count()
    fewer = stages["line_dedup"](spark, told, FOLDER)
    texts = [(r.doc_id, r.text) for r in fewer.collect()]
    assert fewer.columns == columns and {i for i, _ in texts} == kept
    assert all(r.n_chars == len(r.text) for r in fewer.collect())
    one = stages["near_dedup"](spark, fewer, FOLDER)
    _, group = near_duplicates(texts)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == set(group.values())
    mixed = stages["mix_sources"](spark, one, FOLDER)
    copies = {r.doc_id: r.copies for r in mixing.mix(one).collect()}
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert mixed.columns == columns and got == {i: n for i, n in copies.items() if n}
    last = stages["encode"](spark, mixed, FOLDER).collect()
    assert len(last) == sum(copies.values()) and all(r.round_trip and len(r.ids) == r.n_tokens for r in last)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    one = sorted((r.doc_id, r.n_tokens) for r in docs.collect())
    assert one == sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, FOLDER).collect())
