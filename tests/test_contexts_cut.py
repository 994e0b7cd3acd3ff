"""Contexts are cut once, by tasks that walk through a text once."""

import pyarrow as pa
from pyspark.sql import functions as F

from rostra.operators import contexts
from rostra.operators.contexts import context_windows, mention_contexts
from rostra.operators.phrases import Phrases


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_joined_contexts_are_cut_once_and_not_by_interpreted_lambdas(spark):
    mentions = spark.createDataFrame([("m", "a", 0, 2)], "mention_id string, document_id string, match_start_char int, match_end_char int")
    texts = spark.createDataFrame([("a", "un deux", "p")], "document_id string, clean_text string, file_path string")
    cut = mention_contexts(mentions, texts, 1, 1)
    plan = _plan(cut)
    assert plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan
    assert [tuple(r) for r in cut.collect()] == [("m", "a", 1, 1, 0, 1, 2, 0, 7, "un deux", "p")]


def test_windows_of_many_texts(spark):
    """Nulls, spans in gaps and all kinds of white space keep their place."""
    rows = [
        (0, "a\x1cb c\x85dé \U0001f600 f", [(2, 3), (6, 8)]),
        (1, None, [(0, 1)]),
        (2, "x  y", [(1, 2), (None, 1), (0, None)]),
        (3, "x", []),
        (4, "x", None),
        (5, "fin", [(0, 3)]),
    ]
    got = (
        spark.createDataFrame(rows, "n int, t string, s array<struct<start:int,end:int>>").coalesce(1)
        .select("n", context_windows(F.col("t"), F.col("s"), 1, 1).alias("w")).collect()
    )
    empty = (0, 0, 0, 0, 0, "")
    want = {
        0: [(1, 1, 3, 0, 5, "a\x1cb c"), (1, 1, 3, 4, 10, "c\x85dé \U0001f600")],
        1: [empty],
        2: [empty, (0, 1, 2, 0, 4, "x  y"), empty],
        3: [],
        4: None,
        5: [(0, 0, 1, 0, 3, "fin")],
    }
    assert {r.n: r.w if r.w is None else [tuple(w) for w in r.w] for r in got} == want


def test_windows_are_handed_over_in_pieces(monkeypatch):
    monkeypatch.setattr(contexts, "_HELD", 1)
    spans = pa.array([[{"start": 0, "end": 1}], None, [], [{"start": 2, "end": 3}, {"start": 0, "end": 1}]])
    pieces = list(contexts._cut(pa.array(["a b", "c", "d", "e f"]), spans, 0, 0))
    assert [len(piece) for piece in pieces] == [1, 3]
    got = [w and [x["context_window"] for x in w] for piece in pieces for w in piece.to_pylist()]
    assert got == [["a"], None, [], ["f", "e"]]


def test_only_words_that_begin_a_phrase_are_walked_from():
    class Known(dict):
        def get(self, word, otherwise=None):
            assert word in self
            return super().get(word, otherwise)

    phrases = Phrases(["of the", "of"])
    phrases.first = Known(phrases.first)
    assert phrases.find("one of the many, of it") == [(4, 6, 1), (4, 10, 0), (17, 19, 1)]
