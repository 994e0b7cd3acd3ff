import random
import weakref
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from plain import ODD_TEXTS
from pyspark.sql import functions as F

from rostra.llm import bpe, common
from rostra.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
KNOWN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_texts():
    pick = random.Random(5)
    letters = "".join(pick.choice("abcdefghij") for _ in range(700))
    signs = "".join(chr(pick.choice([pick.randrange(9, 0x2FF), pick.randrange(0x10000, 0x1F900)])) for _ in range(900))
    return [*ODD_TEXTS, "  two  gaps \n", "it's I'LL 'd", "a\x1cb\x85c　d", "aaaa" * 400, "=" * 1500, letters, signs]


def test_the_vocabulary_is_regular():
    assert bpe.is_regular(RANKS)
    assert not bpe.is_regular({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


@pytest.mark.parametrize("regular, rounds", [(True, 24), (False, 24), (True, 3)])
def test_ids_are_those_of_the_library(regular, rounds):
    codec = bpe.ByteBpe(RANKS, PATTERN, regular, rounds=rounds)
    texts = [t for t in odd_texts() if regular or len(t or "") < 1000]
    found = codec.encode(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == KNOWN.encode_ordinary(text or ""), text
    assert codec.decode(found) == [(t or "").encode() for t in texts]


def test_what_is_remembered_does_not_matter():
    codec = bpe.ByteBpe(RANKS, PATTERN, True, remembered=5)
    for text in ("one two three four", "two four six eight ten", "one ten", "two two"):
        ids = codec.encode([text])
        assert ids[0].tolist() == KNOWN.encode_ordinary(text) and codec.decode(ids) == [text.encode()]


def test_rows_keep_their_columns(spark):
    texts = odd_texts()
    rows = [(i, t, "mine", "x") for i, t in enumerate([*texts, texts[4]])]
    frame = spark.createDataFrame(rows, "id int, text string, ids string, `odd name` string")
    there = bpe.round_trip(frame, PATH, PATTERN).collect()
    assert len(there) == len(rows)
    for row in there:
        text = rows[row.id][1] or ""
        assert row.ids == KNOWN.encode_ordinary(text) and row.n_tokens == len(row.ids)
        assert bytes(row.decoded) == text.encode() and row["odd name"] == "x"
    encoded = bpe.encode(frame, PATH, PATTERN)
    decoded = bpe.decode(encoded.withColumn("ids", F.when(F.col("id") > 0, F.col("ids"))), PATH, PATTERN)
    for row in decoded.collect():
        assert bytes(row.decoded) == ((rows[row.id][1] or "").encode() if row.id else b"")
    assert bpe.round_trip(frame.limit(0), PATH, PATTERN).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op1_bpe"](spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = KNOWN.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_blocks_cover_all_rows():
    from rostra.llm.common import blocks

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 20, "", "c"], "n": [0, 1, 2, 3, 4]})
    parts = list(blocks([batch], "text", 6))
    assert [n for p in parts for n in p.column("n").to_pylist()] == [0, 1, 2, 3, 4]
    assert len(parts) == 3


def test_a_worker_gives_back_what_another_operator_does_not_use():
    made = []

    def codec():
        made.append(weakref.ref(bpe.ByteBpe(RANKS, PATTERN, True)))
        return made[-1]()

    batch = pa.RecordBatch.from_pydict({"text": ["abc", None]})
    common.kept("own", lambda: bpe.ByteBpe(RANKS, PATTERN, True))
    mine = weakref.ref(common.kept("own", codec))
    assert not made
    assert sum(b.num_rows for b in common.blocks([batch], "text", keeps="own")) == 2
    assert mine() is not None and common.kept("own", codec) is mine()
    assert sum(b.num_rows for b in common.blocks([batch], "text")) == 2
    assert mine() is None
