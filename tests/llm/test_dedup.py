"""Line dedup, near-dedup, components and exact dedup."""

import random
import re
import struct
from hashlib import sha256

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from plain import ODD_TEXTS, components, dropped_lines, fingerprint, near_duplicates

from rostra.llm import linededup, simhash
from rostra.llm.components import connected_components
from rostra.llm.exactdedup import DigestIndex
from rostra.llm.oracles import ORACLES
from rostra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def after(text, at_gone):
    return "\n".join(line for at, line in enumerate(text.split("\n")) if at not in at_gone)


def test_lines_like_the_definition(spark):
    docs = documents(spark)
    frame = spark.createDataFrame(docs, "doc_id long, text string")

    def key(tokens):
        """The node number that the operator gives to a line."""

        def number(seed, value):
            return xxhash.xxh64_intdigest(value, seed & 0xFFFFFFFFFFFFFFFF)

        def signed(x):
            return x - (1 << 64) if x >= 1 << 63 else x

        leaf = number(number(42, struct.pack("<i", len(tokens))), " ".join(tokens[:4]).encode())
        same = number(42, " ".join(tokens).encode())
        return signed(number(number(42, struct.pack("<Q", leaf)), struct.pack("<Q", same)))

    gone = dropped_lines(docs, key=key)
    found = {r.doc_id: r for r in linededup.drop_recurring_lines(frame).collect()}
    assert len(found) == len(docs) and gone
    for i, text in docs:
        own = {at for d, at in gone if d == i}
        assert found[i].n_dropped == len(own)
        assert found[i].text == (text if text is None else after(text, own))


def test_templates(spark):
    clean = "a line of its own that nobody else has in the whole table"
    notice = "Copyright {} by the authors of this {} and all rights are reserved here"
    docs = [
        (1, f"{notice.format(1999, 'book')}\n{clean} one"),
        (2, f"two {clean}\n{notice.format(2001, 'book')}"),
        (3, f"{notice.format(12, 'paper')}\nshort line"),
        (4, f"{clean.upper()} four\nshort line"),
        (5, notice.format(7, "letter")),
        (None, notice.format(8, "book")),
        (6, None),
        (7, ""),
    ]
    docs += [docs[1]]
    rows = [(i, t, "mine") for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    found = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.drop_recurring_lines(frame).collect()]
    expected = [
        (1, docs[0][1], 2, 0), (2, f"two {clean}", 2, 1), (2, f"two {clean}", 2, 1), (3, "short line", 2, 1),
        (4, docs[3][1], 2, 0), (5, "", 1, 1), (None, docs[5][1], 1, 0), (6, None, 0, 0), (7, "", 1, 0),
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    given = frame.where("doc_id is not null").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"), "text")
    _, templates = linededup.recurring_lines(given)
    got = [r.template for r in templates.collect()]
    assert got == ["Copyright <*> by the authors of this <*> and all rights are reserved here"]
    assert linededup.drop_recurring_lines(frame.limit(0)).count() == 0


def test_a_line_that_most_documents_have(spark):
    hot = "this very line is part of every single document there is"
    docs = [(i, f"{hot}\nbut this one {chr(97 + i % 26)}{i} is only in a few of them x{i // 2}") for i in range(300)]
    found = linededup.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(hot in r.text for r in found) == 1 and {r.doc_id for r in found} == set(range(300))


@pytest.mark.parametrize("text", [*ODD_TEXTS, "One two", "one TWO three four", "a b c d e", "a b c d a b c d a b c d"])
def test_fingerprints(text):
    assert simhash.fingerprint_of(text) == fingerprint(text)


def signed(bits):
    return bits - (1 << 64) if bits >> 63 else bits


@pytest.mark.parametrize("max_bits", [0, 1, 2, 4])
def test_the_trie_finds_every_link(spark, max_bits):
    pick = random.Random(max_bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        centre = pick.getrandbits(64)
        for _ in range(8):
            bits = centre
            for b in pick.sample(range(64), pick.randrange(0, 6)):
                bits ^= 1 << b
            prints.add(bits)
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "bits long")
    links = {frozenset((r.a, r.b)) for r in simhash.links_by_trie(frame, max_bits).collect()}
    expected = {
        frozenset((signed(a), signed(b)))
        for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= max_bits
    }
    assert links == expected


def test_components(spark):
    pick = random.Random(2)
    links = [(pick.randrange(200), pick.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    links += [(500, 500 + i) for i in range(200)] + [(7, 7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == components(nodes, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    docs = [(i + 1, t) for i, t in enumerate(ODD_TEXTS)]
    docs += [(100 + i, t) for i, (_, t) in enumerate(documents(spark))]
    docs += [(1000 + i, " ".join(f"w{j}" for j in range(400)) + f" end{i}") for i in range(60)]
    frame = spark.createDataFrame([(*d, "mine") for d in docs], "doc_id long, text string, bits string")
    prints, group = near_duplicates(docs)
    found = simhash.near_duplicates(frame).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in found} == group and len(found) == len(docs)
    repeated = frame.unionByName(frame.limit(30))
    kept = simhash.keep_one(repeated)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))
    assert kept.columns == frame.columns
    nameless = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (3, "")], "doc_id long, text string")
    assert sorted(r.doc_id is None for r in simhash.keep_one(nameless).collect()) == [False, True]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_near_duplicate_query(spark):
    prints, group = near_duplicates(documents(spark))
    found = QUERIES["op3_simhash"](spark, FOLDER).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{p:016x}", group[i]) for i, p in prints.items()
    }


def digest(text):
    return sha256(re.sub("[\x20\x09-\x0d]", "", text or "").encode()).hexdigest()


def test_batches_against_the_index(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    first = [(5, "a b"), (3, "ab"), (4, "a  b"), (None, "a  b"), (4, "a  b"), (7, None), (8, " "), (9, "é\n"), (None, "alone")]
    first += [(20 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows = spark.createDataFrame(first, "doc_id long, text string")

    def decided(rows):
        return [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in index.add(rows).collect()]

    got = decided(rows)
    assert len(got) == len(first)
    texts = {digest(t) for _, t in first}
    assert sum(kept for *_, kept, _ in got) == len(texts) == index.read().count()
    assert {(i, k) for i, k, *_, h in got if h == digest("ab")} == {(5, 4), (3, 4), (4, 4), (None, 4)}
    assert {(k, n) for _, k, n, _, h in got if h == digest("")} == {(23, 6)}
    assert sorted(got, key=repr) == sorted(decided(rows), key=repr) and index.read().count() == len(texts)
    more = spark.createDataFrame([(1, "a b"), (2, "new"), (6, "n e w")], "doc_id long, text string")
    assert {(i, k, kept) for i, k, _, kept, _ in decided(more)} == {(1, 4, False), (2, 6, False), (6, 6, True)}
    assert index.add(more.limit(0)).count() == 0
    again = DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    assert again.read().count() == len(texts) + 1


def test_the_index_is_neither_shuffled_nor_python(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    index.add(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    plan = index.read().join(index.read().limit(5).hint("merge"), "digest", "left_anti")
    assert "Bucketed: true" in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_like_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, FOLDER).toPandas()[list(want.columns)]
    order = "doc_id" if "doc_id" in want.columns else list(want.columns)
    want, got = (d.sort_values(order).reset_index(drop=True) for d in (want, got))
    for column in want.columns:
        if want[column].dtype == float:
            assert np.allclose(want[column], got[column], rtol=1e-12)
        else:
            assert want[column].tolist() == got[column].tolist(), column
