"""MinHash near-dedup against all pairs."""

import random

import numpy as np
from plain import ODD_TEXTS, components, lower, words

from rostra.llm import minhash
from rostra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingles(text, size=3):
    found = words(lower(text))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def plain(docs, similarity=85):
    sets = [(i, shingles(t)) for i, t in docs]
    near = [
        (i, j) for x, (i, a) in enumerate(sets) for j, b in sets[:x]
        if a and b and 100 * len(a & b) >= similarity * len(a | b)
    ]
    return sets, components([i for i, _ in sets], near)


def edited(pick, found, n):
    found = list(found)
    for _ in range(n):
        at = pick.randrange(len(found))
        found[at : at + pick.choice([0, 1, 1, 1])] = [f"new{pick.randrange(10**6)}"] * pick.choice([0, 1, 1])
    return found


def held(spark, docs):
    sets, component = plain(docs)
    frame = spark.createDataFrame([(i, t, 1, "mine") for i, t in docs], "doc_id long, text string, size int, node string")
    found = minhash.near_duplicates(frame)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = sorted((i, len(s), component[i], component[i] == i) for i, s in sets)
    assert sorted(tuple(r) for r in found.collect()) == want
    return component


def test_all_similar_pairs(spark):
    pick = random.Random(0)
    texts = [*ODD_TEXTS, "A b", "a B", "a", "A", "a b c", "a b c a b c"]
    passage = [f"p{j}" for j in range(60)]
    for size in (3, 8, 9, 12, 40, 120, 400):
        for _ in range(5):
            base = [f"w{pick.randrange(2000)}" for _ in range(size)]
            texts += [" ".join(edited(pick, base, n)) for n in (0, 0, 1, 1, 2, size // 60, size // 40)]
        texts += [" ".join(passage + edited(pick, base, size)) for _ in range(8)]
        texts += [" ".join(edited(pick, passage, 2)) for _ in range(4)]
    docs = [(len(texts) - i, t) for i, t in enumerate(texts)]
    component = held(spark, docs)
    assert len(set(component.values())) < len(docs) - 60


def test_chains_that_no_centre_covers(spark):
    """Neighbours in the chain are alike, its ends are not: one centre links a few only."""
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(60):
        docs.append((i, " ".join(base)))
        base[(i * 37) % 200] = f"x{i}"
        base[(i * 53 + 11) % 200] = f"y{i}"
    assert set(held(spark, docs).values()) == {0}


def test_near_copies_that_the_centre_does_not_reach(spark, monkeypatch):
    """Most texts of a group are too far from each other: few pairs are made, and no link is lost."""
    pick = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    far = [edited(pick, base, pick.randrange(4, 16)) for _ in range(300)]
    # Some are the centre's, and some are alike only among themselves.
    texts = [edited(pick, base, pick.randrange(3)) for _ in range(60)] + far
    texts += [edited(pick, pick.choice(far), pick.randrange(1, 5)) for _ in range(40)]
    compared = []

    def confirmed(pairs, *how):
        compared.append(pairs.count())
        return plain_confirmed(pairs, *how)

    plain_confirmed = minhash._confirmed
    monkeypatch.setattr(minhash, "_confirmed", confirmed)
    component = held(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    assert len(set(component.values())) > 50
    assert sum(compared) < 20 * len(texts)


def test_ids(spark):
    text = "one two three four five six"
    rows = [(5, text), (5, text), (None, text), (3, text + " "), (None, "alone here now"), (None, "alone here now"), (9, None), (9, None)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in found) == sorted(
        [(5, 4, 3, False), (5, 4, 3, False), (-1, 4, 3, False), (3, 4, 3, True), (-1, 1, -1, True), (-1, 1, -1, True),
         (9, 0, 9, True), (9, 0, 9, True)]
    )
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_signature_meets_similar_sets():
    """The share of equal bins is the similarity, for sets smaller and larger than the signature."""
    pick = np.random.default_rng(0)
    signer = minhash.Signer()
    for n in (7, 30, 300, 3000):
        agreed, missed = [], 0
        for _ in range(200 if n < 1000 else 40):
            a = np.unique(pick.integers(0, 1 << 64, n, np.uint64))
            gone = max(1, int(n * 0.15))
            b = a[np.sort(pick.permutation(n)[gone:])]
            agreed.append((signer.signature(a) == signer.signature(b)).mean())
            missed += not set(signer.keys(a).tolist()) & set(signer.keys(b).tolist())
        assert abs(np.mean(agreed) - (n - gone) / n) < 0.03 and not missed


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    sets, component = plain(docs)
    found = QUERIES["op13_minhash"](spark, FOLDER).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {
        (i, len(s), component[i], component[i] == i) for i, s in sets
    }
