"""Near-dedup by Jaccard similarity against all pairs."""

import random

from plain import ODD_TEXTS, components, lower, words

from rostra.llm import neardedup


def shingles(text, size=5):
    found = words(lower(text))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def plain_groups(docs, similarity=0.8):
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)

    def near(a, b):
        return len(a & b) >= similarity * len(a | b) - 1e-9

    return components(ids, [(a, b) for a in ids for b in ids if a < b and near(sets[a], sets[b])])


def edited(pick, found, n):
    found = list(found)
    for _ in range(n):
        at = pick.randrange(len(found))
        found[at : at + pick.choice([0, 1, 1, 1])] = [f"new{pick.randrange(10**6)}"] * pick.choice([0, 1, 1])
    return found


def test_every_pair_of_similarity_is_linked(spark):
    pick = random.Random(0)
    texts = [*ODD_TEXTS, "A b c d", "a B c d", "a b c d e", "a b c d e f"]
    passage = [f"p{j}" for j in range(60)]
    for size in (7, 12, 40, 120, 400):
        for _ in range(6):
            base = [f"w{pick.randrange(2000)}" for _ in range(size)]
            texts += [" ".join(edited(pick, base, n)) for n in (0, 0, 1, 1, 2, size // 60, size // 40)]
        # A passage that many have, and texts that consist of it nearly.
        texts += [" ".join(passage + edited(pick, base, size)) for _ in range(12)]
        texts += [" ".join(edited(pick, passage, 2)) for _ in range(6)]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    group = plain_groups(docs)
    found = neardedup.near_duplicates(frame).collect()
    assert len(found) == len(docs)
    least = {}
    for r in found:
        least[r.group] = min(r.doc_id, least.get(r.group, r.doc_id))
    assert {r.doc_id: least[r.group] for r in found} == group
    kept = neardedup.keep_one(frame.unionByName(frame.limit(40)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))
