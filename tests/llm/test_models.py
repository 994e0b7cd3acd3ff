"""Language ID, token counts, URL filter and language-model scoring."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from plain import ODD_TEXTS, best_cut, unigram_base, words
from pyspark.sql import functions as F

from rostra.llm import ctw, langid, tokencount, urlfilter
from rostra.llm.common import training
from rostra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def crc(value):
    return zlib.crc32(("" if value is None else str(value)).encode())


def test_training_rows(spark):
    frame = spark.createDataFrame([(0,), (17,), (-5,), (None,)], "doc_id long")
    for r in frame.select("doc_id", training(F.col("doc_id"), 7, 2).alias("t")).collect():
        assert r.t == (crc(r.doc_id) % 7 != 2)


# ---- language ID ----


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op10_language_id"](spark, folder).collect()
    assert len(found) == len(lang)
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.95 * len(held)
    assert sum(r.rejected for r in found) < 0.01 * len(found)


def test_language_edges(spark):
    base = [("la casa de la que los", "es"), ("the house of the one", "en"), (None, "en"), ("ohne", None)]
    learn = spark.createDataFrame([(i, *r) for i, r in enumerate(base * 5)], "doc_id long, text string, lang string")
    model = langid.fit(learn)
    assert sorted(set(model.languages)) == ["en", "es"]
    rows = [(i, t, "mine") for i, t in enumerate([*ODD_TEXTS, "the one of the house"] * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = {r.doc_id: r for r in langid.predict(frame, model).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        letters = any(c.isalpha() for c in text or "")
        assert (found[i].lang_pred == "und") == (not letters) and (letters or found[i].score == 0)
        assert letters or found[i].rejected
    assert found[len(ODD_TEXTS)].lang_pred == "en" and not found[len(ODD_TEXTS)].rejected
    nothing = langid.fit(learn.limit(0))
    assert {(r.lang_pred, r.rejected) for r in langid.predict(frame, nothing).collect()} == {("und", True)}
    assert langid.predict(frame.limit(0), model).count() == 0


def test_the_sample_is_bounded(spark):
    rows = [(i, f"{'abcd'[i % 4] * 5} {i}", "xy"[i % 9 == 0]) for i in range(900)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = langid.fit(learn, sample_rows=40), langid.fit(learn.repartition(7), sample_rows=40)
    assert np.array_equal(one.weights, two.weights) and np.allclose(one.centroids, two.centroids)
    assert len(one.centroids) <= 8


def plain_grams(text, dimensions):
    """Counts of the numbers of all pairs and triples of bytes, A-Z lowered, other ASCII but letters as spaces."""
    fold = [c + 32 if 65 <= c <= 90 else 32 if c < 128 and not 97 <= c <= 122 else c for c in text.encode()]
    mask, shift = 0xFFFFFFFF, 32 - dimensions.bit_length() + 1
    out = Counter()
    for at in range(len(fold) - 1):
        two = (fold[at] * 0x9E3779B1 + fold[at + 1] * 0x85EBCA77) & mask
        out[(two * 0x9E3779B1 & mask) >> shift] += 1
        if at + 2 < len(fold):
            three = ((two ^ 0x27D4EB2F) * 0xC2B2AE3D + fold[at + 2] * 0x165667B1) & mask
            out[(three * 0x9E3779B1 & mask) >> shift] += 1
    return out


def test_predictions_like_plain_tf_idf(spark):
    """Weights from plain document frequencies, and the nearest centroid by a loop over all of them."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").limit(120).collect()
    docs = [(r.doc_id, r.text[:1500], r.lang) for r in rows] + [(-1, "", "en"), (-2, "x", "fr"), (-3, "Straße übers Meer", "de")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    size = len(model.weights)
    grams = [plain_grams(t, size) for _, t, _ in docs]
    held = Counter(g for c in grams for g in c)
    for g in [*list(held)[:400], 5, 77]:
        assert model.weights[g] == pytest.approx(math.log((1 + len(docs)) / (1 + held[g])) + 1, rel=1e-5)
    found = {r.doc_id: r for r in langid.predict(frame, model).collect()}
    checked = 0
    for (i, text, _), counts in zip(docs, grams):
        if not any(c.isalpha() for c in text):
            assert found[i].lang_pred == "und"
            continue
        vector = {g: math.sqrt(n) * float(model.weights[g]) for g, n in counts.items()}
        length = math.sqrt(sum(v * v for v in vector.values())) or 1.0
        cosines = [sum(v * float(c[g]) for g, v in vector.items()) / length for c in model.centroids]
        best = max(cosines)
        assert found[i].score == pytest.approx(min(max(best, 0), 1), abs=1e-4)
        if sorted(cosines)[-2] < best - 1e-4:
            assert found[i].lang_pred == model.languages[cosines.index(best)]
            checked += 1
        if abs(best - model.least) > 1e-4:
            assert found[i].rejected == (best < model.least)
    assert checked > 100


# ---- token counts ----


def test_trie_like_every_cut():
    pick = random.Random(4)
    pieces = {"".join(pick.choice("abc") for _ in range(pick.randrange(1, 5))): -pick.random() * 9 for _ in range(40)}
    found = [tokencount.MARK + "".join(pick.choice("abcdé") for _ in range(pick.randrange(0, 12))) for _ in range(300)]
    counts = tokencount.trie_counts(list(set(found)), pieces)
    unknown = min(pieces.values()) - tokencount.UNKNOWN
    assert counts == {w: best_cut(w, pieces, unknown) for w in found}
    assert tokencount.trie_counts([], pieces) == {} and tokencount.trie_counts(["é"], {}) == {"é": 2}


def test_token_counts_of_rows(spark, monkeypatch):
    pieces = tokencount.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    unknown = min(pieces.values()) - tokencount.UNKNOWN
    rows = [(i, t, "mine") for i, t in enumerate([*ODD_TEXTS[:-1], "x" * 300, "the theory of the thing"] * 2)]
    frame = spark.createDataFrame(rows, "id long, text string, n_words string")
    found = tokencount.count_tokens(frame, pieces)
    assert found.columns == ["id", "text", "n_words", "n_tokens"]
    for r in found.collect():
        own = words(r.text)
        assert r.n_words == len(own)
        assert r.n_tokens == sum(best_cut(tokencount.MARK + w, pieces, unknown) for w in own)
    assert tokencount.count_tokens(frame.limit(0), pieces).count() == 0


def test_token_count_query(spark):
    pieces = tokencount.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    unknown = min(pieces.values()) - tokencount.UNKNOWN
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    known = {w: best_cut(tokencount.MARK + w, pieces, unknown) for t in texts.values() for w in set(words(t))}
    found = QUERIES["op8_token_counts"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: sum(known[w] for w in words(t)) for i, t in texts.items()}


# ---- url filter ----

URLS = [
    ("https://WWW.Example.com/en/a", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/x?y=/z", "m.example.com", "/en/x", "example.com/en/", "block"),
    ("http://example.com/en", "example.com", "/en", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("x://b.net/es/1#q", "b.net", "/es/1", "net/es/", "block"),
    ("x://net/fr/1", "net", "/fr/1", "net/fr/", "block"),
    ("x://b.net/de/1", "b.net", "/de/1", None, None),
    ("x://b.com", "b.com", "", None, None),
    ("x://b.com?/q", "b.com", "", None, None),
    ("a://b://c.net/es/", "b:", "//c.net/es/", None, None),
    ("example.com/en/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_urls_and_rules(spark):
    rows = [(i, u[0], "mine") for i, u in enumerate(URLS + URLS[:2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, tokens string")
    texts = spark.createDataFrame([("the house in the town example",), (None,)], "text string")
    found = {r.page_id: r for r in urlfilter.judge(pages, texts).collect()}
    assert len(found) == len(rows)
    for i, (_, host, path, rule, verdict) in enumerate(URLS + URLS[:2]):
        got = found[i]
        assert (got.host, got.path, got.rule) == (host, path, rule)
        assert got.verdict == (verdict or ("block" if got.log_odds > 0 else "allow"))
    assert urlfilter.judge(pages.limit(0), texts).count() == 0
    assert urlfilter.judge(pages, texts.limit(0)).count() == len(rows)


def test_segments_are_the_best(spark):
    pick = random.Random(6)
    scores = {"".join(pick.choice("abc") for _ in range(pick.randrange(1, 4))): -pick.random() * 5 for _ in range(12)}
    unknown = min(scores.values()) - math.log(10)

    def cuts(label):
        if not label:
            yield []
        for end in range(1, len(label) + 1):
            if label[:end] in scores or end == 1:
                for rest in cuts(label[end:]):
                    yield [label[:end], *rest]

    def value(cut):
        return sum(scores.get(w, unknown) for w in cut)

    for _ in range(60):
        label = "".join(pick.choice("abcd") for _ in range(pick.randrange(0, 9)))
        got = urlfilter.segment(label, scores, 3)
        assert "".join(got) == label and value(got) == pytest.approx(max(map(value, cuts(label))))
    assert urlfilter.segment("townhouse", {"town": -1.0, "house": -1.0, "ho": -0.9, "use": -0.9}, 5) == ["town", "house"]


def plain_tokens(host, path, counts):
    """Tokens of a url, its host cut under the counts of all words."""
    total = sum(counts.values())
    scores = {w: math.log(n / total) for w, n in counts.items()}
    longest = max(map(len, scores), default=1)
    unknown = min(scores.values(), default=0.0) - math.log(10)
    out = []
    for part in regex.findall(r"\p{L}+|\p{Nd}+", host):
        out += ["h:" + w for w in ([f"#{len(part)}"] if part[0].isdigit() else urlfilter.segment(part, scores, longest, unknown))]
    for part in regex.findall(r"\p{L}+|\p{Nd}+", path.lower()):
        out.append("p:" + (f"#{len(part)}" if part[0].isdigit() else part))
    return out


def held_to_plain_bayes(found, texts):
    counts = Counter(w for t in texts for w in regex.findall(r"\p{L}+", (t or "").lower()))
    tokens = {r.page_id: plain_tokens(r.host, r.path, counts) for r in found}
    label = {r.page_id: r.verdict for r in found if r.rule}
    seen = {v: Counter(t for i, x in label.items() if x == v for t in tokens[i]) for v in ("block", "allow")}
    size = len(set(seen["block"]) | set(seen["allow"])) + 1
    total = {v: sum(c.values()) + size for v, c in seen.items()}
    prior = math.log((list(label.values()).count("block") + 1) / (list(label.values()).count("allow") + 1))
    for r in found:
        odds = sum(math.log((seen["block"][t] + 1) / total["block"]) - math.log((seen["allow"][t] + 1) / total["allow"])
                   for t in tokens[r.page_id])
        assert r.n_tokens == len(tokens[r.page_id])
        assert r.log_odds == pytest.approx(prior + odds)
        assert r.rule or r.verdict == ("block" if r.log_odds > 0 else "allow")


def test_url_query_like_plain_bayes(spark):
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    held_to_plain_bayes(urlfilter.judge(pages, spark.createDataFrame([(t,) for t in texts], "text string")).collect(), texts)
    assert len(QUERIES["op9_url_filter"](spark, FOLDER).collect()) == pages.count()


def test_rare_words_and_tokens_count(spark):
    """A word seen once in a large corpus cuts a host, and a token seen once tells a verdict."""
    texts = [" ".join(["house", "town"] * 50_000), "straße quokka"]
    urls = ["x://quokkahouse.org/a", "x://straßetown.org/b", "x://quokkatown.net/es/zebra", *["x://town.net/fr/u"] * 40,
            *["x://house.com/v"] * 60, "x://a.org/zebra", "x://a.org/v", "x://a.org/v/v/zebra/17/4", "x://" + "h" * 300 + ".org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"row": F.lit(1), "label": F.lit("mine"), "fit": F.lit(2)})
    found = urlfilter.judge(pages, spark.createDataFrame([(t,) for t in texts], "text string"))
    assert found.columns == [*pages.columns, "host", "path", "rule", "verdict", "n_tokens", "log_odds"]
    rows = found.collect()
    held_to_plain_bayes(rows, texts)
    got = {r.url: r for r in rows}
    assert got["x://quokkahouse.org/a"].n_tokens == 6
    # Equal but for one token; that of the first was seen once, in a blocked url.
    assert got["x://a.org/zebra"].log_odds > got["x://a.org/v"].log_odds + 2


# ---- context-tree weighting ----


def plain_tree(texts, depth):
    """Visits of all nodes, and the mixture by recursion."""
    visits = {}
    for text in texts:
        line = bytes(depth) + text + b"\xff"
        for at in range(depth, len(line)):
            for i in range(8):
                bit, node = line[at] >> (7 - i) & 1, (1 << i) | line[at] >> (8 - i)
                for d in range(depth + 1):
                    key = (line[at - d : at][::-1], node)
                    visits.setdefault(key, [0, 0])[bit] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children = {}
    for context, node in visits:
        if context:
            children.setdefault((context[:-1], node), []).append((context, node))

    def weighted(key):
        own = kt(*visits[key])
        if len(key[0]) == depth:
            return own
        return np.logaddexp(own, sum(map(weighted, children[key]))) - math.log(2)

    def one(context, node):
        """Probability of a one after the bytes of ``context``, nearest first."""
        mixed, left = 0.0, 1.0
        for d in range(depth + 1):
            key = (context[:d], node)
            a, b = visits[key]
            estimate = (b + 0.5) / (a + b + 1)
            deeper = (context[: d + 1], node)
            if d == depth:
                return mixed + left * estimate
            stop = math.exp(kt(a, b) - math.log(2) - weighted(key))
            mixed, left = mixed + left * stop * estimate, left * (1 - stop)
            if deeper not in visits:
                return mixed + left * estimate
        raise AssertionError

    return visits, one


def test_the_mixture_like_the_recursion(spark):
    texts = [b"abracadabra", b"abba", b"", "é".encode(), b"cab" * 5]
    frame = spark.createDataFrame([(t.decode(),) for t in texts], "text string")
    for depth in (0, 2):
        tree = ctw.fit(frame, depth=depth, support=1 << 20)
        visits, one = plain_tree(texts, depth)
        assert (tree.keys != 0).sum() == len(visits)
        for text in [*texts, b"bad", b"cadabb"]:
            line = bytes(depth) + text + b"\xff"
            grams = [int.from_bytes(line[at - depth : at + 1], "big") for at in range(depth, len(line))]
            got = tree.log10(np.array(grams, np.uint64))
            for at, value in zip(range(depth, len(line)), got):
                want = 0.0
                for i in range(8):
                    node, bit = (1 << i) | line[at] >> (8 - i), line[at] >> (7 - i) & 1
                    p = 0.5 if (b"", node) not in visits else one(line[at - depth : at][::-1], node)
                    want += math.log10(p if bit else 1 - p)
                assert value == pytest.approx(want, abs=1e-5)


def test_probabilities_sum_to_one(spark):
    frame = spark.createDataFrame([("to be or not to be " * 20,), ("that is the question",)], "text string")
    for support in (1 << 20, 50):
        tree = ctw.fit(frame, depth=3, support=support)
        for context in (b"to ", b"\0\0\0", b"xyz", b"\0\0t"):
            grams = [int.from_bytes(context + bytes([b]), "big") for b in range(256)]
            assert (10 ** tree.log10(np.array(grams, np.uint64))).sum() == pytest.approx(1, abs=1e-4)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3, 20.5, 1e6])
    assert np.allclose(ctw._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


@pytest.mark.parametrize("block", [12_000_000, 60])
def test_scores_of_rows(spark, monkeypatch, block):
    monkeypatch.setattr(ctw, "_BLOCK", block)
    docs = [(i, t) for i, t in enumerate([*ODD_TEXTS, "The cat and the dog", "a cat", "unheard-of"])]
    frame = spark.createDataFrame([*docs, (None, "a cat"), docs[4]], "doc_id long, text string")
    found = ctw.score(frame, training(F.col("doc_id"), 7, 2)).collect()
    assert len(found) == len(docs) + 2
    def trains(i):
        return crc(i) % 7 != 2
    base = unigram_base([*docs, (None, "a cat"), docs[4]], trains)
    for r in found:
        n, known, total, score = base[r.doc_id]
        assert r.held_out == (not trains(r.doc_id))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(score) and r.score < 0
        size = len((dict(docs).get(r.doc_id, "a cat") or "").encode()) + 1
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / size)
    nothing = ctw.score(frame, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.bits_per_byte == pytest.approx(8) for r in nothing)
    assert ctw.score(frame.limit(0), F.lit(True)).count() == 0


def test_scores_tell_text_from_noise(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op6_ctw"](spark, folder).where("held_out").collect()
    bits = sorted(r.bits_per_byte for r in found if r.n_tokens > 50)
    assert len(bits) > 50 and bits[len(bits) // 2] < 2.6


def test_cached_scores_are_those_of_the_tree(monkeypatch):
    monkeypatch.setattr(ctw, "_CACHE_BITS", 3)
    nodes = pa.table({"depth": [0], "context": [0], "node": [1], "zeros": [3], "ones": [9]})
    tree = ctw.build_tree(nodes, 0)
    scorer, pick = ctw._Scorer(tree), np.random.default_rng(1)
    for _ in range(20):
        grams = pick.integers(0, 256, 50).astype(np.uint64)
        assert np.allclose(scorer.log10(grams), tree.log10(grams))


def test_scores_use_every_context_of_training(spark, monkeypatch):
    """Rare contexts count as frequent ones do, and far more visits make no probability zero."""
    monkeypatch.setattr(ctw, "_BLOCK", 300)
    texts = ["the cat sat on the mat " * 4, "qzx", "éa", "", "e" * 280_000]
    asked = ["qzx", "qzy", "the mat", "éé", "\x01"]
    depth = 2
    visits, one = plain_tree([t.encode() for t in texts], depth)
    docs = [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(asked)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, trains boolean").repartition(3)
    found = {r.doc_id: r for r in ctw.score(frame, F.col("trains"), depth=depth).collect()}
    for i, text, trains in (d for d in docs if len(d[1]) < 1000):
        line, want = bytes(depth) + text.encode() + b"\xff", 0.0
        for at in range(depth, len(line)):
            for k in range(8):
                node, bit = (1 << k) | line[at] >> (8 - k), line[at] >> (7 - k) & 1
                p = 0.5 if (b"", node) not in visits else one(line[at - depth : at][::-1], node)
                want += math.log10(p if bit else 1 - p)
        assert found[i].score == pytest.approx(want, rel=1e-5) and found[i].held_out == (not trains)


def test_the_whole_tree_is_not_cut_by_its_visits():
    """One visit in millions still is a context of its own."""
    # After 'ab' comes 'c' in millions of visits; once the byte is 'd'.
    paths = np.array([0x626163, 0x626164], np.uint64)
    sums = {"near": [], "node": [], "zeros": [], "ones": [], "below": []}
    for top, *_ in ctw._subtree(paths, np.array([1 << 26, 1]), 2):
        sums["near"] += (top["keys"] >> np.uint64(16)).astype(int).tolist()
        sums["node"] += (top["keys"] & np.uint64(255)).astype(int).tolist()
        for name, column in (("zeros", "zeros"), ("ones", "ones"), ("below", "weighted")):
            sums[name] += top[column].tolist()
    logs = ctw._log10(np.array([0x626162, *paths], np.uint64), np.array([0, 1 << 26, 1]), 2, ctw._mix_upper(pa.table(sums)))
    assert np.isfinite(logs).all() and logs[1] > -1e-6 and -9 < logs[2] < -7
