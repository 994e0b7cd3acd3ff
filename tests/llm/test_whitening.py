"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest

from rostra.llm import whitening
from rostra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, whitened string, v int"


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    v = (q * np.array(values, float)) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize(
    "values",
    [[5], [3, 1], [2, 2, 2], [0, 0, 0], [9, 9, 4, 1, 0], list(10.0 ** -np.arange(12)), list(range(1, 65)), [1e-9] * 20 + [1e9],
     [1] * 7 + [1 + 1e-15] * 7],
)
def test_components_of_known_spectra(values):
    v = spectrum(values)
    e, q = whitening.components(v)
    assert np.allclose(q.T @ q, np.eye(len(v)), atol=1e-13)
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-13 * max(values))
    assert np.allclose(v @ q, q * e, atol=1e-13 * max(1e-300, max(values)))


def test_polar_factor():
    a = np.random.default_rng(3).standard_normal((30, 30)) * np.linspace(1e-6, 1, 30)
    u, _, v = np.linalg.svd(a)
    assert np.allclose(whitening.polar(a), u @ v, atol=1e-9)


def plain(vectors):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], float)
    y = x - x.mean(axis=0)
    e, q = np.linalg.eigh(y.T @ y / len(y))
    return e[::-1], y @ q[:, ::-1][:, :8] / np.sqrt(np.maximum(e[::-1][:8], 1e-300)), x


def test_odd_rows(spark):
    pick = np.random.default_rng(5)
    good = [(i, v.tolist()) for i, v in enumerate(pick.standard_normal((200, 5)) * [3, 1, 2, 0.5, 1] + [9, 0, 0, 1, -4])]
    good += [(7, good[7][1]), (None, good[9][1]), (500, [-1e4, 1e4, 0.0, 3.0, 1.0])]
    odd = [(600, None), (601, []), (602, [1.0, None, 1.0, 1.0, 1.0]), (603, [math.nan] * 5), (604, [math.inf] + [1.0] * 4),
           (605, [1.0, 2.0]), (606, [1e30] * 5)]
    rows = spark.createDataFrame([(i, v, "mine", 3) for i, v in good + odd], SCHEMA)
    model = whitening.fit(rows)
    e, want, x = plain([v for _, v in good])
    assert model.n == len(good) and model.sums == tuple(int(s) for s in x.sum(axis=0))
    found = whitening.whiten(rows, model)
    assert found.columns == ["vec_id", "embedding", "v", "whitened", "deviation"]
    key = lambda i: (i is None, i or 0)
    got = sorted(found.collect(), key=lambda r: key(r.vec_id))
    want = [w for _, w in sorted(zip([i for i, _ in good], want.tolist()), key=lambda p: key(p[0]))]
    assert [r.vec_id for r in got] == sorted((i for i, _ in good), key=key)
    assert np.allclose(np.abs([r.whitened for r in got]), np.abs(np.array(want))[:, :5], atol=1e-9)
    n, sums = model.n, model.sums
    exact = {i: sum((n * (math.floor(1024 * c) + 100_000) - s) ** 2 for c, s in zip(v, sums)) for i, v in good}
    assert {r.vec_id: int(r.deviation) for r in got} == exact
    assert whitening.identity_error(found, 5) < 1e-9
    assert np.allclose(model.values, e, rtol=1e-9)


def test_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], "mine", 0) for i in range(4)], SCHEMA)
    model = whitening.fit(same)
    assert model.count() == 0 and [r.whitened for r in whitening.whiten(same, model).collect()] == [[]] * 4
    flat = spark.createDataFrame([(i, [float(i), 2.0], "mine", 0) for i in range(4)], SCHEMA)
    assert whitening.fit(flat).count() == 1
    assert whitening.fit(same.limit(0)) is None and whitening.fit(same.selectExpr("CAST(NULL AS array<float>) AS embedding")) is None


def test_query(spark):
    """Signs are the same for all rows, so each component agrees up to one sign."""
    got = QUERIES["op12_whitening"](spark, FOLDER).toPandas()
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    e, want, _ = plain([r.embedding for r in rows])
    assert len(got) == 8 * len(rows) and got.identity_error.max() < 1e-9
    for c in range(8):
        mine = got[got.component == c + 1].set_index("vec_id").whitened.loc[[r.vec_id for r in rows]].to_numpy()
        sign = np.sign(mine @ want[:, c])
        assert np.allclose(mine * sign, want[:, c], atol=1e-8)
        assert got[got.component == c + 1].explained.iloc[0] == pytest.approx(e[c] / e.sum(), rel=1e-10)
