"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are dealt to the lists of their nearest centroids; a query looks into several
lists. Within a list the unit vectors are rotated at random and compared a block of
columns at a time: after each block a hypothesis test asks whether the partial distance
already shows that a candidate is farther than the k-th best, and drops it if so. What
is left is scored exactly on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.sources.tables import materialize

# The index is fitted on at most so many rows; every row is indexed.
SAMPLE_ROWS = 20_000
# Part of the sample's true neighbours that the probed lists must hold.
COVERAGE = 0.98
COLUMNS = 16
# Strictness of the test, in standard deviations of a partial distance.
EPSILON = 2.1
# Vectors and queries that meet in one task at a time.
_VECTORS, _QUERIES, _CANDIDATES = 4096, 512, 256


@dataclass(frozen=True)
class Index:
    """Centroids, a random rotation, and the number of lists to probe."""

    centroids: np.ndarray
    rotation: np.ndarray
    probes: int


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times powers of two, which keeps squares in range and cosines as they are; lengths."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled, lengths = _scaled(vectors)
    return scaled / lengths[:, None]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors."""
    return 2 - 2 * (a @ b.T)


def fit(units: np.ndarray, k: int, rows: int, coverage: float = COVERAGE, rounds: int = 8, seed: int = 1) -> Index:
    """Spherical k-means on a sample of unit vectors of a table of ``rows``.

    The number of lists is the root of the rows, but leaves 20 sampled vectors to a
    list. The number of probes is the least that finds ``coverage`` of the true
    neighbours that sampled vectors have in the sample; in the whole table neighbours
    are nearer, so more of them are found.
    """
    random = np.random.default_rng(seed)
    n, width = units.shape
    lists = max(1, min(int(rows**0.5), n // 20))
    centroids = units[random.choice(n, lists, replace=False)]
    for _ in range(rounds):
        own = np.argmin(_distances(units, centroids), axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, units)
        lengths = np.linalg.norm(sums, axis=1)
        centroids = np.where(lengths[:, None] > 1e-9, sums / np.maximum(lengths, 1e-9)[:, None], centroids)
    own = np.argmin(_distances(units, centroids), axis=1)
    asked = random.choice(n, min(n, 400), replace=False)
    near = _distances(units[asked], units)
    near[np.arange(len(asked)), asked] = np.inf
    neighbours = np.argsort(near, axis=1)[:, : min(k, n - 1)]
    ranks = np.argsort(np.argsort(_distances(units[asked], centroids), axis=1), axis=1)
    needed = np.take_along_axis(ranks, own[neighbours], axis=1).ravel() if n > 1 else np.zeros(1, int)
    probes = int(np.quantile(needed, coverage, method="higher")) + 1
    rotation, _ = np.linalg.qr(random.standard_normal((width, width)))
    return Index(centroids, rotation, min(probes, lists))


def _best(query: np.ndarray, rotated: np.ndarray, k: int, columns: int, epsilon: float) -> np.ndarray:
    """Rows that are among the ``k`` nearest to a rotated query, with ties, by the adaptive scan."""
    width = rotated.shape[1]
    kept = np.zeros(0, np.int64)
    far = np.zeros(0)
    limit = np.inf
    for first in range(0, len(rotated), _CANDIDATES):
        alive = np.arange(first, min(first + _CANDIDATES, len(rotated)))
        partial = np.zeros(len(alive))
        for start in range(0, width, columns):
            stop = min(start + columns, width)
            partial += ((rotated[alive, start:stop] - query[start:stop]) ** 2).sum(axis=1)
            if stop < width and np.isfinite(limit):
                # The partial distance, scaled up, strays from the whole one by chance.
                ok = partial * (width / stop) <= limit * (1 + epsilon / stop**0.5) ** 2
                alive, partial = alive[ok], partial[ok]
                if not len(alive):
                    break
        kept, far = np.append(kept, alive), np.append(far, partial)
        if len(far) >= k:
            limit = np.partition(far, k - 1)[k - 1] + 1e-6
            kept, far = kept[far <= limit], far[far <= limit]
    return kept


def _valid(vector: Column) -> Column:
    """No null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    coverage: float = COVERAGE,
    columns: int = COLUMNS,
    epsilon: float = EPSILON,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the nearest rows of each query.

    ``is_query`` picks the queries among the rows; all other rows than the query's own
    are its candidates. ``score`` is the cosine in double precision; ties go to the
    smaller id. Vectors that are null, zero, or hold a null or non-finite component take
    no part, nor do rows without an id and vectors of another length than most (of
    several lengths as frequent, the shortest). Rows that share an id are candidates of
    each other's queries never, of others each; rows that agree in id and vector count
    once, as queries and as candidates, and queries that share an id alone are one, with
    the nearest rows of all. Fewer candidates than ``k`` give fewer rows; an empty table
    gives none.
    """
    spark = rows.sparkSession
    given = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & _valid(F.col("v")))
    schema = "query_id long, rank int, vec_id long, score double"
    widths = given.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return spark.createDataFrame([], schema)
    width, n = widths["width"], widths["count"]
    given = given.where(F.size("v") == width)
    share = min(1.0, (sample_rows + 4 * sample_rows**0.5) / n)
    pick = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30))
    sample = given.where(pick < int(share * (1 << 30)) + 1).select(pick.alias("pick"), "id", "v").toArrow()
    order = np.lexsort([sample["id"].to_numpy(), sample["pick"].to_numpy()])[:sample_rows]
    flat = sample["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    if not len(flat):
        flat, order = np.eye(1, width), np.zeros(1, int)
    # Centroids and rotation are bounded by the sample and the width.
    shared = spark.sparkContext.broadcast(fit(_unit(flat[order]), k, n, coverage))

    def deal(batches):
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column("v").flatten()).reshape(-1, width)
            far = _distances(_unit(vectors), index.centroids)
            near = np.argpartition(far, index.probes - 1, axis=1)[:, : index.probes]
            asks = np.array(batch.column("asks").to_pylist(), dtype=bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "v": batch.column("v"),
                    "own": pa.array(np.argmin(far, axis=1).astype(np.int32)),
                    "probed": pa.array([p.tolist() if a else None for p, a in zip(near, asks)], pa.list_(pa.int32())),
                }
            )

    dealt = materialize(given.withColumn("asks", F.coalesce("asks", F.lit(False))).mapInArrow(
        deal, "id long, v array<double>, own int, probed array<int>"
    ))
    # A query that is given twice asks once.
    asked = materialize(dealt.where(F.col("probed").isNotNull()).dropDuplicates(["id", "v"]))
    asked = asked.select("id", "v", F.explode("probed").alias("own"))

    def parts(table: DataFrame, size: int) -> dict[int, int]:
        """Parts of each list: one row per list, and the lists are bounded by the sample."""
        return {r["own"]: -(-r["count"] // size) for r in table.groupBy("own").count().collect()}

    vector_parts, query_parts = parts(dealt, _VECTORS), parts(asked, _QUERIES)
    if not query_parts:
        return spark.createDataFrame([], schema)

    def lookup(table: dict[int, int]) -> Column:
        return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.col("own")), F.lit(0))

    def part(count: Column) -> Column:
        return F.pmod(F.xxhash64("id"), count).cast("int")

    def every(count: Column) -> Column:
        return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")))

    # Each part of a list's vectors meets each part of its queries in one bounded group.
    base = dealt.select("own", "id", "v", F.xxhash64("id", "v").alias("row"), part(lookup(vector_parts)).alias("vp"), every(lookup(query_parts)).alias("qp"))
    asked = asked.select("own", "id", "v", part(lookup(query_parts)).alias("qp"), every(lookup(vector_parts)).alias("vp"))

    def scan(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        index = shared.value
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and vectors.num_rows:
            # Copies of a row share its id, and so its part; they count once.
            _, once = np.unique(vectors["row"].to_numpy(), return_index=True)
            ids = vectors["id"].to_numpy()[once]
            exact, lengths = _scaled(np.array(vectors["v"].combine_chunks().flatten()).reshape(-1, width)[once])
            rotated = (exact / lengths[:, None] @ index.rotation).astype(np.float32)
            asking, sizes = _scaled(np.array(queries["v"].combine_chunks().flatten()).reshape(-1, width))
            turned = (asking / sizes[:, None] @ index.rotation).astype(np.float32)
            for i, query in enumerate(queries["id"].to_pylist()):
                others = np.flatnonzero(ids != query)
                found = others[_best(turned[i], rotated if len(others) == len(ids) else rotated[others], k, columns, epsilon)]
                scores = (exact[found] * asking[i]).sum(axis=1) / (lengths[found] * sizes[i])
                best = np.lexsort([ids[found], -scores])[:k]
                out["query_id"] += [query] * len(best)
                out["vec_id"] += ids[found][best].tolist()
                out["score"] += scores[best].tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    keys = ["own", "vp", "qp"]
    found = (
        asked.groupBy(*keys)
        .cogroup(base.groupBy(*keys))
        .applyInArrow(scan, "query_id long, vec_id long, score double")
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
