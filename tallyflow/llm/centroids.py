"""Centroid clustering in exact integers with a progressive search in Walsh-Hadamard
coefficients.

Each vector becomes whole numbers, floor(256 * x), and is transformed by the integer
Walsh-Hadamard transform, which multiplies every squared distance by the number of
components. Coefficients are compared coarse to fine (fewest sign changes first): after
each block, the centroid that leads is compared in full, and what is summed so far and
the lengths of the two remainders bound the other distances from below. A centroid whose
bound exceeds the least full distance is strictly worse and leaves. The others finish all
coefficients, so every answer and every tie is exact.

A round is one pass: tasks sum their vectors by cluster, Spark adds the sums (a row for
each cluster and component), and the driver holds nothing but the k centroids. Vectors
are read again in each round; nothing about them is kept but the last assignment.

Whole numbers below 2**19 are compared in float64, where all sums stay exact. A batch
or centroid beyond that is compared in Python's integers, without bounds.

Defined results: vectors of another length, or with a null, NaN or infinite component,
are left out; a null vec_id is never a first centroid (any other may be) and is
assigned like others; of repeated vec_ids the one with the smaller vector comes first;
fewer vectors than k: that many centroids; ties go to the smaller number; a distance
that does not fit a long is null, as are sums that contain or are such a number; no
vectors: no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, written

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: places where the comparison of coefficients halts to leave out centroids
BLOCKS = (0, 4, 8, 16, 32, 48, 56, 64)
#: with a larger share of centroids left, a block is worked out for all of them
DENSE = 0.25
EXACT = 1 << 19
CHUNK_ROWS = 4_096
LIMB = 32
_LONG = 1 << 63


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 * x): float64 where that is exact enough to compare, else Python integers."""
    scaled = np.floor(values * SCALE)
    if np.abs(scaled).max(initial=0) < EXACT:
        return scaled
    exact = [int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def butterflies(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, in natural order."""
    size, step = rows.shape[1], 1
    while step < size:
        pairs = rows.reshape(len(rows), size // (2 * step), 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), size)
        step *= 2
    return rows


COARSE_FIRST = np.argsort((np.diff(butterflies(np.eye(DIMENSIONS)), axis=1) != 0).sum(axis=1), kind="stable")


def transformed(rows: np.ndarray) -> np.ndarray:
    return butterflies(rows)[:, COARSE_FIRST]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For transformed rows: number of the nearest centroid (ties: the smallest), the
    squared distance times the number of components, and how many pairs finished."""
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0), 0
    if vectors.dtype == object or centroids.dtype == object:
        vectors, centroids = (x if x.dtype == object else x.astype(np.int64).astype(object) for x in (vectors, centroids))
        sums = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        return sums.argmin(axis=1), sums.min(axis=1), sums.size
    sums = np.zeros((len(vectors), len(centroids)))
    alive, least = np.ones(sums.shape, bool), np.full(len(vectors), np.inf)
    for start, end in zip(BLOCKS, BLOCKS[1:]):
        own, other = vectors[:, start:end], centroids[:, start:end]
        if alive.mean() > DENSE:  # all products at once; whole numbers, so nothing is rounded
            sums += (own**2).sum(axis=1)[:, None] + (other**2).sum(axis=1) - 2 * (own @ other.T)
        else:
            rows, numbers = np.nonzero(alive)
            sums[rows, numbers] += ((own[rows] - other[numbers]) ** 2).sum(axis=1)
        if end < BLOCKS[-1]:
            lead = np.where(alive, sums, np.inf).argmin(axis=1)
            least = np.minimum(least, ((vectors - centroids[lead]) ** 2).sum(axis=1))
            own, other = ((x[:, end:] ** 2).sum(axis=1) for x in (vectors, centroids))
            slack = 1e-9 * (sums + own[:, None] + other)  # the roots are rounded
            alive &= sums + (np.sqrt(own)[:, None] - np.sqrt(other)) ** 2 - slack <= least[:, None]
    sums = np.where(alive, sums, np.inf)
    return sums.argmin(axis=1), sums.min(axis=1), int(alive.sum())


def limbs(total: int) -> list[int]:
    """The number in base 2**32, lowest first, the last one signed: sums of limbs stay small."""
    out = []
    while not -(1 << LIMB - 1) <= total < 1 << LIMB - 1:
        out.append(total & (1 << LIMB) - 1)
        total >>= LIMB
    return [*out, total]


def from_limbs(parts: dict[int, int]) -> int:
    return sum(part << LIMB * i for i, part in parts.items())


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the vectors that take part."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return embeddings.select("vec_id", vector.alias("vector")).where((F.size(vector) == DIMENSIONS) & fine)


def first_centroids(kept: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest hash of their id, in that order."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id is not null").orderBy(order, "vector").limit(k).select("vector").collect()  # k rows
    return [[int(x) for x in whole_numbers(np.array([r.vector]))[0]] for r in rows]


def matrix(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < EXACT for c in centroids for x in c)
    return transformed(np.array(centroids, dtype=float if small else object).reshape(-1, DIMENSIONS))


def chunks(batches, centroids: list[list[int]]):
    """(batch, whole numbers, cluster numbers, distances times the components) by chunk."""
    centres = matrix(centroids)
    for big in batches:
        for at in range(0, big.num_rows, CHUNK_ROWS):
            batch = big.slice(at, CHUNK_ROWS)
            rows = whole_numbers(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS))
            numbers, sums, _ = nearest(transformed(rows), centres)
            yield batch, rows, numbers, sums


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every centroid becomes the floor of the mean of its vectors."""

    def sums(batches):
        total, count = {}, {}
        for _, rows, numbers, _ in chunks(batches, centroids):
            for c in np.unique(numbers).tolist():
                own = rows[numbers == c]
                part = [int(x) for x in own.sum(axis=0)]
                total[c] = [x + y for x, y in zip(total.get(c, [0] * DIMENSIONS), part)]
                count[c] = count.get(c, 0) + len(own)
        cells = [(c, d, i, p) for c, values in total.items() for d, value in enumerate([*values, count[c]]) for i, p in enumerate(limbs(value))]
        columns = list(zip(*cells)) or [()] * 4
        yield dict(zip(("cluster", "component", "limb", "part"), columns))

    added = arrow_map(kept.select("vector"), sums, "cluster int, component int, limb int, part long")
    # at most k * 65 sums of a few limbs each
    cells: dict[tuple[int, int], dict[int, int]] = {}
    for cluster, component, limb, part in added.groupBy("cluster", "component", "limb").agg(F.sum("part")).collect():
        cells.setdefault((cluster, component), {})[limb] = part
    out = []
    for c, old in enumerate(centroids):
        count = from_limbs(cells.get((c, DIMENSIONS), {}))
        out.append([from_limbs(cells[c, d]) // count for d in range(DIMENSIONS)] if count else old)
    return out


def clusters(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    kept = kept_vectors(embeddings)
    centroids = first_centroids(kept, k)
    if not centroids:  # nothing to be near to
        kept = kept.where("false")
    for _ in range(rounds):
        centroids = moved(kept, centroids)

    def assign(batches):
        for batch, _, numbers, sums in chunks(batches, centroids):
            found = [int(s) // DIMENSIONS for s in sums]
            yield {"vec_id": batch.column("vec_id"), "cluster": numbers.astype(np.int32), "distance": [d if d < _LONG else None for d in found]}

    kind = kept.schema["vec_id"].dataType.simpleString()
    assigned = written(embeddings.sparkSession, arrow_map(kept, assign, f"vec_id {kind}, cluster int, distance long"), "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = assigned.groupBy("cluster").agg(F.when(F.count_if(F.col("distance").isNull()) == 0, wide).alias("total")).collect()  # k rows

    def fitting(total) -> int | None:
        return int(total) if total is not None and total < _LONG else None

    totals = {r.cluster: r.total for r in per}
    everything = None if None in totals.values() else sum(totals.values())
    inertia = F.array(*(F.lit(fitting(totals.get(c, 0))).cast("long") for c in range(len(centroids))))
    digests = F.array(*(F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids))
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(inertia, F.col("cluster")).cast("long").alias("cluster_inertia"),
        F.lit(fitting(everything)).cast("long").alias("inertia"),
        F.get(digests, F.col("cluster")).cast("string").alias("centroid_sha256"),
    )


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same in SQL: all distances, round by round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v
  FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})
)""",
    ]
    distance = "CAST(list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row_id, vec_id, v, min(struct_pack(d := d, cluster := cluster)) AS best
  FROM (SELECT kept.row_id, kept.vec_id, kept.v, c.cluster, {distance} AS d FROM (SELECT *, row_number() OVER () AS row_id FROM kept) kept, c{i} c)
  GROUP BY ALL
)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (
  SELECT cluster, list(mean ORDER BY place) AS v
  FROM (
    SELECT cluster, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS mean
    FROM (SELECT best.cluster AS cluster, place, sum(x) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY ALL)
  )
  GROUP BY cluster
)""")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT a.vec_id, a.best.cluster AS cluster, a.best.d AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.best.cluster"""
    )
