"""Nearest centroids by progressive search over Walsh-Hadamard coefficients.

A vector's components x become the integers floor(256 * x). Vector and centroids are transformed by the
Walsh-Hadamard matrix, whose entries are 1 and -1, so coefficients are exact integers and the squared distance is
the sum of squared coefficient differences divided by the number of components. The coefficients are taken in the order of
their sign changes, coarse to fine, in blocks. After the first block the leading centroid's distance is
completed; from then on a centroid is given up as soon as its sum so far is strictly greater than that, which a
centroid at least as near never is. Those that are left after all 64 coefficients hold the exact nearest ones;
the smallest number among them wins.

Rounds of assigning and averaging move only sums: each task adds up its vectors' components per centroid, so one
cluster with all rows is no larger than any other in the shuffle. The driver holds the centroids (40 of 64 numbers),
never vectors.

Kept are vectors with exactly 64 components, none null, not a number or infinite (nor 256 times it). Numbers of any
size are counted exactly, in Python's integers where 64 bits do not suffice; a distance or a sum of distances above
2**63 - 1 is given as 2**63 - 1. Repeated rows count each on their own; as starting centroids equal hashes are taken
in the order of the components. A null vec_id comes after all others there. An empty table, or one
without vectors to keep, gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

DIMS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: Coefficients that are added at a time, coarse to fine.
BLOCKS = (4, 4, 8, 16, 32)
#: Integers up to this size have squared distances of transforms that fit in 64 bits.
_FITS = 1 << 21
_LARGEST = 2**63 - 1
#: Bits of a limb, and the mark of a count among limbs.
_LIMB = 40
_COUNT = -1


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, by additions and subtractions only."""
    n, dims = rows.shape
    half = 1
    while half < dims:
        pairs = rows.reshape(n, dims // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(n, dims)
        half *= 2
    return rows


def _coarse_to_fine(dims: int) -> np.ndarray:
    """The coefficients by the number of sign changes in their row of the matrix."""
    matrix = _hadamard(np.eye(dims, dtype=np.int64))
    return np.argsort((matrix[:, 1:] != matrix[:, :-1]).sum(axis=1), kind="stable")


def nearest(vectors: np.ndarray, centroids: np.ndarray, blocks: tuple[int, ...] = BLOCKS) -> tuple:
    """Number of and squared distance to each row's nearest centroid; integers of one kind, 64 bits or Python's."""
    n, dims = vectors.shape
    order = _coarse_to_fine(dims)
    rows, middles = _hadamard(vectors)[:, order], _hadamard(centroids)[:, order]

    def added(row: np.ndarray, number: np.ndarray, start: int, end: int) -> np.ndarray:
        apart = rows[row, start:end] - middles[number, start:end]
        return (apart * apart).sum(axis=-1)

    first = blocks[0]
    coarse = np.empty((n, len(centroids)), vectors.dtype)
    for number in range(len(centroids)):
        apart = rows[:, :first] - middles[number, :first]
        coarse[:, number] = (apart * apart).sum(axis=1)
    every = np.arange(n)
    leader = coarse.argmin(axis=1)
    bound = coarse[every, leader] + added(every, leader, first, dims)
    row, number = np.nonzero((coarse <= bound[:, None]).astype(bool))
    total, start = coarse[row, number], first
    for size in blocks[1:]:
        total = total + added(row, number, start, start + size)
        start += size
        left = (total <= bound[row]).astype(bool)
        row, number, total = row[left], number[left], total[left]
    # pairs are still in the order of rows and, within one, of centroids
    least = np.minimum.reduceat(total, np.searchsorted(row, every)) if n else total
    best = (total == least[row]).astype(bool)
    row, place = np.unique(row[best], return_index=True)
    return number[best][place], least // dims


def _integers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers if all fit the exact arithmetic, else as Python's."""
    scaled = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dims)
    if np.abs(scaled).max(initial=0) < _FITS:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], object).reshape(-1, dims)


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """The number's limbs that are not 0, each with the number's sign."""
    sign, left, place = (-1 if number < 0 else 1), abs(number), 0
    while left:
        if part := left & ((1 << _LIMB) - 1):
            yield place, sign * part
        left >>= _LIMB
        place += 1


class _Model:
    """Centroids as lists of Python's integers; small, and sent along with the tasks."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        small = vectors.dtype != object and all(abs(x) < _FITS for c in self.centroids for x in c)
        kind = np.int64 if small else object
        return nearest(vectors.astype(kind), np.array(self.centroids, kind))


def kept_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part."""
    values = F.col("embedding").cast("array<double>")
    fits = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float("inf")))
    return vectors.where((F.size("embedding") == dims) & fits).select("vec_id", "embedding")


def starting_centroids(kept: DataFrame, n_clusters: int, dims: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of ``2:<vec_id>``."""
    hashed = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = (
        kept.select(hashed.alias("hashed"), F.col("embedding").cast("array<double>").alias("embedding"))
        .orderBy(F.col("hashed").asc_nulls_last(), "embedding")
        .limit(n_clusters)
        .collect()
    )
    return [[int(np.floor(scale * x)) for x in row["embedding"]] for row in rows]


def _moved(kept: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """Each centroid replaced by the floor of its vectors' mean; empty ones stay."""
    model = _Model(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(model.centroids), dims), object)
        counts = np.zeros(len(model.centroids), np.int64)
        for batch in batches:
            vectors = _integers(batch.column("embedding"), dims, scale)
            if not len(vectors):
                continue
            number, _ = model.assign(vectors)
            order = np.argsort(number, kind="stable")
            present, starts = np.unique(number[order], return_index=True)
            sums[present] += np.add.reduceat(vectors[order], starts, axis=0).astype(object)
            counts += np.bincount(number, minlength=len(counts))
        full = np.flatnonzero(counts)
        # counts, then sums by limbs, so that Spark's sums of them are exact whatever their size
        rows = [(int(c), 0, _COUNT, int(counts[c])) for c in full]
        for c in full:
            for place, total in enumerate(sums[c]):
                rows += [(int(c), place, limb, part) for limb, part in _limbs(int(total))]
        columns = zip(*rows) if rows else [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["cluster", "place", "limb", "part"]
        )

    parts = kept.select("embedding").mapInArrow(add, "cluster int, place int, limb int, part long")
    counts = dict.fromkeys(range(len(centroids)), 0)
    totals: dict[int, list[int]] = {}
    for row in parts.groupBy("cluster", "place", "limb").agg(F.sum("part").alias("part")).collect():
        own = totals.setdefault(row["cluster"], [0] * dims)
        if row["limb"] == _COUNT:
            counts[row["cluster"]] = row["part"]
        else:
            own[row["place"]] += row["part"] << _LIMB * row["limb"]
    return [[x // counts[c] for x in totals[c]] if c in totals else old for c, old in enumerate(centroids)]


def _assigned(kept: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of each kept vector."""
    model = _Model(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _integers(batch.column("embedding"), dims, scale)
            if not len(vectors):
                continue
            number, distance = model.assign(vectors)
            if distance.dtype == object:
                distance = np.array([min(int(d), _LARGEST) for d in distance], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


def cluster(
    vectors: DataFrame, n_clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid`` (its components)
    of each kept vector, after ``rounds`` rounds. ``dims`` is a power of two, the sum of ``BLOCKS``."""
    spark = vectors.sparkSession
    small_batches(spark)
    kept = kept_vectors(vectors, dims, scale)
    centroids = starting_centroids(kept, n_clusters, dims, scale)
    if centroids:
        for _ in range(rounds):
            centroids = _moved(kept, centroids, dims, scale)
        assigned = saved(_assigned(kept, centroids, dims, scale), "assigned-vectors")
    else:
        assigned = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    sums = {row["cluster"]: int(row["inertia"]) for row in assigned.groupBy("cluster").agg(exact).collect()}
    total = min(sum(sums.values()), _LARGEST)
    known = [
        (c, min(sums[c], _LARGEST), total, ",".join(map(str, centroids[c]))) for c in sorted(sums)
    ]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid string")
    # one row per centroid
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def _oracle() -> str:
    """The query op12 in DuckDB: five rounds and the last assignment, one after the other."""
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        """m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || cast(vec_id AS VARCHAR)), c) - 1 AS k, c FROM v
  ORDER BY k LIMIT 40
)""",
    ]
    for i in range(6):
        steps.append(f"""d{i} AS (
  SELECT v.row, m.k, list_sum(list_transform(list_zip(v.c, m.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
  FROM v CROSS JOIN m{i} m
), a{i} AS MATERIALIZED (
  SELECT row, cast(split_part(min(lpad(cast(cast(d AS BIGINT) AS VARCHAR), 19, '0') || ':' || lpad(cast(k AS VARCHAR), 2, '0')), ':', 2)
         AS INTEGER) AS k, cast(min(d) AS BIGINT) AS d FROM d{i} GROUP BY row
)""")
        if i < 5:
            steps.append(f"""s{i} AS (
  SELECT a.k, p.place, sum(v.c[p.place]) AS total, count(*) AS n
  FROM a{i} a JOIN v USING (row) CROSS JOIN (SELECT unnest(range(1, 65)) AS place) p GROUP BY ALL
), n{i} AS (
  SELECT k, list(cast((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c FROM s{i} GROUP BY k
), m{i + 1} AS MATERIALIZED (
  SELECT m.k, coalesce(n.c, m.c) AS c FROM m{i} m LEFT JOIN n{i} n USING (k)
)""")
    return "WITH " + ", ".join(steps) + """
SELECT v.vec_id, a.k AS cluster, a.d AS distance,
       cast(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       cast(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM v JOIN a5 a USING (row) JOIN m5 m ON m.k = a.k
"""


ORACLE = _oracle()
