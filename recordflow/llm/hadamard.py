"""Centroid clustering by Walsh-Hadamard progressive search, in exact integers.

A vector's components become integers, and vectors and centroids go through
the unnormalised Walsh-Hadamard transform. That keeps squared distances up to
the factor 64, and its leading coefficients hold the coarse shape, so sums of
squared coefficient differences grow to the distance from coarse to fine. One
promising centroid is finished first; every centroid whose sum so far is
strictly larger is out, and the others are finished over all 64 coefficients.

Only centroid sums (at most ``k`` x 64 rows) and the final ``k`` inertias
reach the driver; each task adds up its own rows before the shuffle.

Defined results: vectors that are null, or have another number of components,
or a null or non-finite one, are left out. With fewer than ``k`` vectors, each
is a centroid; an empty table gives no rows. Equal rows are rows of their own.
A null id is a row like any other and starts a centroid last. Vectors of
components too large for 64-bit distances are worked on with unbounded
integers; a distance or sum beyond 2^63 - 1 is given as 2^63 - 1. Other
columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stored

SIZE = 64  # components, a power of two
SCALE = 1024
LEVELS = [(0, 1), (1, 2), (2, 4), (4, 8), (8, 16), (16, 32), (32, 64)]  # coefficients, coarse to fine
GUESS = 4  # levels after which the most promising centroid is finished
NARROW = 1 << 21  # components up to this keep all sums of squares below 2^63
ROWS = 4096  # rows worked on at once
LARGEST = (1 << 63) - 1

_LIMB = 32


def transform(x: np.ndarray) -> np.ndarray:
    """The exact Walsh-Hadamard transform of each row (a copy), by butterflies."""
    x = x.copy()
    step = SIZE // 2
    while step:  # the widest sums first, so leading coefficients are the coarse ones
        v = x.reshape(len(x), -1, 2, step)
        a, b = v[:, :, 0, :].copy(), v[:, :, 1, :].copy()
        v[:, :, 0, :], v[:, :, 1, :] = a + b, a - b
        step //= 2
    return x[:, _COARSE_FIRST]


def _coarse_first() -> np.ndarray:
    """Order of the butterfly's outputs by the number of halvings they tell apart."""
    bits = SIZE.bit_length() - 1
    return np.array([int(format(i, f"0{bits}b")[::-1], 2) for i in range(SIZE)])


_COARSE_FIRST = _coarse_first()


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each row of integers, and the number of coefficient differences formed.

    Ties go to the smaller number: only strictly worse centroids are eliminated.
    """
    tx, tc = transform(x), transform(centroids)
    n, k = len(x), len(centroids)
    total = np.zeros((n, k), x.dtype)
    alive = np.ones((n, k), bool)
    done = np.zeros(n, np.int64)
    work = 0

    def add(rows, c, a, b):
        nonlocal work
        d = tx[rows, a:b] - tc[c, a:b]
        total[rows, c] += (d * d).sum(axis=1)
        work += len(rows) * (b - a)

    best = None
    for level, (a, b) in enumerate(LEVELS):
        if level == GUESS:  # finish the centroid that looks best: its distance bounds the least one from above
            guess = total.argmin(axis=1)
            for c in range(k):
                rows = np.flatnonzero(guess == c)
                if len(rows):
                    add(rows, c, a, SIZE)
            best = total[np.arange(n), guess]
            done = guess
        for c in range(k):
            rows = np.flatnonzero(alive[:, c] & (done != c)) if best is not None else np.arange(n)
            if len(rows):
                add(rows, c, a, b)
        if best is not None:
            alive &= ~(total > best[:, None])
    left = np.where(alive, total, best[:, None] + 1)  # survivors have all 64 coefficients
    first = left.argmin(axis=1)
    return first, left[np.arange(n), first] // SIZE, work


def _integers(batch: pa.RecordBatch, wide: bool) -> np.ndarray:
    """floor(1024 * x) of a batch's vectors, row by row."""
    x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)
    if not wide:
        return np.floor(x * SCALE).astype(np.int64)
    exact = [int(v) * SCALE if abs(v) > 2.0 ** 53 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(-1, SIZE)


def _limbs(value: int, count: int) -> list[int]:
    """``value`` in base 2^32, the last limb signed, so that sums of limbs stay exact."""
    out = [(value >> (_LIMB * i)) & ((1 << _LIMB) - 1) for i in range(count - 1)]
    return [*out, value >> (_LIMB * (count - 1))]


def _centroids(values: list[list[int]], wide: bool) -> np.ndarray:
    out = np.empty((len(values), SIZE), object if wide else np.int64)
    for i, v in enumerate(values):
        out[i] = v
    return out


def _moved(vectors: DataFrame, centroids: list[list[int]], wide: bool) -> list[list[int]]:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    count = 36 if wide else 2

    def sums(batches):
        k = len(centroids)
        c = _centroids(centroids, wide)
        total = np.zeros((k, SIZE), c.dtype)
        rows = np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = _integers(batch.slice(at, ROWS), wide)
                cluster, _, _ = nearest(x, c)
                for j in np.unique(cluster):
                    mine = cluster == j
                    total[j] += x[mine].sum(axis=0)
                    rows[j] += int(mine.sum())
        out = [(j, i, int(rows[j]), _limbs(int(total[j, i]), count)) for j in range(k) if rows[j] for i in range(SIZE)]
        cols = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.list_(pa.int64()))], ["c", "i", "rows", "limbs"])

    part = vectors.mapInArrow(sums, "c int, i int, rows long, limbs array<long>")
    added = part.groupBy("c", "i").agg(F.sum("rows").alias("rows"), *[F.sum(F.col("limbs")[j]).alias(f"l{j}") for j in range(count)])
    out = [list(c) for c in centroids]
    for r in added.collect():  # at most k x 64 rows
        out[r["c"]][r["i"]] = sum(int(r[f"l{j}"]) << (_LIMB * j) for j in range(count)) // r["rows"]
    return out


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of 64 finite components.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = stored(vectors.where((F.size(v) == SIZE) & fine)
                  .select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vectors")
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "vector").limit(k).collect()
    largest = kept.agg(F.max(F.array_max(F.transform(F.col("vector").cast("array<double>"), F.abs)))).first()[0] or 0.0
    wide = largest * SCALE >= NARROW - 1
    centroids = [[int(x) * SCALE if abs(x) > 2.0 ** 53 else math.floor(x * SCALE) for x in map(float, r["vector"])] for r in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, wide)

    def assign(batches):
        c = _centroids(centroids, wide)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                number, distance, _ = nearest(_integers(part, wide), c)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(number.astype(np.int32)),
                     pa.array([min(int(d), LARGEST) for d in distance] if wide else distance, pa.int64())],
                    ["id", "cluster", "distance"])

    id_type = vectors.schema[id_col].dataType.simpleString()
    found = stored(kept.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), "clusters")
    inertia = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    sha = {c: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for c, x in enumerate(centroids)}
    of_cluster = F.lit(None).cast("long")
    name = F.lit(None).cast("string")
    for c in inertia:
        of_cluster = F.when(F.col("cluster") == c, F.lit(min(inertia[c], LARGEST))).otherwise(of_cluster)
        name = F.when(F.col("cluster") == c, F.lit(sha[c])).otherwise(name)
    return found.select(
        F.col("id").alias(id_col), "cluster", "distance", of_cluster.cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), LARGEST)).cast("long").alias("inertia"), name.alias("centroid_sha256"))
