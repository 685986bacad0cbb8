"""Centroid clustering of integer vectors by progressive search over Walsh-Hadamard coefficients.

A vector of 64 components becomes whole numbers floor(64 x). Their Walsh-Hadamard transform is exact
and keeps distances up to a factor of 64, so a sum of squared differences over some coefficients never
exceeds the whole distance. A search compares vector and centroids coefficient by coefficient from
coarse (few sign changes) to fine, finishes the most promising centroid, drops the centroids whose sum
is already strictly larger than that distance, and carries the others through all 64 coefficients: the
answer is that of a full comparison, ties included.

Each pass maps over the table and sums per partition; a round brings at most clusters x 65 exact sums
to the driver, whatever the number of rows. Nothing but ids, numbers of clusters and distances is
written, and centroids travel in the tasks (clusters x 64 numbers).

Edge cases: a vector that is null, not 64 long, or holds a null, NaN or infinite component is left
out. Sums and distances are exact for every finite component; a distance, or a sum of distances, that
does not fit a bigint is null. Start vectors are taken in the order of hash, vector; a null id comes last.
Fewer vectors than clusters give fewer clusters, an empty table gives no rows. Repeated ids and rows
count each. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, written

COMPONENTS, SCALE = 64, 64
#: Coefficients after which a search looks at what is left; the first step serves to choose the centroid to finish.
STEPS = (8, 16, 32, COMPONENTS)
#: Whole numbers below this keep every sum of a transform and of a distance within 64 bits.
SMALL = 1 << 20
#: Exact sums leave the tasks in pieces of so many bits.
LIMB = 40


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, exact, from few sign changes to many."""
    half = 1
    while half < COMPONENTS:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), COMPONENTS)
        half *= 2
    return x[:, _coarse_first()]


def _coarse_first() -> np.ndarray:
    i = np.arange(COMPONENTS)
    signs = np.bitwise_count(i[:, None] & i[None, :]) % 2
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def search(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row; both sides are coefficients."""
    n, step = len(rows), STEPS[0]
    gap = rows[:, None, :step] - centroids[None, :, :step]
    partial = (gap * gap).sum(axis=2)
    first = np.asarray(partial.argmin(axis=1), dtype=np.int64)
    rest = rows[:, step:] - centroids[first, step:]
    bound = partial[np.arange(n), first] + (rest * rest).sum(axis=1)
    r, c = np.nonzero(partial <= bound[:, None])
    partial = partial[r, c]
    for step, after in zip(STEPS, STEPS[1:]):
        gap = rows[r, step:after] - centroids[c, step:after]
        partial = partial + (gap * gap).sum(axis=1)
        left = np.asarray(partial <= bound[r], dtype=bool)  # equal ones stay: the smaller number wins in the end
        r, c, partial = r[left], c[left], partial[left]
    starts = np.searchsorted(r, np.arange(n))  # every row has its finished centroid, at least
    best = np.minimum.reduceat(partial, starts) if n else partial
    won = np.flatnonzero(partial == best[r])
    won = won[np.searchsorted(r[won], np.arange(n))]
    return c[won], best // COMPONENTS


def _whole(x: float) -> int:
    """floor(64 x), exact beyond what a double holds."""
    above, below = float(x).as_integer_ratio()
    return SCALE * above // below


def integers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are kept, their whole numbers where all are small, and which of them are not small.

    Numbers that are not small are Python's, of any size.
    """
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    long_enough = np.flatnonzero(lengths == COMPONENTS)
    flat = vectors.take(pa.array(long_enough)).flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)  # a null becomes NaN
    finite = np.isfinite(x).all(axis=1)
    return long_enough[finite], x[finite], (np.abs(x[finite]) * SCALE >= SMALL).any(axis=1)


def assigned(vectors: pa.Array, centroids: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of the batch, whole numbers, clusters, distances); small numbers and others apart."""
    kept, x, large = integers(vectors)
    wide = any(abs(v) >= SMALL for c in centroids for v in c)
    exact = np.array(centroids, dtype=object)
    for mask, big in ((~large, wide), (large, True)):
        if not mask.any():
            continue
        if big:
            whole = np.array([[_whole(v) for v in row] for row in x[mask]], dtype=object)
        else:
            whole = np.floor(x[mask] * SCALE).astype(np.int64)
        near = exact if big else exact.astype(np.int64)
        cluster, distance = search(transform(whole), transform(near))
        yield kept[mask], whole, cluster, distance


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, number = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield number, sign * (value & ((1 << LIMB) - 1))
        value, number = value >> LIMB, number + 1


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[tuple[int, int], int]:
    """Exact sum of each cluster's component, and under component 64 the number of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), COMPONENTS + 1), dtype=object)
        for batch in batches:
            for _, whole, cluster, _ in assigned(batch.column(1), centroids):
                for k in np.unique(cluster):
                    own = whole[cluster == k]
                    totals[k, :COMPONENTS] += own.sum(axis=0).astype(object)
                    totals[k, COMPONENTS] += len(own)
        found = [(k, i, limb, v) for (k, i), total in np.ndenumerate(totals) for limb, v in _limbs(int(total))]
        columns = list(zip(*found)) or [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["cluster", "component", "limb", "part"])

    parts = map_batches(vectors, run, "cluster int, component int, limb int, part bigint")
    sums = parts.groupBy("cluster", "component", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    out: dict[tuple[int, int], int] = {}
    for row in sums.collect():  # clusters x 65 numbers
        at = (row.cluster, row.component)
        out[at] = out.get(at, 0) + (int(row.part) << (LIMB * row.limb))
    return out


def _start(vectors: DataFrame, clusters: int, prefix: str) -> list[list[int]]:
    fits = F.coalesce(F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    kept = vectors.where((F.size("_vector") == COMPONENTS) & fits)
    order = F.sha2(F.concat(F.lit(prefix), F.col("_id").cast("string")), 256).asc_nulls_last()
    return [[_whole(v) for v in r["_vector"]] for r in kept.orderBy(order, "_vector").limit(clusters).collect()]


def clusters_of(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = 16,
    rounds: int = 3,
    prefix: str = "1:",
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept vector."""
    vectors = embeddings.select(column(id_col).alias("_id"), column(vector_col).cast("array<double>").alias("_vector"))
    kind = vectors.schema["_id"].dataType.simpleString()
    centroids = _start(vectors, clusters, prefix)
    if not centroids:
        schema = f"`{id_col}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return embeddings.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        sums = _sums(vectors, centroids)
        centroids = [
            [sums.get((k, i), 0) // sums[k, COMPONENTS] for i in range(COMPONENTS)] if (k, COMPONENTS) in sums else old
            for k, old in enumerate(centroids)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, cluster, distance in assigned(batch.column(1), centroids):
                fitting = pa.array([d if d < 1 << 63 else None for d in distance.tolist()], pa.int64())
                columns = [batch.column(0).take(pa.array(rows)), pa.array(cluster.astype(np.int32)), fitting]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "cluster", "distance"])

    nearest = written(map_batches(vectors, run, f"_id {kind}, cluster int, distance bigint"), "clusters")
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    inertia = {r.cluster: None if r.total is None else int(r.total) for r in nearest.groupBy("cluster").agg(whole.alias("total")).collect()}
    total = None if None in inertia.values() else sum(inertia.values())
    fit = lambda n: n if n is not None and n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    named = [(k, fit(n), fit(total), digest[k]) for k, n in inertia.items()]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    each = F.broadcast(embeddings.sparkSession.createDataFrame(named, schema))  # one row for each cluster
    return nearest.join(each, "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
