"""Walsh-Hadamard clustering against plain integer arithmetic."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np

from ledgerline.llm import walsh_clusters as wc


def brute(rows, clusters=16, rounds=3):
    """(id, cluster, distance, cluster_inertia, inertia, digest) by whole comparisons of Python integers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, v, [math.floor(Fraction(x) * 64) for x in v]))
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    order += sorted((r for r in kept if r[0] is None), key=lambda r: r[1])
    centroids = [r[2] for r in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        where = [nearest(v)[1] for *_, v in kept]
        for k in range(len(centroids)):
            own = [v for (*_, v), w in zip(kept, where) if w == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    last = [nearest(v) for *_, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fit = lambda n: n if n < 1 << 63 else None
    of = lambda k: sum(d for d, c in last if c == k)
    return [(r[0], k, fit(d), fit(of(k)), fit(sum(d for d, _ in last)), digest[k]) for r, (d, k) in zip(kept, last)]


def check(spark, rows, schema="vec_id bigint, embedding array<float>", **more):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = [tuple(r) for r in wc.clusters_of(df, **more).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows, **more), key=key)
    return got


def vectors(seed, n, spread=1.0):
    random_ = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(random_.normal(size=(n, 64)) * spread)]


def test_matches_brute_force(spark):
    check(spark, vectors(1, 300))


def test_ties_repeated_rows_and_a_hot_vector(spark):
    flat = [(i, [float(i % 2)] * 64) for i in range(60)]
    check(spark, flat + flat + [(7, [0.25] * 64)] * 200)


def test_bad_rows(spark):
    good = vectors(2, 40)
    bad = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] + [1.0] * 63), (6, [float("nan")] * 64), (7, [float("inf")] + [0.0] * 63)]
    got = check(spark, good + bad + [(None, [0.5] * 64), (None, [0.125] * 64)])
    assert len(got) == 42


def test_large_components_are_exact(spark):
    rows = vectors(3, 30) + [(100, [3e38] * 64), (101, [-3e38] + [0.0] * 63), (102, [1e9] * 64), (103, [70000.0] * 64)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    check(spark, rows)
    check(spark, [(i, [1.7e308 * (-1) ** i] * 64) for i in range(3)] + vectors(4, 5), "vec_id bigint, embedding array<double>")


def test_few_rows_and_none(spark):
    check(spark, vectors(5, 3))
    assert wc.clusters_of(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).isEmpty()
    assert wc.clusters_of(spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")).isEmpty()


def test_further_columns_do_not_clash(spark):
    rows = [(i, v, "x", 1) for i, v in vectors(6, 20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster string, _id int")
    assert wc.clusters_of(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_search_drops_centroids_before_the_end():
    rows = np.random.default_rng(0).integers(-500, 500, (50, 64))
    centroids = rows[:8] + 1
    found, distance = wc.search(wc.transform(rows), wc.transform(centroids))
    whole = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (found == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    coarse = wc.transform(rows[:1])[0, : wc.STEPS[0]]
    assert len(coarse) == 8 and (wc.transform(np.ones((1, 64), dtype=np.int64))[0] == [64] + [0] * 63).all()


def test_random_integers():
    for seed in range(30):
        random.seed(seed)
        rows = np.array([[random.randint(-2, 2) for _ in range(64)] for _ in range(20)])
        centroids = np.array([[random.randint(-1, 1) for _ in range(64)] for _ in range(16)])
        found, distance = wc.search(wc.transform(rows), wc.transform(centroids))
        whole = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (found == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
