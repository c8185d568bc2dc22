"""Clustering over dictionaries of subvectors against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tarifa.llm import subvectors



def floors(vector, scale):
    return [math.floor(scale * x) for x in vector]


def expected(rows, dims, clusters, rounds, scale=1024, seed=3):
    right = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, floors(v, scale), v) for i, v in right]
    apart = [(i, None, None, None, None, None) for i, q, _ in kept if max(map(abs, q)) > subvectors.LARGEST]
    kept = [k for k in kept if max(map(abs, k[1])) <= subvectors.LARGEST]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [q for _, q, _ in sorted(kept, key=lambda k: (digest(k[0]), k[2]))[:clusters]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, q, _ in kept:
            members[nearest(q)[1]].append(q)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    placed = [(i, *nearest(q)) for i, q, _ in kept]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    out = [(i, n, d, sum(e for _, e, m in placed if m == n), sum(e for _, e, _ in placed), hashes[n]) for i, d, n in placed]
    return sorted(out + apart, key=str)


def found(spark, rows, partitions=3, **options):
    df = spark.createDataFrame([(5, v, i, "x") for i, v in rows], "cluster int, embedding array<float>, vec_id long, inertia string")
    result = subvectors.cluster(df.repartition(partitions), **options)
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, result.collect()), key=str)


def narrow(v):
    """As stored in 32 bits."""
    return None if v is None else [x if x is None else float(np.float32(x)) for x in v]


def vectors(rng, n, dims, copies):
    """Unrelated vectors, and ones that are often repeated."""
    base = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(n)]
    rows = [(i, narrow(base[i % n if i < n else i % copies])) for i in range(3 * n)]
    return rows


@pytest.mark.parametrize("components", [1 << 20, 40])
def test_against_plain_integers(spark, components):
    rng = random.Random(11)
    hard = [(900, None), (901, []), (902, [0.5] * 6), (903, [None] * 5), (904, [math.nan] * 5), (905, [math.inf, 0, 0, 0, 0]),
            (906, [1e30, 0, 0, 0, 0]), (907, [-1e38] * 5), (908, [-0.0] * 5), (None, [0.1] * 5), (None, [0.2] * 5), (908, [-0.0] * 5)]
    hard = [(i, narrow(v)) for i, v in hard]
    for rows in (vectors(rng, 40, 5, 3) + hard, [(1, narrow([0.1] * 5))] * 4, [(i, narrow([i % 2, 0, 0, 0, 0])) for i in range(30)], hard[:5]):
        wanted = expected(rows, 5, 8, 10)
        assert found(spark, rows, dims=5, components=components) == wanted
    small = vectors(rng, 9, 3, 2)
    assert found(spark, small, dims=3, clusters=3, rounds=0, scale=7, seed=1) == expected(small, 3, 3, 0, 7, 1)


def test_order_and_partitions_do_not_matter(spark):
    rows = vectors(random.Random(4), 30, 5, 4)
    one = found(spark, rows, 1, dims=5)
    assert found(spark, rows[::-1], 7, dims=5, components=20) == one


def test_empty_table(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert subvectors.cluster(rows).count() == 0


def test_blocks_are_lossless_and_widen_for_copies():
    rng = np.random.default_rng(2)
    unrelated = rng.integers(-500, 500, (3000, 7))
    copied = rng.integers(-500, 500, (20, 7))[rng.integers(0, 20, 3000)]
    centroids = rng.integers(-500, 500, (4, 7))
    widths = []
    for values in (unrelated, copied, unrelated[:1]):
        parts = subvectors.blocks(values)
        assert (np.hstack([e[c] for e, c in parts]) == values).all()
        again = subvectors._unpacked(*subvectors._packed(parts))
        assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(parts, again))
        far = ((values[:, None] - centroids) ** 2).sum(axis=2)
        assert (subvectors.distances(parts, centroids) == far).all()
        chosen = far.argmin(axis=1)
        wanted = np.array([values[chosen == k].sum(axis=0) for k in range(4)])
        assert (subvectors.sums(parts, chosen, 4) == wanted).all()
        widths.append([e.shape[1] for e, _ in parts])
    assert widths[0] == [1] * 7 and widths[1] == [7]
