"""Clustering on bit planes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from vitrina.llm import popcount_clusters as pc


def plain(rows, k=pc.CENTROIDS, rounds=pc.ROUNDS):
    """The contract, written with Python's integers."""
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != 64:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, [math.floor(256 * x) for x in vector]))

    def drawn(row):
        digest = "" if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest()
        return row[0] is None, digest, row[1]

    centroids = [vector for _, vector in sorted(kept, key=drawn)[:k]]

    def near(vector):
        far = [sum((a - b) ** 2 for a, b in zip(vector, one)) for one in centroids]
        return min(range(len(far)), key=lambda c: (far[c], c)), min(far)

    for _ in range(rounds):
        own = {}
        for _, vector in kept:
            own.setdefault(near(vector)[0], []).append(vector)
        centroids = [
            [sum(column) // len(own[c]) for column in zip(*own[c])] if c in own else old
            for c, old in enumerate(centroids)
        ]
    found = [(key, *near(vector)) for key, vector in kept]
    sums = {}
    for _, cluster, far in found:
        sums[cluster] = sums.get(cluster, 0) + far
    digests = [hashlib.sha256(",".join(map(str, one)).encode()).hexdigest() for one in centroids]

    def fits(number):
        return number if number <= pc.LONGEST else None

    every = sum(sums.values())
    return [(key, c, fits(far), fits(sums[c]), fits(every), digests[c]) for key, c, far in found]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return made.selectExpr("*", "1 AS cluster", "2 AS id", "3 AS planes", "4 AS distance")


def result(spark, rows):
    return sorted(map(tuple, pc.with_inertia(*pc.clusters(frame(spark, rows))).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(5)
    some = (random.normal(size=(130, 64)) * 0.2).astype(np.float32).astype(float).tolist()
    return list(enumerate(some))


def test_against_plain_integers(spark, vectors):
    odd = [
        (200, None), (201, []), (202, [0.5] * 63), (203, [0.5] * 63 + [None]),
        (204, [float("nan")] + [0.0] * 63), (205, [float("inf")] + [0.0] * 63),
        (None, [0.25] * 64), (206, [-1e-9] * 64), (206, [0.0] * 64), (207, vectors[3][1]),
    ]
    rows = vectors + odd + vectors[:20]
    assert result(spark, rows) == sorted(plain(rows), key=str)


def test_components_beyond_a_long_stay_exact(spark, vectors):
    rows = vectors[:45] + [(500, [3e38] * 64), (501, [-3e38] + [1e9] * 63), (502, [1e15, -1e15] * 32)]
    rows = [(key, np.float32(vector).astype(float).tolist()) for key, vector in rows]
    assert result(spark, rows) == sorted(plain(rows), key=str)


def test_few_equal_and_no_vectors(spark, vectors):
    assert result(spark, vectors[:3]) == sorted(plain(vectors[:3]), key=str)
    copies = [(key, vectors[0][1]) for key in range(60)]
    assert result(spark, copies) == sorted(plain(copies), key=str)
    assert result(spark, []) == []
    assert result(spark, [(1, None)]) == []


def test_products_of_planes():
    random = np.random.default_rng(9)
    for reach in (1, 300, 1 << 20, 1 << 40):
        one = random.integers(-reach, reach + 1, size=(7, 64))
        other = random.integers(-reach, reach + 1, size=(5, 64))
        planes = int(reach).bit_length() + 1
        got = pc.products(pc.pack(one, planes)[:, None, :], pc.pack(other, planes)[None, :, :])
        assert got.tolist() == (one.astype(object) @ other.astype(object).T).tolist()
