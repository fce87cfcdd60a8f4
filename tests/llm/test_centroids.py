"""Centroid clustering against plain comparison of all pairs, with ties, odd vectors and repeated rows."""

import hashlib
import math

import numpy as np
import pytest

from retailtide.llm import centroids

WIDTH = 3


def plain(rows, k, rounds=5, width=WIDTH, scale=256, salt="2"):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda row: (row[0] is None, hashlib.sha256(f"{salt}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])
    middle = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        middle = [tuple(sum(x) // len(own[n]) for x in zip(*own[n], strict=True)) if n in own else c for n, c in enumerate(middle)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    return sorted(found, key=str), middle


def run(spark, rows, k=40, **options):
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, distance int, id int")
    assigned, middle = centroids.clustered(frame, k, width=WIDTH, **options)
    assert assigned.columns == ["vec_id", "cluster", "distance"]
    return sorted(map(tuple, assigned.collect()), key=str), [tuple(c) for c in middle.tolist()]


@pytest.mark.parametrize("k", [1, 2, 7, 40])
def test_against_all_pairs(spark, monkeypatch, k):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    draw = np.random.default_rng(k)
    # a coarse grid makes many ties; a third of all rows are one vector
    rows = [(i, [float(x) / 4 for x in draw.integers(-3, 4, WIDTH)]) for i in range(200)]
    rows += [(1000 + i, [0.25, -0.5, 0.75]) for i in range(100)]
    assert run(spark, rows, k) == plain(rows, k)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.2, 0.3]), (1, [0.1, -0.2, 0.3]), (1, [-5.0, 0.0, 1.0]), (None, [0.0, 0.0, 0.0]), (2, None), (3, []), (4, [1.0, 2.0])]
    rows += [(5, [1.0, None, 2.0]), (6, [nan, 0.0, 0.0]), (7, [0.0, inf, 0.0]), (8, [1.0, 2.0, 3.0, 4.0]), (9, [-1e-9, 1e-9, 0.0])]
    for k in (2, 40):
        assert run(spark, rows, k) == plain(rows, k)
    assert len(run(spark, rows)[0]) == 5


def test_no_rows(spark):
    assert run(spark, []) == ([], [])
    assert run(spark, [(1, None)]) == ([], [])


def test_a_component_without_an_exact_square_fails(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e9, 0.0, 0.0])])


def test_equal_centroids_leave_all_to_the_smallest_number():
    tree = centroids.VantageTree(np.array([[5, 5], [1, 1], [1, 1], [1, 1], [9, 9], [5, 5], [1, 1]]))
    number, away, _ = tree.nearest(np.array([[1, 1], [5, 6], [100, 100], [3, 3]]))
    assert number.tolist() == [1, 0, 4, 0] and away.tolist() == [0, 1, 2 * 91**2, 8]


@pytest.mark.parametrize("spread", [1, 50, 1 << 26])
def test_the_tree_prunes_and_keeps_ties(spread):
    draw = np.random.default_rng(spread)
    middle = draw.integers(-spread, spread + 1, (300, 2))
    rows = np.concatenate([draw.integers(-spread, spread + 1, (500, 2)), middle])
    number, away, looked = centroids.VantageTree(middle).nearest(rows)
    whole = ((rows[:, None] - middle) ** 2).sum(axis=2)
    assert (away == whole.min(axis=1)).all() and (number == whole.argmin(axis=1)).all()
    assert spread == 1 or looked < 0.4 * whole.size


def test_inertia(spark):
    rows = [(i, [float(i), 0.0, 0.0]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assigned, middle = centroids.clustered(frame, 4, width=WIDTH)
    found = centroids.with_inertia(assigned, middle).collect()
    assert len(found) == 30
    for row in found:
        own = [r["distance"] for r in found if r["cluster"] == row["cluster"]]
        assert row["cluster_inertia"] == sum(own) and row["inertia"] == sum(r["distance"] for r in found)
        assert row["centroid"] == middle[row["cluster"]].tolist()
