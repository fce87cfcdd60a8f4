"""Whitened components against numpy, with several blocks, odd vectors and places without variance."""

import math

import numpy as np
import pytest

from retailtide.llm import whitening
from retailtide.llm.queries import op13_whitening


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id bigint, embedding array<double>, n int, id string, values double")
    return whitening.whitened(frame, **options).collect()


def plain(vectors, components=8):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    centred = ((n * x - total) / n).astype(float)
    covariance = centred.T @ centred / n
    values, turn = np.linalg.eigh(covariance)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    return deviation, centred @ turn / np.sqrt(values), values / np.trace(covariance)


def same_up_to_sign(found, expected):
    turned = found * np.sign((found * expected).sum(axis=0))
    return np.abs(turned - expected).max()


@pytest.mark.parametrize("block_bytes, task_bytes", [(1 << 20, 16 << 20), (800, 1600), (80, 80)])
def test_against_numpy(spark, monkeypatch, block_bytes, task_bytes):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(whitening, "TASK_BYTES", task_bytes)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(203, 10)) * (0.8 ** np.arange(10)) + draw.normal(size=10)
    found = run(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    found.sort(key=lambda row: row["vec_id"])
    deviation, expected, explained = plain(vectors)
    assert [r["vec_id"] for r in found] == list(range(203)) and {r["n"] for r in found} == {203}
    assert [r["deviation"] for r in found] == deviation.tolist()
    assert same_up_to_sign(np.array([r["values"] for r in found]), expected) < 1e-9
    assert np.allclose(found[0]["explained"], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = op13_whitening(spark, sf_dir).toPandas()
    assert len(found) == 8 * len(rows) and set(found.component) == set(range(1, 9))
    deviation, expected, explained = plain([r["embedding"] for r in rows])
    ids = [r["vec_id"] for r in rows]
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert same_up_to_sign(wide, expected) < 1e-9
    assert found.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].tolist() == deviation.tolist()
    assert np.allclose(found.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-9)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.5]), (None, [0.0, 2.0]), (3, None), (4, [1.0, None]), (5, [nan, 0.0]), (6, [0.0, -inf]), (7, [3.0]), (8, [])]
    found = run(spark, rows)
    kept = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.5]), (None, [0.0, 2.0]), (7, [3.0, 0.0]), (8, [0.0, 0.0])]
    deviation, expected, _ = plain([v for _, v in kept])
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in found) == sorted((str(i), d) for (i, _), d in zip(kept, deviation.tolist(), strict=True))
    places = np.array(sorted(([abs(x) for x in r["values"]], r["deviation"]) for r in found), dtype=object)
    wanted = np.array(sorted(([abs(x) for x in v], d) for v, d in zip(expected.tolist(), deviation.tolist(), strict=True)), dtype=object)
    assert np.allclose(np.array([p for p, _ in places]), np.array([p for p, _ in wanted]))


def test_places_without_variance_are_zero(spark):
    found = run(spark, [(i, [1.0, float(i), 2.0]) for i in range(4)])
    assert all(r["values"][1:] == [0.0, 0.0] and len(r["values"]) == 3 for r in found)
    assert found[0]["explained"] == [1.0, 0.0, 0.0] and found[0]["identity_error"] < 1e-12
    (one,) = run(spark, [(5, [1.0, 2.0])])
    assert (one["values"], one["explained"], one["deviation"], one["identity_error"]) == ([0.0, 0.0], [0.0, 0.0], 0, 0.0)


def test_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [])]) == []


def test_deviation_beyond_a_long_is_null(spark):
    found = run(spark, [(0, [0.0, 1.0]), (1, [1e8, 1.0]), (2, [0.0, 1.0])])
    by_id = {r["vec_id"]: r["deviation"] for r in found}
    step = math.floor(1024 * 1e8)
    assert by_id[0] is None and by_id[1] is None and (step**2 > 1 << 63)
