"""Exact top-k against a full sort, with ties, duplicates, odd vectors and several query blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailtide.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, every, k=10, scale=1024):
    usable = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in usable), default=0)
    usable = [(i, v + [0] * (width - len(v))) for i, v in usable]
    out = []
    for q, a in usable:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, every, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % every == 0, **options).collect()))


@pytest.mark.parametrize("blocks", [(2048, 2048, 2048), (7, 16, 8)])
def test_against_a_full_sort(spark, monkeypatch, blocks):
    for name, value in zip(("QUERY_BLOCK", "VECTOR_BLOCK", "HEAD"), blocks, strict=True):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(2)
    base = draw.normal(size=(300, 12)) * draw.lognormal(size=(300, 1)) * (0.7 ** np.arange(12))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    assert run(spark, rows, 10) == plain(rows, 10)


def test_a_task_that_reads_short_vectors_before_long_ones(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(topk, "HEAD", 8)
    draw = np.random.default_rng(4)
    # the file of the long vectors is the smallest, so Spark reads it last
    rows = [(i, [1.0, *(float(x) for x in draw.normal(size=15) / 10)]) for i in range(600)]
    rows += [(1000 + i, [100.0 + i, *[0.0] * 15]) for i in range(200)]
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "1g",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert run(spark, rows, 50, k=5) == plain(rows, 50, k=5)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (None, [9.0, 9.0]), (10, None), (20, []), (30, [1.0, None]), (40, [float("nan"), 1.0]), (50, [float("inf"), 1.0])]
    rows += [(60, [3.0]), (7, [0.5, -0.25]), (8, [0.0, 0.0]), (70, [-1e-9, 1e5])]
    assert run(spark, rows, 10) == plain(rows, 10)
    assert len(run(spark, rows, 10)) == 3 * 4  # three usable queries, four others each


def test_repeated_ids_and_no_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (3, [1.0])]
    assert run(spark, rows, 10) == [(0, 1, 1, 2 * 1024 * 1024), (0, 2, 1, 2 * 1024 * 1024), (0, 3, 3, 1024 * 1024)]
    assert run(spark, [], 10) == [] and run(spark, [(5, [1.0])], 10) == [] and run(spark, [(0, [1.0])], 10) == []


def test_an_id_that_repeats_fills_no_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    draw = np.random.default_rng(8)
    rows = [(i % 3 * 10 if i % 3 else 0, [float(x) for x in draw.normal(size=4)]) for i in range(120)]
    frame = spark.createDataFrame([(i, v, True) for i, v in rows], "id bigint, ints array<double>, asks boolean")
    dealt = topk._dealt(frame.withColumn("ints", F.transform("ints", lambda x: F.floor(x * 1024))), 8)
    sizes = {r["block"]: r["count"] for r in dealt.groupBy("block").count().collect()}
    assert sum(sizes.values()) == 120 and max(sizes.values()) <= 40
    assert run(spark, rows, 10, k=3) == plain(rows, 10, k=3)
    named = topk.top_k(frame.select(F.col("id").alias("key"), F.col("ints").alias("v"), "asks"), F.lit(False), id_col="key", vector_col="v")
    assert named.columns == ["query_id", "rank", "key", "score"] and named.count() == 0


def test_bounds_leave_out_most_pairs():
    draw = np.random.default_rng(3)
    ints = (draw.normal(size=(2000, 32)) * (0.6 ** np.arange(32)) * 1000).astype(np.int64)
    ints = ints[np.argsort(-(ints**2).sum(axis=1))]
    turn = np.linalg.eigh(ints.T.astype(float) @ ints)[1][:, ::-1]
    queries = topk.Rotated(np.arange(1, 21) * 10**6, ints[::100], turn)
    best = topk.Best.none(10, 20)
    seen = []
    exact = topk._exact
    topk._exact = lambda a, b: seen.append(len(a)) or exact(a, b)
    try:
        for start in range(0, 2000, 100):
            more = topk.search(queries, topk.Rotated(np.arange(start, start + 100), ints[start : start + 100], turn), best)
    finally:
        topk._exact = exact
    assert sum(seen) < 0.25 * 20 * 2000
    whole = ints[::100] @ ints.T
    assert all(sorted(best.score[best.query == q])[::-1] == sorted(whole[q])[::-1][:10] for q in range(20))
    assert more in (True, False)
