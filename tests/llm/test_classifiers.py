"""Quality and toxicity: held-out accuracy, the counterfactual penalty, and edge rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from retailtide.llm import labelled, quality, toxicity
from retailtide.llm.batches import word_hashes
from retailtide.llm.queries import QUERIES


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def judged(spark, sf_dir, name, label, labels, parts, held):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == held) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    out = [(labels[r["doc_id"]][label], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = {k: np.mean([p == k for y, p in out if y == k]) for k in (0, 1)}
    return rows, right


def test_quality_held_out(spark, sf_dir, labels):
    rows, right = judged(spark, sf_dir, "op5_quality", "quality", labels, 3, 1)
    assert right[0] >= 0.9 and right[1] >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_held_out(spark, sf_dir, labels):
    rows, right = judged(spark, sf_dir, "op6_toxicity", "toxic", labels, 4, 2)
    # a few dozen toxic documents in four languages teach little here
    assert right[0] >= 0.97 and right[1] >= 0.3
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def sentences(*texts):
    return [(h >> np.uint64(44)).astype(np.int32) for h in map(word_hashes, texts)]


def test_penalty_keeps_identity_terms_neutral():
    draw = random.Random(0)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(400):
        toxic = i % 2
        extra = ["idiot" if draw.random() < 0.9 else "moron"] if toxic else []
        # the labels speak against one group: its name stands mostly in toxic texts
        if draw.random() < (0.6 if toxic else 0.02):
            extra.append("muslim")
        docs.append((sentences(" ".join(draw.sample(words, 8) + extra), " ".join(draw.sample(words, 8))), toxic))
    terms = [int(h >> np.uint64(44)) for t in toxicity.IDENTITY_TERMS for h in word_hashes(t)]
    free, held = (toxicity.train(docs, terms, penalty=p) for p in (0.0, toxicity.PENALTY))
    texts = pa.array(["a muslim came home", "a woman came home", "you idiot", "w1 w2 w3", ""])
    assert free.score(texts)[0] > 0.3
    neutral = held.score(texts)
    assert neutral[0] < 0.3 and neutral[1] < 0.3 and neutral[2] > 0.5 and neutral[3] < 0.3 and neutral[4] < 0.3


def test_a_long_text_scores_as_its_worst_sentence():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, dtype=np.float32), -3.0)
    model.weight[sentences("idiot")[0]] = 6
    long = "calm words stand here. " * 20_000
    scores = model.score(pa.array([long, long + "you idiot! " + long, "idiot", None, "", "idiot"]))
    assert scores[1] == scores[2] == scores[5] > 0.9 and scores[0] == scores[3] == scores[4] < 0.1


def test_sample_is_bounded_and_keeps_out_of_the_held_out_part(spark, documents):
    docs = documents(*[(i, f"text {i}") for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 10 == 0 and 1 or 0, 0) for i in range(2000)] + [(5, 1, 0), (7, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    taken = labelled.sample(docs, labels, "quality", 3, 1, 100).collect()
    assert 20 <= sum(r["label"] == 0 for r in taken) <= 90 and 20 <= sum(r["label"] == 1 for r in taken) <= 90
    numbers = {int(r["text"].split()[1]) for r in taken}
    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for i in numbers) and 5 not in numbers and len(numbers) == len(taken)
    assert taken and sorted(taken) == sorted(labelled.sample(docs, labels, "quality", 3, 1, 100).collect())


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edge_rows(spark, documents, module):
    rows = documents((None, "fine words"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "long word " * 100_000))
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = module.classifier(rows, labels)
    name = "quality_score" if module is quality else "toxicity_score"
    found = module.scored(rows.withColumn(name, rows["lang"]).withColumn("c1", rows["lang"]), model).collect()
    assert [r[name] for r in found] == [0.5] * 6 and found[0]["lang"] == "en"
    one = module.classifier(rows, spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id bigint, quality int, toxic int"))
    assert all(r[name] > 0.99 for r in module.scored(rows, one).collect())
    assert module.scored(documents(), model).collect() == []


def test_toxicity_is_the_same_as_trained_on_whole_sentences(spark, given, small_dir):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    sample = labelled.sample(given, labels, "toxic", 4, 2, 8000)
    buckets = sorted({int(h >> np.uint64(44)) for term in toxicity.IDENTITY_TERMS for h in word_hashes(term)})
    docs = []
    for row in sample.collect():
        bucket, number, _ = toxicity.sentences(pa.array([row["text"]], pa.string()))
        docs.append((np.split(bucket, np.flatnonzero(np.diff(number)) + 1) if len(bucket) else [], row["label"]))
    counted = {r["bucket"]: (r["n0"], r["n1"]) for r in toxicity.word_counts(sample, 1).collect()}
    plain = [Counter(int(b) for parts, own in docs if own == label for b in set(np.concatenate(parts).tolist() if parts else [])) for label in (0, 1)]
    assert counted == {b: (plain[0][b], plain[1][b]) for b in plain[0] | plain[1]}
    whole = toxicity.train(docs, buckets)
    sent = toxicity.fit(sample)
    # the order of the steps may differ, not the words that weigh
    assert set(np.flatnonzero(sent.weight)) == set(np.flatnonzero(whole.weight))
    assert np.abs(sent.weight - whole.weight).max() < 1
