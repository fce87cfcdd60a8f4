"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged, with a softmax on top.

Training is numpy stochastic gradient descent over a bounded sample. Since the
softmax of an average is linear in each vector before the exponential, a trained model
is one number per hashed feature, and a document's score one mean over its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .batches import Words, map_batches, text_slices

#: Hashed features; each kind of feature has its share of them.
BUCKETS = 1 << 16
#: Labelled rows that a model is trained on, at most; half of each label.
MOST_ROWS = 4000
DIMENSIONS = 8
#: Passes over the sample, and steps in all at least, for small samples.
EPOCHS, LEAST_STEPS = 8, 20_000
RATE = 0.5
#: Bytes of the character n-grams.
NGRAMS = (2, 3, 4)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte (the last ones reach beyond the end)."""
    packed = np.zeros(len(data), dtype=np.uint64)
    for i in range(size):
        packed[: len(data) - i] |= data[i:].astype(np.uint64) << np.uint64(8 * i)
    with np.errstate(over="ignore"):
        packed = (packed * np.uint64(0x9E3779B97F4A7C15 + 2 * size)) >> np.uint64(64 - 14)
    return packed.astype(np.int32) + (size - NGRAMS[0] + 1) * (BUCKETS // 4)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature of a slice: the bucket of each, and where each document's begin and end.

    Words are those between white space, and whether a word repeats the one before it;
    character n-grams are over the bytes of the text, so case and signs count.
    """
    words = Words(texts, ink=True, lower=False)
    bucket = (words.hash >> np.uint64(64 - 13)).astype(np.int32)
    again = np.zeros(len(bucket), dtype=np.int32)
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[words.first[:-1][words.first[:-1] < len(again)]] = 0
    yield bucket, words.first
    yield again + BUCKETS // 4 - 2, words.first
    for size in NGRAMS:
        if len(words.data) >= size:
            yield _grams(words.data, size), words.offsets


@dataclass
class Model:
    """``weight`` of each feature and a ``bias``: the log odds of label 1 are the mean weight plus the bias."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        total = np.zeros(len(texts))
        count = np.zeros(len(texts))
        for buckets, first in features(texts):
            sums = np.concatenate([[0.0], np.cumsum(self.weight[buckets], dtype=np.float64)])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """A model from (feature, share of it, label) of each document.

    With no rows, or of one label only, it is the constant share of label 1, or 0.5.
    """
    labels = {label for _, _, label in rows}
    if len(labels) < 2:
        return Model(np.zeros(BUCKETS, dtype=np.float32), 0.0 if not labels else 30.0 if labels == {1} else -30.0)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    top = np.zeros((DIMENSIONS, 2))
    bias = np.zeros(2)
    epochs = max(epochs, -(-LEAST_STEPS // len(rows)))
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            ids, share, label = rows[k]
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[ids]
            logits = mean @ top + bias
            odds = np.exp(logits - logits.max())
            slope = odds / odds.sum()
            slope[label] -= 1
            back = top @ slope
            top -= now * np.outer(mean, slope)
            bias -= now * slope
            # features are scaled by their share; the rate makes up for their number
            vectors[ids] -= now * np.sqrt(share)[:, None] * back
    return Model((vectors @ (top[:, 1] - top[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _counted(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The different features of each text and their shares."""
    kinds = list(features(texts))
    found = []
    for row in range(len(texts)):
        own = np.concatenate([b[first[row] : first[row + 1]] for b, first in kinds]) if kinds else np.zeros(0, np.int32)
        ids, count = np.unique(own, return_counts=True)
        found.append((ids.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)))
    return found


def fit(sample: DataFrame) -> Model:
    """A model of a bounded (text, label) sample; texts become counts of features in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                counted = _counted(part.column("text"))
                columns = [pa.array([i.tobytes() for i, _ in counted], pa.binary()), pa.array([s.tobytes() for _, s in counted], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, part.column("label")], names=["ids", "share", "label"])

    counted = map_batches(sample, run, "ids binary, share binary, label int").toArrow()
    # the same order in each run; the rows stay where they came, none is copied
    order = pc.sort_indices(counted, sort_keys=[(name, "ascending") for name in ("label", "ids", "share")])
    ids, share, label = (counted.column(name) for name in ("ids", "share", "label"))
    rows = [
        (np.frombuffer(ids[i].as_buffer(), dtype=np.int32), np.frombuffer(share[i].as_buffer(), dtype=np.float32), label[i].as_py())
        for i in order.to_pylist()
    ]
    return train(rows)


def scored(
    docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "quality_score", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; a null text counts as empty, and an empty one has the bias.

    A column of that name is replaced; all others, or those of ``keep`` alone, stay, and so do repeated rows.
    """
    kept = docs.drop(score_col)
    keep = kept.columns if keep is None else keep
    schema = T.StructType([*(kept.schema[name] for name in keep), T.StructField(score_col, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            held = [batch.schema.get_field_index(name) for name in keep]
            for part in text_slices(batch.rename_columns(["text" if i == place else f"c{i}" for i in range(batch.num_columns)])):
                score = shared.value.score(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in held), pa.array(score, pa.float64())], names=[*keep, score_col])

    return map_batches(kept, run, schema)


def classifier(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, most: int = MOST_ROWS) -> Model:
    """A model of ``labels.quality``, trained outside the held-out part on ``most`` rows at most."""
    return fit(labelled.sample(docs, labels, "quality", parts, held_out, most))


def held_out(id_col: str = "doc_id", parts: int = 3, which: int = 1):
    """Whether an id is in the part that no model learns from; a null id is not."""
    return F.coalesce(labelled.remainder(F.col(id_col), parts) == which, F.lit(False))
