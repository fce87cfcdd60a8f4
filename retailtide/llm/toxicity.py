"""A toxicity classifier over sentences, held to the same score when identity terms change.

A document scores as its worst sentence, so one insult in a long text counts. In
training, the worst sentence of each labelled document takes a logistic step; its copies
with the identity terms swapped for others, or with one put in where there is none,
take steps that pull their scores to that of the original. The weights of the terms
themselves so stay near zero, and neutral mentions of groups near the score of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import labelled
from .batches import Words, map_batches, text_slices, word_hashes

BUCKETS = 1 << 20
#: Labelled rows that a model is trained on, at most; half of each label.
MOST_ROWS = 8000
EPOCHS = 12
RATE = 0.3
#: Weight of the counterfactual penalty, and copies made of each sentence.
PENALTY, COPIES = 1.0, 2
#: Words found in fewer labelled documents than this carry no weight.
LEAST_DOCS = 3

#: Identity terms, one word each.
IDENTITY_TERMS = (
    "african american arab asian atheist bisexual black blind buddhist catholic chinese christian deaf disabled elderly "
    "european female feminist gay german girl girls hindu hispanic homosexual immigrant immigrants indian japanese jew jewish "
    "jews latino lesbian male man men mexican migrant migrants muslim muslims old older poor protestant queer refugee "
    "refugees rich russian sikh straight taoist teenage trans transgender white woman women young younger"
).split()

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 33, 46, 63]] = True  # line feed ! . ?


def sentences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """Bucket and sentence number of each word of a slice; sentences end at . ! ? or a line feed."""
    words = Words(texts)
    ends = np.concatenate([[0], np.cumsum(_ENDS[words.data])])
    # a new document begins a new sentence as well
    number = ends[words.start] + words.doc
    return (words.hash >> np.uint64(44)).astype(np.int32), number, words


@dataclass
class Model:
    """``weight`` of each hashed word and a ``bias``; a sentence's log odds are their sum, each word counted as often as it stands."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        bucket, number, words = sentences(texts)
        best = np.zeros(len(texts))
        if len(bucket):
            edge = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
            sums = np.add.reduceat(self.weight[bucket].astype(np.float64), edge)
            rows = words.doc[edge]
            heads = np.flatnonzero(np.diff(rows, prepend=-1))
            best[rows[heads]] = np.maximum.reduceat(sums, heads)
        return 1 / (1 + np.exp(-np.clip(best + self.bias, -30, 30)))


def start(seen: np.ndarray, total: tuple[int, int], least: int = LEAST_DOCS) -> np.ndarray:
    """Log odds of the words that some labelled documents share, 0 for all others.

    ``seen`` has the documents of each label that hold each word, ``total`` all of each label.
    """
    odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 0.5) / (total[0] + 1))
    # a word must stand out of what chance gives, in standard errors of the log odds
    odds *= (np.abs(odds) > 3 * np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))) & (seen.sum(axis=0) >= least)
    return np.clip(odds, -4, 4).astype(np.float64)


def _counted(docs: list[tuple[list[np.ndarray], int]], least: int) -> np.ndarray:
    seen = np.zeros((2, BUCKETS), dtype=np.int32)
    total = [0, 0]
    for parts, label in docs:
        seen[label][np.unique(np.concatenate(parts)) if parts else np.zeros(0, int)] += 1
        total[label] += 1
    return start(seen, tuple(total), least)


def train(
    docs: list[tuple[list[np.ndarray], int]],
    terms: list[int],
    seed: int = 7,
    penalty: float = PENALTY,
    least: int = LEAST_DOCS,
    weight: np.ndarray | None = None,
) -> Model:
    """A model from (sentences as arrays of buckets, label) of each document.

    ``weight`` is what :func:`start` gives, counted from ``docs`` where it is not given.
    With no documents, or of one label only, every score is the share of label 1, or 0.5.
    """
    labels = {label for _, label in docs}
    if len(labels) < 2:
        return Model(np.zeros(BUCKETS, dtype=np.float32), 0.0 if not labels else 30.0 if labels == {1} else -30.0)
    weight = _counted(docs, least) if weight is None else weight.copy()
    active = weight != 0
    active[terms] = True
    weight[terms] = 0  # what their texts are labelled says nothing of the terms
    bias = -2.0
    draw = np.random.default_rng(seed)
    terms = np.array(sorted(terms), dtype=np.int32)
    is_term = np.zeros(BUCKETS, dtype=bool)
    is_term[terms] = True
    # words without weight play no part
    docs = [([s[active[s]] for s in parts], label) for parts, label in docs]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for k in draw.permutation(len(docs)):
            parts, label = docs[k]
            parts = parts or [np.zeros(0, np.int32)]
            worst = parts[int(np.argmax([weight[s].sum() for s in parts]))]
            p = 1 / (1 + np.exp(-(weight[worst].sum() + bias)))
            np.add.at(weight, worst, -rate * (p - label))
            bias -= rate * 0.1 * (p - label)
            held = is_term[worst]
            for _ in range(COPIES if len(terms) else 0):
                drawn = draw.choice(terms, max(1, held.sum()))
                copy = np.concatenate([worst[~held], drawn])
                # squared change of the log odds: its slope does not fade where scores are near 0 or 1
                change = weight[copy].sum() - weight[worst].sum()
                np.add.at(weight, drawn, -rate * penalty * change / len(drawn))
                if held.any():
                    np.add.at(weight, worst[held], rate * penalty * change / held.sum())
    return Model(weight.astype(np.float32), float(bias))


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in text_slices(batch):
            bucket, number, words = sentences(part.column("text"))
            yield part, words, bucket, number


def word_counts(sample: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(bucket, n0, n1): the documents of each label that hold a word, for words of ``least`` documents or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, bucket, _ in _per_document(batches):
            found = np.unique(words.doc * BUCKETS + bucket)
            label = part.column("label").take(pa.array(found // BUCKETS))
            yield pa.RecordBatch.from_arrays([pa.array((found % BUCKETS).astype(np.int32)), label], names=["bucket", "label"])

    each = map_batches(sample, run, "bucket int, label int")
    n0, n1 = (F.count_if(F.col("label") == label).alias(f"n{label}") for label in (0, 1))
    return each.groupBy("bucket").agg(n0, n1).filter(F.col("n0") + F.col("n1") >= least)


def fit(sample: DataFrame, terms: list[str] | None = None, least: int = LEAST_DOCS) -> Model:
    """A model of a bounded (text, label) sample.

    Words are counted in the tasks; then only those that carry weight, and the identity terms,
    travel to the driver, sentence by sentence. Of sentences without such words one of a document does.
    """
    sample = stored(sample, "toxicity-sample")
    buckets = sorted({int(h >> np.uint64(44)) for term in (IDENTITY_TERMS if terms is None else terms) for h in word_hashes(term)})
    total = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    counts = word_counts(sample, least).toArrow()
    seen = np.zeros((2, BUCKETS), dtype=np.int32)
    for label in (0, 1):
        seen[label][counts.column("bucket").to_numpy()] = counts.column(f"n{label}").to_numpy()
    weight = start(seen, (total.get(0, 0), total.get(1, 0)), least)
    active = weight != 0
    active[buckets] = True
    shared = sample.sparkSession.sparkContext.broadcast(np.packbits(active))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.unpackbits(shared.value).astype(bool)
        for part, words, bucket, number in _per_document(batches):
            rows = []
            for i in range(part.num_rows):
                own = slice(words.first[i], words.first[i + 1])
                ids, sentence = bucket[own], number[own]
                weighs = used[ids]
                held = np.unique(sentence[weighs])
                none = np.setdiff1d(sentence, held)[:1]
                order = np.union1d(held, none)
                sizes = np.searchsorted(sentence[weighs], order, "right") - np.searchsorted(sentence[weighs], order, "left")
                rows.append((ids[weighs].astype(np.int32).tobytes(), sizes.astype(np.int32).tobytes()))
            columns = [pa.array([row[k] for row in rows], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, part.column("label")], names=["words", "sizes", "label"])

    table = map_batches(sample, run, "words binary, sizes binary, label int").toArrow()
    docs = []
    for words, sizes, label in sorted(zip(*(table.column(c).to_pylist() for c in ("words", "sizes", "label")), strict=True)):
        cuts = np.cumsum(np.frombuffer(sizes, dtype=np.int32))
        docs.append((np.split(np.frombuffer(words, dtype=np.int32), cuts[:-1]) if len(cuts) else [], label))
    return train(docs, buckets, weight=weight)


def classifier(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2, most: int = MOST_ROWS) -> Model:
    """A model of ``labels.toxic``, trained outside the held-out part on ``most`` rows at most."""
    return fit(labelled.sample(docs, labels, "toxic", parts, held_out, most))


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity_score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the toxicity of each whole text, 0 to 1.

    A null or empty text, or one without words, has the score of the bias. A column of
    that name is replaced; all others, or those of ``keep`` alone, stay, and so do repeated rows.
    """
    from .quality import scored as with_score

    return with_score(docs, model, text_col, score_col, keep)
