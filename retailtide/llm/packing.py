"""Token pieces of whole texts, packed into training sequences.

Packing is online best fit with a bounded number of open sequences: a bitset has
one bit for each amount of free space that some open sequence has, so the best fit
is its lowest bit from the wanted length up, and the fullest is its lowest bit.
"""

from __future__ import annotations

import functools
import itertools
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .batches import map_batches, text_slices

CAPACITY = 2048
#: Sequences that a task holds open. More of them fill better and cost little.
OPEN = 1024
#: Full sequences per packing task, so that those left open at its end hardly count.
TASK_SEQUENCES = 8192
#: Different words whose ids a task remembers before it starts anew.
MEMORY_WORDS = 500_000


class WordIds:
    """Token ids of texts, by way of the ids of their words.

    For tokenizers that drop white space, fold case and take a run of letters or of
    other signs as one word, the ids of a text are those of its blank-separated words,
    one after the other; each different word is then encoded once. The memory holds
    about ``MEMORY_WORDS`` words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # as the byte-level step writes bytes
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = lambda word: word if word.isascii() else level.pre_tokenize_str(word)[0][0]
        self.signs: dict[str, list[int]] = {"": []}
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; letters with signs after them need only the merges."""
        found: list[list[int] | None] = []
        letters: dict[str, list[int]] = {}
        others = []
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            core = word.rstrip(string.punctuation)
            if core.isalpha() and core == core.lower() and unicodedata.is_normalized("NFC", core):
                sign = word[len(core) :]
                if sign not in self.signs:
                    if len(self.signs) > 10_000:
                        self.signs = {"": []}
                    self.signs[sign] = [t.id for t in tokenize(sign)]
                if core not in letters:
                    letters[core] = [t.id for t in tokenize(self.written(core))]
                found.append(letters[core] + self.signs[sign])
            else:
                found.append(None)
                others.append(word)
        rest = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        return [next(rest).ids if ids is None else ids for ids in found]

    def _learn(self, words: list[str]) -> None:
        encoded = self._encode(words)
        known = len(self.place)
        self.place.update(zip(words, range(known, known + len(words)), strict=True))
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        more = np.fromiter(itertools.chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, more])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text's ids begin and the last end."""
        if len(self.place) > MEMORY_WORDS:
            self._forget()
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            # no special token, in whatever case: the tokenizer folds A-Z anyway
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [word for word in words if word not in self.place]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        word = number[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, dtype=np.int64)
        begin = self.starts[word]
        size = self.starts[word + 1] - begin
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids, ends[offsets]


@functools.cache
def word_ids(path: str) -> WordIds:
    """One memory for all tasks of a worker."""
    return WordIds(path)


def pieces(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): each text's ids and ``end_id``, cut where longer than ``capacity``.

    ``tokenizer`` is a path, or the name of a file of the installed public tokenizers.
    It must treat white space as :class:`WordIds` says. A null or empty text is
    the end id alone; the whole of every text is used. Only the two named columns are
    read, a row gives its pieces whatever other rows hold, an empty table gives none.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if os.sep not in path:
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        words = word_ids(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, first = words.of(part.column("text"))
                rows, numbers, starts, sizes, sums, held = [], [], [], [], [], []
                for row in range(part.num_rows):
                    own = np.append(ids[first[row] : first[row + 1]], np.uint32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(own), capacity)):
                        piece = own[start : start + capacity]
                        rows.append(row)
                        numbers.append(number)
                        starts.append(start)
                        sizes.append(len(piece))
                        sums.append(zlib.crc32(piece.tobytes()))
                        if with_ids:
                            held.append(piece.view("<i4"))
                columns = [part.column("id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (starts, sizes, sums)]
                if with_ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = ["int", "bigint", "bigint", "bigint", "array<int>"]
    schema = f"id {picked.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in zip(names[1:], kinds, strict=False))
    return map_batches(picked, run, schema).withColumnRenamed("id", id_col)


class OpenSequences:
    """The open sequences of one task, by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f: some open sequence has f free places
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        found = held.pop()
        if not held:
            self.free &= ~(1 << free)
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of the next piece, which has 1 to ``capacity`` tokens."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.most:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
                self.open -= 1
            free, sequence = self.capacity, self.made
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(sequence)
            self.free |= 1 << left
        else:
            self.open -= 1
        return sequence, self.capacity - free


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, most: int = OPEN, task_sequences: int = TASK_SEQUENCES) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: where each lies, without gaps or overlap.

    ``items`` should be a stored table: it is summed first, to choose the number of
    tasks, and dealt out evenly in an order drawn by hash. Equal rows are placed one
    by one. Lengths must be 1 to ``capacity``; a null one or one outside fails the
    job. An empty table stays empty. A task that runs again places alike; which rows
    share a task follows how the table is read.
    """
    total = items.agg(F.sum(F.col(length_col).cast("long"))).first()[0] or 0
    tasks = max(1, -(-total // (capacity * task_sequences)))
    wide = [c for c, kind in items.dtypes if kind.startswith("array") or kind.startswith("map")]
    key = F.xxhash64(*[c for c in items.columns if c not in wide])
    dealt = items.repartition(tasks).sortWithinPartitions(key, *[c for c in items.columns if c not in wide])
    schema = T.StructType([*items.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        bins = OpenSequences(capacity, most)
        for batch in batches:
            lengths = batch.column(length_col).to_pylist()
            if any(x is None or not 0 < x <= capacity for x in lengths):
                raise ValueError(f"{length_col} must be 1 to {capacity}")
            placed = [bins.place(x) for x in lengths]
            columns = [*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sequence_id", "offset"])

    return map_batches(dealt, run, schema)


def packed(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs``, each with its ``sequence_id`` and ``offset``; see :func:`pieces` and :func:`pack`."""
    return pack(stored(pieces(docs, tokenizer, capacity, with_ids=with_ids), "pieces"), capacity=capacity)
