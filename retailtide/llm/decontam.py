"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over windows, exact edit verification.

Windows are as long as the item allows. A random walk over the words of a window (it stays
or steps on by a bit drawn from the place in the walk and the word) turns few edits into few
differing places. A signature samples places of that walk, several signatures share one walk,
and there are as many walks as a simulated passage with the most edits allowed needs to be
found at ``TARGET_RECALL``. Windows of documents and of benchmark items with an equal
signature are candidates. Each is then verified by the edit distance, in words, of the
whole item to the best-fitting part of the document.

Before the walks a document window must hold as many neighbouring word pairs that some item
has too as half of what edits leave at least: k edits spoil at most 2k of an item's pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_folder
from .batches import Words, map_batches, mix, text_slices, unused

#: Edits per word of an item up to which a passage counts as that item.
MAX_EDIT_SHARE = 0.2
#: The share of passages with the most edits allowed that should be found, at every length of item.
TARGET_RECALL = 0.97
#: The longest window; longer items have more of them.
MAX_WINDOW = 256
#: Sampled places of a signature, and signatures of a walk.
SAMPLES, PER_WALK = 3, 4
#: Passages of the simulation that sets the number of walks (fewer where they are long), and walks at most.
TRIALS, MOST_WALKS = 200, 64
#: Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 1 << 20
# Factor of the hash of a pair, any odd number.
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Numbers that a step over windows holds.
STEP_NUMBERS = 1 << 20


def window_length(words: int) -> int:
    """Words of the windows for an item: the largest power of two that any placement in a text is sure to meet.

    Windows begin at every quarter of their length, so an item must be longer by that. None is
    longer than ``MAX_WINDOW``.
    """
    length = 4
    while 2 * length <= MAX_WINDOW and 2 * length + stride(2 * length) - 1 <= words:
        length *= 2
    return min(length, words)


def stride(length: int) -> int:
    return max(1, length // 4)


def signatures(hashes: np.ndarray, starts: np.ndarray, length: int, walk: int) -> np.ndarray:
    """``PER_WALK`` signatures of each window ``hashes[start:start + length]``, by one walk."""
    draw = np.random.default_rng([length, walk])
    # later on most walks are through their windows
    steps = max(1, 3 * length // 2)
    seeds = draw.integers(0, 1 << 63, -(-steps // 64), dtype=np.uint64)
    sampled = [draw.choice(steps, min(SAMPLES, steps), replace=False) for _ in range(PER_WALK)]
    out = np.empty((len(starts), PER_WALK), dtype=np.uint64)
    words = np.append(hashes, np.uint64(0))
    block = max(1, STEP_NUMBERS // steps)
    for begin in range(0, len(starts), block):
        some = starts[begin : begin + block]
        # one column more, which stands for the end of a window
        window = words[np.minimum(some[:, None] + np.arange(length + 1), len(hashes))]
        window[:, length] = 0
        at, row = np.zeros(len(some), dtype=np.int64), np.arange(len(some))
        path = np.empty((steps, len(some)), dtype=np.uint64)
        for step in range(steps):
            if step % 64 == 0:  # 64 bits of each word for the coming steps
                bits = mix(window ^ seeds[step // 64])
            path[step] = window[row, at]
            at += ((bits[row, at] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
            np.minimum(at, length, out=at)
        for number, places in enumerate(sampled):
            total = np.full(len(some), np.uint64((length * 64 + walk) * PER_WALK + number))
            for place in places:
                total = mix(total ^ path[place])
            out[begin : begin + block, number] = total
    return out


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of each word and the next."""
    with np.errstate(over="ignore"):
        return mix(hashes[:-1] * _ODD + hashes[1:])


def least_pairs(length: int, share: float) -> int:
    """Known pairs of words that a window must hold to be looked at.

    A passage of n words with k edits keeps n - 1 - 2k pairs of its item and has n + k words at
    most; a window must reach half of that density, or all pairs where no edit is allowed.
    """
    if int(share * length) == 0 and length < 4:
        return length - 1
    return int(length * max(0.0, 1 - 2 * share) / (1 + share) / 2)


@functools.cache
def walks(length: int, share: float = MAX_EDIT_SHARE) -> int:
    """The walks that windows of ``length`` words need: the fewest that find simulated passages.

    A passage is an item of that window length and the greatest share of edits that may be made
    to such a one, the shortest of several, at a place of its own between other words. The draws
    are the same in every run.
    """
    sizes = [n for n in range(length, 3 * length + 2) if window_length(n) == length]
    size = max(sizes, key=lambda n: (int(share * n) / n, -n))
    most = int(share * size)
    if not most:
        return 1
    draw = np.random.default_rng([length, most])
    trials = min(TRIALS, max(50, 100 * TRIALS // (length * 2)))
    items, texts = [], []
    for _ in range(trials):
        item = draw.integers(1, 1 << 62, size).tolist()
        words = list(item)
        for _ in range(most):
            place, kind, other = int(draw.integers(len(words))), draw.integers(3), int(draw.integers(1, 1 << 62))
            words[place : place + (kind != 2)] = [other] if kind != 1 else []
        before = draw.integers(1, 1 << 62, length + int(draw.integers(stride(length)))).tolist()
        items.append(item)
        texts.append([*before, *words, *draw.integers(1, 1 << 62, length).tolist()])
    sides = []
    for rows, step in ((items, 1), (texts, stride(length))):
        starts, trial, base = [], [], 0
        for number, row in enumerate(rows):
            own = range(base, base + len(row) - length + 1, step)
            starts += own
            trial += [number] * len(own)
            base += len(row)
        sides.append((np.array([w for row in rows for w in row], dtype=np.uint64), np.array(starts), np.array(trial, dtype=np.uint64)))
    missed = np.ones(trials, dtype=bool)
    for walk in range(MOST_WALKS):
        keys = [mix(signatures(words, starts, length, walk) ^ trial[:, None]) for words, starts, trial in sides]
        missed[sides[1][2][np.isin(keys[1], keys[0]).any(axis=1)].astype(int)] = False
        if missed.mean() <= (1 - TARGET_RECALL) / 6:
            break
    # some room, for what a simulation of this size does not show
    return walk + 2 + walk // 4


def edits(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(edits, end): the least word edits that turn ``item`` into a part of ``region``, and where the first such part ends."""
    row = np.zeros(len(region) + 1, dtype=np.int32)
    ramp = np.arange(len(region) + 1, dtype=np.int32)
    for i, word in enumerate(item):
        best = np.empty_like(row)
        best[0] = i + 1
        np.minimum(row[1:] + 1, row[:-1] + (region != word), out=best[1:])
        row = np.minimum.accumulate(best - ramp) + ramp
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class Items:
    """The items of one block: their words, and an index from signatures to windows."""

    ids: list
    words: list[np.ndarray]
    share: float = MAX_EDIT_SHARE
    keys: np.ndarray = field(init=False)
    item: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)
    walks: dict[int, int] = field(init=False)

    def __post_init__(self) -> None:
        self.plain = [words.tolist() for words in self.words]
        sizes = np.array([window_length(len(w)) for w in self.words], dtype=np.int64)
        self.walks = {length: walks(length, self.share) for length in sorted(set(sizes.tolist()) - {0})}
        keys, item, start = [], [], []
        for length, count in self.walks.items():
            numbers = np.flatnonzero(sizes == length)
            own = [self.words[n] for n in numbers]
            base = np.cumsum([0, *map(len, own)])
            # all windows of an item, so that one of them lies as a window of the text does
            starts = np.concatenate([np.arange(b, b + len(w) - length + 1) for b, w in zip(base, own, strict=False)])
            number = np.repeat(numbers, [len(w) - length + 1 for w in own]).astype(np.int32)
            place = np.concatenate([np.arange(len(w) - length + 1, dtype=np.int32) for w in own])
            for walk in range(count):
                keys.append(signatures(np.concatenate(own), starts, length, walk).ravel())
                item.append(np.repeat(number, PER_WALK))
                start.append(np.repeat(place, PER_WALK))
        self.keys, self.item, self.start = (np.concatenate(c) if c else np.zeros(0, d) for c, d in ((keys, np.uint64), (item, np.int32), (start, np.int32)))
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.item, self.start = self.keys[order], self.item[order], self.start[order]
        self.maybe, self.pairs = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 22, dtype=bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        for words in self.words:
            self.pairs[pair_hashes(words) >> np.uint64(42)] = True

    def candidates(self, words: Words, share: float) -> list[tuple[int, int, int]]:
        """(document, item, place of the item's first word) for all windows with an equal signature, in order."""
        found = [np.zeros((0, 3), dtype=np.int64)]
        counts = np.diff(words.first)
        known = np.zeros(len(words.hash) + 1, dtype=np.int64)
        if len(words.hash) > 1:
            np.cumsum(self.pairs[pair_hashes(words.hash) >> np.uint64(42)], out=known[1:-1])
            known[-1] = known[-2]
        for length, number_of_walks in self.walks.items():
            step = stride(length)
            # windows at every step from each document's first word, and one at its end
            fitting = np.flatnonzero(counts >= length)
            per_doc = -(-(counts[fitting] - length) // step) + 1
            doc = np.repeat(fitting, per_doc)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            starts = words.first[doc] + np.minimum(number * step, counts[doc] - length)
            held = known[starts + length - 1] - known[starts] >= least_pairs(length, share)
            doc, starts = doc[held], starts[held]
            for walk in range(number_of_walks if len(starts) else 0):
                keys = signatures(words.hash, starts, length, walk).ravel()
                some = np.flatnonzero(self.maybe[keys >> np.uint64(44)])
                left = np.searchsorted(self.keys, keys[some], "left")
                size = np.searchsorted(self.keys, keys[some], "right") - left
                window = np.repeat(some // PER_WALK, size)
                entry = np.repeat(left - np.cumsum(size) + size, size) + np.arange(size.sum())
                found.append(np.stack([doc[window], self.item[entry], starts[window] - self.start[entry]], axis=1))
        return list(map(tuple, np.unique(np.concatenate(found), axis=0).tolist()))

    def hits(self, words: Words, share: float) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item) -> (edits, first word, end word) of its best passage, the first of several."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        seen = set()
        for doc, number, place in self.candidates(words, share):
            item = self.words[number]
            most = int(share * len(item))
            slack = most + 1
            if (doc, number, place // slack) in seen:  # within the reach of a region looked at
                continue
            low, high = words.first[doc], words.first[doc + 1]
            own = words.hash[max(low, place) : max(low, place) + len(item)]
            if place >= low and len(own) == len(item) and place + len(item) <= high and (own == item).all():
                got = (0, int(place), int(place) + len(item))
            else:
                seen.add((doc, number, place // slack))
                begin = max(low, place // slack * slack - slack)
                region = words.hash[begin : min(high, place // slack * slack + len(item) + 2 * slack)]
                # each word that no edit touches stands in the region
                there = set(region.tolist())
                if sum(word in there for word in self.plain[number]) < len(item) - most:
                    continue
                cost, end = edits(item, region)
                if cost > most:
                    continue
                # the same from the end backwards gives the beginning
                _, back = edits(item[::-1], region[:end][::-1])
                got = (cost, int(begin + end - back), int(begin + end))
            key = (doc, number)
            if key not in best or got < best[key]:
                best[key] = got
        return best


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int, share: float) -> Iterator[tuple[int, Items]]:
    """(number of blocks, items) of each block; blocks are bounded and gathered one by one."""
    picked = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    total = picked.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    for block in range(count):
        rows = picked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block).toArrow()
        texts = rows.column("text").combine_chunks()
        words = Words(texts if isinstance(texts, pa.Array) else pa.array([], pa.string()))
        yield count, Items(rows.column("id").to_pylist(), [words.hash[a:b] for a, b in zip(words.first, words.first[1:], strict=False)], share)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_edit_share: float = MAX_EDIT_SHARE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item id, edits, item_words, start_word, end_word, start, end) of each item found in each row of ``docs``.

    Words are runs of letters and digits, A-Z as a-z. An item is found where at most
    ``max_edit_share`` of its words are inserted, left out or replaced; the best place is
    given, the first of equals, in words and in code points (end exclusive). Items without
    a word and null texts are found nowhere; repeated rows give repeated results; equal items
    are found alike; empty tables give no rows. Other columns are not read. The items are
    looked for in blocks, one pass over the documents for each.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbers = [T.StructField(n, T.LongType()) for n in ("edits", "item_words", "start_word", "end_word", "start", "end")]
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), T.StructField("item", items.schema[item_id].dataType), *numbers])
    item_type = _arrow_type(items, item_id)
    spark = docs.sparkSession
    folder = None
    for number_of_blocks, block in _blocks(items, item_id, item_text, block_chars, max_edit_share):
        shared = spark.sparkContext.broadcast(block)  # bounded by block_chars

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for part in text_slices(batch):
                    words = Words(part.column("text"))
                    rows = []
                    for (doc, number), (cost, first, end) in sorted(known.hits(words, max_edit_share).items()):
                        base = words.offsets[doc]
                        chars = [len(words.data[base:place].tobytes().decode()) for place in (words.start[first], words.end[max(first, end - 1)])]
                        rows.append((doc, known.ids[number], cost, len(known.words[number]), first - words.first[doc], end - words.first[doc], *chars))
                    columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], item_type), *(pa.array(c, pa.int64()) for c in columns[2:])],
                        names=schema.names,
                    )

        found = map_batches(picked, run, schema)
        if number_of_blocks > 1:
            # one block at a time: its passages are kept, its index is let go
            folder = folder or work_folder(spark, "leaks")
            found.write.mode("append").parquet(folder)
            shared.destroy()
            found = spark.read.schema(schema).parquet(folder)
    return found.withColumnsRenamed({"id": id_col, "item": item_id})


def _arrow_type(frame: DataFrame, column: str) -> pa.DataType:
    return frame.select(column).filter(F.lit(False)).toArrow().schema.field(0).type


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found; rows with a null id stay unless their text holds one.

    Rows of one id are judged each by its own text. Null and empty texts hold nothing and stay, as do
    all rows where there are no items. Columns may have any names and stay as they are.
    """
    row, leaked = unused(docs, "row"), unused(docs, "leaked")
    tagged = docs.withColumn(row, F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")))
    found = leaks(tagged.select(row, text_col), items, row, text_col, **options).select(F.col(row).alias(leaked)).distinct()
    same = F.col(f"{row}.id").eqNullSafe(F.col(f"{leaked}.id")) & (F.col(f"{row}.text_hash") == F.col(f"{leaked}.text_hash"))
    return tagged.join(found, same, "left_anti").select(*docs.columns)
