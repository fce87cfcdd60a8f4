"""Token pieces against the tokenizer itself, and packing as a gapless placement."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retailtide.llm import packing
from retailtide.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
WORDS = packing.WordIds(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@drawn(st.lists(st.text(alphabet=st.sampled_from("abzAZéÉßñΣİ'.,!-_09 \t\n\v\f\r  \x1c\x85é<|>中😀"), max_size=40), max_size=4))
def test_ids_are_the_tokenizers(texts):
    texts += ["It's a DON'T <|ENDOFTEXT|> x", "<|endoftext|>", None]
    ids, first = WORDS.of(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == plain_ids(text)


def test_the_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY_WORDS", 3)
    words = packing.WordIds(PATH)
    for text in ("a b c d", "e f g h", "a z"):
        ids, _ = words.of(pa.array([text]))
        assert ids.tolist() == plain_ids(text)
    assert len(words.place) <= 6


def check_places(rows, capacity):
    """rows: (sequence, offset, length); returns the number of sequences."""
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_given_documents(spark, small_dir, given):
    found = QUERIES["op4_packing"](spark, small_dir).collect()
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for row in given.collect():
        ids = np.array([*plain_ids(row["text"]), 0], dtype="<u4")
        cut = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        assert sorted(by_doc[row["doc_id"]]) == [(i, i * 2048, len(c), zlib.crc32(c.tobytes())) for i, c in enumerate(cut)]
    sequences = check_places([(r["sequence_id"], r["offset"], r["length"]) for r in found], 2048)
    least = sum(r["length"] for r in found) / 2048
    assert sequences <= 1.05 * least + 1


def test_many_tasks_still_fill_well(spark):
    draw = random.Random(4)
    sizes = [draw.randint(1, 100) for _ in range(20_000)]
    items = spark.createDataFrame([(i, s, [s]) for i, s in enumerate(sizes)], "id int, length int, ids array<int>")
    rows = packing.pack(items, capacity=100, most=64, task_sequences=1000).collect()
    assert sorted((r["id"], r["length"], r["ids"][0]) for r in rows) == [(i, s, s) for i, s in enumerate(sizes)]
    assert check_places([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 100) <= 1.06 * sum(sizes) / 100


def test_the_fullest_closes_first():
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(x) for x in (6, 5, 8, 5)] == [(0, 0), (1, 0), (2, 0), (1, 5)]
    assert bins.open == 1  # 0 closed for 2, 1 is full
    assert bins.place(2) == (2, 8) and bins.open == 0


def test_edge_rows(spark, documents):
    rows = documents((None, "x"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "word " * 30_000))
    clash = rows.withColumn("piece", rows["lang"]).withColumn("length", rows["lang"])
    found = packing.packed(clash).collect()
    sizes = defaultdict(list)
    for r in found:
        sizes[r["doc_id"]].append(r["length"])
        assert len(r["ids"]) == r["length"] and r["ids"][-1] == 0 or r["length"] == 2048
    assert sizes[1] == sizes[2] == [1] and sizes[3] == [2, 2] and sum(sizes[4]) == 30_001 and len(sizes[None]) == 1
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in found], 2048)
    assert packing.packed(documents()).collect() == []


@pytest.mark.parametrize("length", [0, 11, None])
def test_wrong_lengths_fail(spark, length):
    with pytest.raises(Exception, match="must be 1 to 10"):
        packing.pack(spark.createDataFrame([(length,)], "length int"), capacity=10).collect()
