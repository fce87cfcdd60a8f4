"""Benchmark passages: recall on edited plants, exact verification, blocks, edge rows."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from retailtide.llm import decontam
from retailtide.llm.batches import Words, word_hashes
from retailtide.llm.queries import QUERIES


def plain_edits(item, text):
    """Least edits from the item to any part of the text, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edits_are_exact():
    draw = np.random.default_rng(1)
    for _ in range(200):
        item, text = (draw.integers(0, 5, draw.integers(0, 14)).astype(np.uint64) for _ in range(2))
        cost, end = decontam.edits(item, text)
        assert cost == plain_edits(item.tolist(), text.tolist())
        back, start = decontam.edits(item[::-1], text[:end][::-1])
        assert back == cost


def test_every_placement_meets_a_window():
    for words in range(1, 300):
        length = decontam.window_length(words)
        step = decontam.stride(length)
        assert 1 <= length <= words and (words - length + 1 >= step or length < 4)


@pytest.fixture(scope="module")
def items(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/benchmark.parquet")


def test_given_documents_hold_what_plain_search_finds(spark, small_dir, given, items):
    found = {(r["doc_id"], r["item_id"]): r for r in QUERIES["op7_decontam"](spark, small_dir).collect()}
    known = {r["item_id"]: word_hashes(r["text"]).tolist() for r in items.collect()}
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    exact = {(d, i) for d, t in texts.items() for i, w in known.items() if str(w)[1:-1] in str(word_hashes(t).tolist())}
    assert exact and exact <= set(found) and all(found[k]["edits"] == 0 for k in exact)
    for (doc, item), r in found.items():
        words = word_hashes(texts[doc]).tolist()[r["start_word"] : r["end_word"]]
        assert plain_edits(known[item], words) == r["edits"] <= 0.2 * len(known[item])


def test_recall_on_edited_passages(spark, documents, items, given):
    draw = random.Random(8)
    prose = [r["text"].split() for r in given.filter("lang = 'en' AND n_chars > 1500").limit(20).collect()]
    rows, wanted = [], set()
    for n, item in enumerate(items.collect() * 3):
        words = item["text"].split()
        for _ in range(int(0.12 * len(words))):
            place = draw.randrange(len(words))
            kind = draw.randrange(3)
            if kind == 0:
                words[place] = "Other,"
            elif kind == 1:
                del words[place]
            else:
                words.insert(place, "more")
        host = draw.choice(prose)
        at = draw.randrange(len(host))
        rows.append((n, " ".join([*host[:at], *words, *host[at:]])))
        wanted.add((n, item["item_id"]))
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(documents(*rows), items).collect()}
    assert len(wanted & found) >= 0.97 * len(wanted)
    clean = documents(*[(n, " ".join(draw.sample(host, min(200, len(host))))) for n, host in enumerate(prose)])
    assert decontam.leaks(clean, items).count() == 0


@pytest.mark.parametrize("size", [5, 9, 10, 15, 19, 20, 39, 40, 79, 90, 159, 200, 320])
def test_recall_at_the_most_edits_allowed(size):
    draw = np.random.default_rng(size)
    found = 0
    for _ in range(100):
        item = draw.integers(1, 1 << 62, size).astype(np.uint64)
        words = item.tolist()
        for _ in range(int(0.2 * size)):
            place, kind, other = int(draw.integers(len(words))), draw.integers(3), int(draw.integers(1, 1 << 62))
            words[place : place + (kind != 2)] = [other] if kind != 1 else []
        around = draw.integers(1, 1 << 62, 100 + int(draw.integers(64))).tolist()
        text = np.array([*around, *words, *around[:100]], dtype=np.uint64)
        found += bool(decontam.Items([0], [item]).hits(SimpleNamespace(first=np.array([0, len(text)]), hash=text), 0.2))
    assert found >= 97


def test_blocks_give_the_same(documents, items, given):
    one = decontam.leaks(given, items).collect()
    many = decontam.leaks(given, items, block_chars=2000).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and one


def test_edge_rows(spark, documents):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "..."), (5, item), (6, "solo word")], "item_id int, text string")
    rows = documents((None, item.upper()), (1, None), (2, ""), (3, item), (3, item), (4, "x " * 200_000 + item.replace(" ", ", ")), (5, "a solo word"), (6, "clean"))
    clash = rows.withColumn("item_id", rows["lang"]).withColumn("edits", rows["lang"]).withColumn("_x", rows["lang"])
    found = sorted((str(r["doc_id"]), r["item_id"], r["edits"]) for r in decontam.leaks(clash, items).collect())
    assert found == sorted([(d, i, 0) for d in ("None", "3", "3", "4") for i in (1, 5)] + [("5", 6, 0)])
    kept = decontam.clean(clash, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6] and kept.columns == clash.columns
    assert decontam.leaks(documents(), items).count() == 0
    assert decontam.leaks(rows, items.limit(0)).count() == 0
    assert decontam.clean(rows, items.limit(0)).count() == 8


def test_windows_stay_within_their_document():
    texts = pa.array(["one two three four five", "six seven eight nine ten"])
    index = decontam.Items([0], [word_hashes("three four five six seven eight")])
    assert not index.hits(Words(texts), 0.2)
