"""Stupid backoff against a plain count, with pieces of any size."""

import math
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailtide.llm import lm

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain(rows, least=1, backoff=0.4, order=2):
    """Scores by counters of runs of every length."""
    ids = [(i, TOKENIZER.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    runs = [(i, [tuple(([49406] * (order - 1) + t)[k : k + order]) for k in range(len(t))]) for i, t in ids]
    seen = [Counter(run[order - k :] for _, own in runs for run in own) for k in range(order + 1)]
    contexts = [Counter() for _ in range(order + 1)]
    for k in range(1, order + 1):
        for run, n in seen[k].items():
            contexts[k][run[:-1]] += n

    def score(run):
        k = len(run)
        if k == 1 or seen[k][run] >= least:
            return math.log(seen[k][run] / contexts[k][run[:-1]])
        return math.log(backoff) + score(run[1:])

    return [(i, len(own), sum(map(score, own))) for i, own in runs]


def check(frame, rows, **options):
    got = sorted(((str(r["doc_id"]), r["n_tokens"], r["log_score"]) for r in lm.scores(frame, **options).collect()))
    want = sorted((str(i), n, s) for i, n, s in plain(rows, options.get("min_count", 1), order=options.get("order", 2)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("least", [1, 2])
def test_given_documents(given, order, least):
    check(given, [(r["doc_id"], r["text"]) for r in given.collect()], order=order, min_count=least)


@pytest.mark.parametrize("piece", [1, 3, 1 << 16])
def test_edge_rows_in_pieces_of_any_size(documents, monkeypatch, piece):
    monkeypatch.setattr(lm, "PIECE", piece)
    rows = [(None, "a b a b"), (1, None), (2, ""), (3, "same words here"), (3, "same words here"), (3, "a b"), (4, "long words " * 20_000)]
    frame = documents(*rows)
    clash = frame.withColumns({name: frame["lang"] for name in ("number", "id", "gram", "times", "n", "salt", "score")})
    check(clash, rows)
    check(clash, rows, order=3, min_count=2)


def test_a_hot_pair_is_not_shuffled(documents, monkeypatch):
    monkeypatch.setattr(lm, "HOT_GRAMS", 8)
    draw = random.Random(6)
    rows = [(i, "tick tock" if i % 3 else f"{draw.randrange(900)} {draw.randrange(900)}") for i in range(900)]
    grams = lm.exploded(lm.gram_lists(documents(*rows)))
    counts = lm.gram_counts(grams)
    hot, rest = lm.divided(lm.gram_scores(counts), grams.count())
    assert 0 < hot.count() < 8 and hot.count() + rest.count() == counts.count()
    moved = grams.join(rest, "gram").groupBy("gram").count().collect()
    assert max(r["count"] for r in moved) <= grams.count() / 8
    check(documents(*rows), rows)


@pytest.mark.parametrize("hot", [1, 5, 1 << 16])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_scores_are_the_same_wherever_a_pair_is_scored(documents, monkeypatch, hot, least):
    monkeypatch.setattr(lm, "HOT_GRAMS", hot)
    rows = [(1, "a b " * 50 + "c"), (2, "a b c d e f a b"), (3, "c d"), (3, "c d"), (4, "x"), (5, None)]
    check(documents(*rows), rows, min_count=least)


def test_no_rows(documents):
    assert lm.scores(documents()).collect() == []
    assert [tuple(r) for r in lm.scores(documents((1, None))).collect()] == [(1, 0, 0.0, None)]


def test_order_has_bounds(documents):
    with pytest.raises(ValueError):
        lm.scores(documents((1, "a")), order=4)


def plain_without_own(rows, backoff=0.4):
    """Each row by the pairs of all other rows, counted anew for each."""
    runs = [(i, list(zip([49406, *t], t))) for i, t in ((i, TOKENIZER.encode(t or "", add_special_tokens=False).ids) for i, t in rows)]
    found = []
    for at, (i, own) in enumerate(runs):
        pairs = Counter(run for k, (_, other) in enumerate(runs) if k != at for run in other)
        heads, ends = Counter(), Counter()
        for (a, b), n in pairs.items():
            heads[a] += n
            ends[b] += n

        def score(a, b):
            if pairs[a, b]:
                return pairs[a, b] / heads[a]
            return backoff * (ends[b] / ends.total() if ends[b] else backoff / 65_536)

        found.append((i, len(own), sum(math.log(score(a, b)) for a, b in own)))
    return found


@pytest.mark.parametrize("hot", [1, 5, 1 << 16])
@pytest.mark.parametrize("piece", [1, 1 << 16])
def test_a_row_left_out_backs_off(documents, monkeypatch, hot, piece):
    monkeypatch.setattr(lm, "HOT_GRAMS", hot)
    monkeypatch.setattr(lm, "PIECE", piece)
    rows = [(1, "a b " * 50 + "c"), (2, "a b c d e f a b"), (3, "c d"), (3, "c d"), (4, "only zebras here"), (5, None), (None, "b a d"), (6, "d d d")]
    frame = documents(*rows)
    clash = frame.withColumns({name: frame["lang"] for name in ("number", "id", "gram", "n", "of", "key", "heads", "backed")})
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["log_score"]) for r in lm.scores(clash, leave_out=True).collect())
    want = sorted((str(i), n, s) for i, n, s in plain_without_own(rows))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9)


def test_a_lone_row_and_no_rows_left_out(documents):
    assert lm.scores(documents(), leave_out=True).collect() == []
    (row,) = lm.scores(documents((1, "a")), leave_out=True).collect()
    assert row["log_score"] == pytest.approx(math.log(0.16 / 65_536))
    with pytest.raises(ValueError):
        lm.scores(documents((1, "a")), order=3, leave_out=True)


def test_the_query_backs_off(spark, small_dir, given, monkeypatch):
    from retailtide.llm.queries import QUERIES

    before = sum(r["log_score"] for r in QUERIES["op10_lm"](spark, small_dir).collect())
    scores = lm.scores
    monkeypatch.setattr(lm, "scores", lambda docs, **options: scores(docs, **options, backoff=0.1))
    assert sum(r["log_score"] for r in QUERIES["op10_lm"](spark, small_dir).collect()) < before - 1
