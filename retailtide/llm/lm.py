"""Stupid-backoff scores of documents, by joins on n-gram count tables.

The n-grams are runs of ``order`` tokens of a public tokenizer. Each text is exploded into its
distinct n-grams with the times each stands there. Their sums are the count table, from
which follow the counts of contexts (all but the last token) and of shorter n-grams. An n-gram
found often enough scores its share of its context, any other ``backoff`` times the score of
the n-gram without its first token; a single token scores its share of all. The exploded
n-grams meet these scores in a join by hash, and what a text gathers is summed per text.
The most frequent n-grams, whose number has a fixed bound, meet their scores in a broadcast
join, so that none weighs in a partition.

A text scored by the counts of all rows never backs off, as its own n-grams are among those
counted. ``leave_out`` scores each row by the counts of all others: a pair of no other row
backs off to its last token, and a token of no other row to any of all ``1 << ID_BITS`` ids.
What the row itself has of a token is known where it is read, and all tokens' counts fit a broadcast of a
fixed bound; so only counts of pairs in several rows go through the join by hash, and a pair of one
row names that row in the count table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored, work_folder
from .batches import SLICE_BYTES, map_batches, text_slices

BACKOFF = 0.4
#: Columns of what a row itself has.
OWN = ("heads", "tails")
#: Tokens of an n-gram.
ORDER = 2
#: N-grams found less often than this in the whole table back off.
MIN_COUNT = 1
#: Bits of a token id; an n-gram is one number of ``ORDER`` times as many.
ID_BITS = 16
#: N-grams of one row of the exploded table; a longer text has several rows.
PIECE = 1 << 16
#: N-grams whose share of all exploded rows is above one in so many are not shuffled; there are fewer of them.
HOT_GRAMS = 1 << 16


def _reader(tokenizer: str):
    from .packing import word_ids

    if os.sep in tokenizer:
        return word_ids(tokenizer)
    import public_tokenizers

    return word_ids(public_tokenizers.path(tokenizer))


def _grams(words, texts: pa.Array, start_id: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each token, one text after the other, and where each text's begin and the last end."""
    ids, first = words.of(texts)
    ids = ids.astype(np.int64)
    place = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
    grams = ids.copy()
    for back in range(1, order):
        before = np.full_like(ids, start_id)
        inside = np.flatnonzero(place >= back)
        before[inside] = ids[inside - back]
        grams |= before << (ID_BITS * back)
    return grams, first


def _sums_by_group(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each value the sum of all values of its group."""
    if not len(values):
        return values
    order = np.argsort(group, kind="stable")
    found = group[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    sums = np.empty_like(values)
    sums[order] = np.repeat(np.add.reduceat(values[order], first), np.diff(np.append(first, len(values))))
    return sums


def gram_lists(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    start_id: int = 49406,
    order: int = ORDER,
    own: bool = False,
) -> DataFrame:
    """(number, id, n_tokens, grams, times): the distinct n-grams of each row and how often each stands in it.

    ``number`` tells rows apart, repeated ones too. A text of more than ``PIECE`` distinct n-grams
    has several rows, of which the first alone has ``n_tokens``. The first tokens of a text
    follow ``start_id``. The table is written once, so that numbers stay as they are. ``own`` adds
    ``heads`` and ``tails``: how often the row has an n-gram of that context, and of that last token.
    """
    picked = docs.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [("n_tokens", T.LongType()), ("grams", T.ArrayType(T.LongType()))]
    fields += [(name, T.ArrayType(T.IntegerType())) for name in ("times", *OWN * own)]
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("id", picked.schema["id"].dataType)])
    for name, kind in fields:
        schema = schema.add(name, kind)
    bits = ID_BITS * order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _reader(tokenizer)
        for batch in batches:
            for part in text_slices(batch, SLICE_BYTES // 4):
                grams, first = _grams(words, part.column("text"), start_id, order)
                sizes = np.diff(first)
                keys, times = np.unique(np.repeat(np.arange(part.num_rows), sizes) << bits | grams, return_counts=True)
                ends = np.searchsorted(keys >> bits, np.arange(part.num_rows + 1))
                pieces = np.maximum(1, -(-np.diff(ends) // PIECE))
                row = np.repeat(np.arange(part.num_rows), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                offsets = pa.array(np.append(ends[row] + piece * PIECE, len(keys)).astype(np.int32))
                counts = [times]
                if own:
                    last = keys >> bits << bits | keys & ((1 << ID_BITS) - 1)
                    counts += [_sums_by_group(times, group) for group in (keys >> ID_BITS, last)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name).take(pa.array(row)) for name in ("number", "id")),
                        pa.array(sizes[row], pa.int64(), mask=piece > 0),
                        pa.ListArray.from_arrays(offsets, pa.array(keys & ((1 << bits) - 1))),
                        *(pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))) for n in counts),
                    ],
                    names=schema.names,
                )

    spark = docs.sparkSession
    folder = work_folder(spark, "gram-lists")
    # numbers of a few bytes: half the size that the default codec leaves
    map_batches(picked, run, schema).write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def exploded(lists: DataFrame, *names: str) -> DataFrame:
    """(number, gram, times) and ``names`` of ``OWN``: a row for each distinct n-gram of each text."""
    names = ("times", *names)
    found = lists.select("number", *names, F.posexplode("grams").alias("at", "gram"))
    return found.select("number", "gram", *[F.col(name)[F.col("at")].alias(name) for name in names])


def gram_counts(grams: DataFrame) -> DataFrame:
    """(gram, n, n_rows): how often each n-gram stands in all texts, and in how many rows of ``grams``."""
    return grams.groupBy("gram").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("n_rows"))


def gram_scores(counts: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF) -> DataFrame:
    """``counts`` with the natural logarithm of each n-gram's ``score``, by a table of (gram, n)."""
    if order == 1:
        total = counts.agg(F.sum("n").alias("of")).first()["of"] or 1
        return counts.withColumn("score", F.log(F.col("n") / F.lit(total)))
    context = F.shiftright("gram", ID_BITS)
    contexts = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("of"))
    share = F.log(F.col("n") / F.col("of"))
    known = counts.withColumn("context", context).join(contexts, "context")
    if min_count <= 1:
        return known.select(*counts.columns, share.alias("score"))
    tail = F.col("gram").bitwiseAND((1 << ID_BITS * (order - 1)) - 1)
    shorter = gram_scores(counts.groupBy(tail.alias("gram")).agg(F.sum("n").alias("n")), order - 1, min_count, backoff)
    shorter = shorter.select(F.col("gram").alias("tail"), F.col("score").alias("tail_score"))
    score = F.when(F.col("n") >= min_count, share).otherwise(F.col("tail_score") + float(np.log(backoff)))
    return known.withColumn("tail", tail).join(shorter, "tail").select(*counts.columns, score.alias("score"))


def told_counts(grams: DataFrame) -> DataFrame:
    """:func:`gram_counts` with the ``number``, ``heads`` and ``tails`` of the row of an n-gram that a single row has."""
    names = ("number", *OWN)
    alone = [F.when(F.count(F.lit(1)) == 1, F.min(name)).alias(name) for name in names]
    return grams.groupBy("gram").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("n_rows"), *alone)


def token_counts(counts: DataFrame) -> DataFrame:
    """(token, of, ends): how often each token is a context, and how often it ends a pair; fewer than ``1 << ID_BITS`` rows."""
    none = F.lit(0).cast("long")
    head, tail = F.shiftright("gram", ID_BITS), F.col("gram").bitwiseAND((1 << ID_BITS) - 1)
    each = counts.select(head.alias("token"), F.col("n").alias("of"), none.alias("ends"))
    each = each.union(counts.select(tail.alias("token"), none.alias("of"), F.col("n").alias("ends")))
    return each.groupBy("token").agg(F.sum("of").alias("of"), F.sum("ends").alias("ends"))


def _log_if_any(count: Column) -> Column:
    return F.when(count > 0, F.log(count)).otherwise(0.0)


def others_scores(lists: DataFrame, counts: DataFrame, tokens: DataFrame, rows: int, backoff: float = BACKOFF) -> DataFrame:
    """(number, total, backed): what each row's pairs score by the counts of all other rows.

    ``lists`` are of :func:`gram_lists` with ``own``, ``counts`` of :func:`told_counts`, ``tokens`` of
    :func:`token_counts`. The ``backed`` tokens still lack a share: one in the number of all other rows' tokens.
    """
    times, of, ends = F.col("times"), F.col("of") - F.col("heads"), F.col("ends") - F.col("tails")
    hot, rest = divided(counts.filter(F.col("n_rows") > 1), rows, "n")
    heads = F.broadcast(tokens.select(F.col("token").alias("head"), "of"))
    tails = F.broadcast(tokens.select(F.col("token").alias("tail"), "ends"))
    head, tail = F.shiftright("gram", ID_BITS), F.col("gram").bitwiseAND((1 << ID_BITS) - 1)
    hot = F.broadcast(hot)
    n = F.col("n") - times
    # all pairs over their contexts, the most frequent ones with their counts
    near = exploded(lists, "heads").withColumn("head", head).join(heads, "head").join(hot, "gram", "left")
    near = near.select("number", (times * (F.coalesce(F.log(n), F.lit(0.0)) - _log_if_any(of))).alias("total"), F.lit(0).alias("backed"))
    # the counts of the other pairs that several rows have
    far = exploded(lists).join(hot, "gram", "left_anti").join(rest.hint("shuffle_hash"), "gram")
    far = far.select("number", (times * F.log(n)).alias("total"), F.lit(0).alias("backed"))
    # pairs of one row: not over their contexts, but by their last token
    alone = counts.filter(F.col("n_rows") == 1).withColumns({"head": head, "tail": tail}).join(heads, "head").join(tails, "tail")
    known, weight = ends > 0, float(np.log(backoff))
    score = F.when(known, F.log(ends) + weight).otherwise(2 * weight - ID_BITS * float(np.log(2)))
    alone = alone.select("number", (F.col("n") * (score + _log_if_any(of))).alias("total"), F.when(known, F.col("n")).otherwise(0).alias("backed"))
    sums = [F.sum(name).alias(name) for name in ("total", "backed")]
    parts = [part.groupBy("number").agg(*sums) for part in (near, far, alone)]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("number").agg(*sums)


def divided(table: DataFrame, rows: int, value: str = "score") -> tuple[DataFrame, DataFrame]:
    """The n-grams that hold more than one ``HOT_GRAMS``-th of all ``rows``, fewer than ``HOT_GRAMS``; all others."""
    is_hot = F.col("n_rows") > rows / HOT_GRAMS
    return tuple(table.filter(part).select("gram", value) for part in (is_hot, ~is_hot))


def scored_grams(grams: DataFrame, table: DataFrame, rows: int, order: int = ORDER) -> DataFrame:
    """(number, total): the sum of times * score of each row's n-grams, by a ``table`` of (gram, n_rows, score).

    The most frequent n-grams meet their scores in a broadcast of a fixed bound, where the text
    is read; all others by hash of the n-gram.
    """
    hot, rest = divided(table, rows)
    hot = F.broadcast(hot)
    # a shuffle at every size; pairs are bounded by the square of the vocabulary, so that a
    # partition's scores fit a hash table, longer n-grams are not
    rest = rest.hint("shuffle_hash" if order == 2 else "merge")
    met = (grams.join(hot, "gram"), grams.join(hot, "gram", "left_anti").join(rest, "gram"))
    sums = [part.groupBy("number").agg(F.sum(F.col("times") * F.col("score")).alias("total")) for part in met]
    return sums[0].union(sums[1]).groupBy("number").agg(F.sum("total").alias("total"))


def scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    start_id: int = 49406,
    min_count: int = MIN_COUNT,
    backoff: float = BACKOFF,
    order: int = ORDER,
    leave_out: bool = False,
) -> DataFrame:
    """(id, n_tokens, log_score, mean_log_score) of each row, by the counts of all rows.

    ``log_score`` is the sum of the natural logarithms of the scores of a text's n-grams; the mean
    is null for a text without tokens, and a null text counts as empty. A row counts as
    often as it stands and gives one result each time. Other columns are not read; an
    empty table gives no rows. Token ids must be below 65,536, and ``order`` at most 3.
    ``leave_out`` scores each row by the counts of all other rows, its repetitions included,
    at ``order`` 2 and ``min_count`` 1.
    """
    if not 2 <= order <= 3:
        raise ValueError("order must be 2 or 3")
    if leave_out and (order != 2 or min_count != 1):
        raise ValueError("leave_out needs order 2 and min_count 1")
    lists = gram_lists(docs, id_col, text_col, tokenizer, start_id, order, leave_out)
    grams = exploded(lists, *OWN * leave_out)
    counts = stored(told_counts(grams) if leave_out else gram_counts(grams), "gram-counts")
    sums = counts.agg(F.sum("n_rows").alias("rows"), F.sum("n").alias("tokens")).first()
    rows, total = sums["rows"] or 0, F.col("total")
    if leave_out:
        summed = others_scores(lists, counts, stored(token_counts(counts), "token-counts"), rows, backoff)
        share = F.log((sums["tokens"] or 0) - F.col("n_tokens"))
        total = F.when(F.col("backed") > 0, total - F.col("backed") * share).otherwise(total)
    else:
        summed = scored_grams(grams, stored(gram_scores(counts, order, min_count, backoff), "gram-scores"), rows, order)
    found = lists.filter(F.col("n_tokens").isNotNull()).select("number", "id", "n_tokens").join(summed, "number", "left")
    log_score = F.coalesce(total, F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, log_score / F.col("n_tokens"))
    return found.select(F.col("id").alias(id_col), "n_tokens", log_score.alias("log_score"), mean.alias("mean_log_score"))
