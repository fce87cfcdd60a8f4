"""Line dedup with DataFrame functions only: keep bitmaps of documents, and their use.

Line keys are dealt out by ranges of (hash, document), so that even one line that fills the
table is spread. Each task sorts its range by hash, document and position and streams the
first occurrence in each document out of it; only these are counted. What comes out is small: the kept lines of
a document as the ends of their runs. Texts are read again only where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .batches import unused

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _row_key(text: Column) -> Column:
    """Tells apart rows of one id but different texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, row, pos, h1, h2) of each line that is long enough; h1 and h2 are its key's 128 hash bits."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a key is no longer than its line, so most short lines go before they are trimmed
    lines = docs.select(F.col(id_col).alias("doc"), _row_key(text).alias("row"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    long = lines.filter(F.char_length("line") >= min_chars)
    keyed = long.select("doc", "row", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


def first_in_document(found: DataFrame) -> DataFrame:
    """Of :func:`occurrences` the first of each line in each document, streamed from sorted ranges.

    Ranges hold whole (line, document) groups, so the window needs no other exchange, only its sort.
    """
    ranged = found.repartitionByRange("h1", "h2", "doc")
    in_document = Window.partitionBy("h1", "h2", "doc").orderBy("pos")
    return ranged.withColumn("nth", F.row_number().over(in_document)).filter("nth = 1").drop("nth")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, row, dropped): positions of the lines to drop, for each document that has any.

    A line goes if its key has ``min_chars`` code points or more, is found in
    ``min_docs`` or more documents, and this is not the one with the largest id.
    """
    found = stored(occurrences(docs, id_col, text_col, min_chars), "lines")
    counted = first_in_document(found).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
    frequent = stored(counted.filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"), "line-keys")
    extra = found.join(frequent, ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    return extra.groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def run_ends(n_lines: Column, dropped: Column) -> Column:
    """The keep bitmap of a document, compressed: where its runs of kept and dropped lines end, in turn.

    The first run is of kept lines and may be empty; ``dropped`` are sorted positions.
    """
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) < x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) > x + 1))
    runs = F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b + 1)))
    last = F.coalesce(F.get(dropped, F.size(dropped) - 1) + 1, F.lit(0))
    return F.when(F.size(dropped) == 0, F.array(n_lines.cast("int"))).when(last < n_lines, F.concat(runs, F.array(n_lines.cast("int")))).otherwise(runs)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(id, row_key, n_dropped, dropped) of each document that loses lines; ``dropped`` are positions from 0.

    Only the two named columns are read. Rows of one id count as one document when
    documents are counted; repeated rows lose the same lines. A null or empty text is
    one empty line. Null ids count as one document, which comes before all others.
    """
    found = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    return found.select(F.col("doc").alias(id_col), F.col("row").alias("row_key"), F.size("dropped").alias("n_dropped"), "dropped")


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``keep_runs`` (see :func:`run_ends`) of each row.

    Columns of ``docs`` with these names are replaced; all others stay, whatever their names.
    """
    found = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    kept = docs.drop("n_lines", "n_dropped", "keep_runs")
    doc, row, gone = (unused(kept, name) for name in ("doc", "row", "dropped"))
    found = found.withColumnsRenamed({"doc": doc, "row": row, "dropped": gone})
    joined = kept.join(found, F.col(id_col).eqNullSafe(F.col(doc)) & (_row_key(F.col(text_col)) == F.col(row)), "left")
    n_lines = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    dropped = F.coalesce(gone, F.array().cast("array<int>"))
    counted = joined.withColumns({"n_lines": n_lines.cast("long"), "n_dropped": F.size(dropped).cast("long"), gone: dropped})
    return counted.withColumn("keep_runs", run_ends(F.col("n_lines"), F.col(gone))).select(*kept.columns, "n_lines", "n_dropped", "keep_runs")


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines of ``text`` that its keep bitmap keeps, joined by line feeds.

    A document may lose all its lines; what is left is the empty text.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def run(end: Column, i: Column) -> Column:
        begin = F.coalesce(F.get(keep_runs, i - 1), F.lit(0))
        return F.slice(lines, begin + 1, F.when(i % 2 == 0, end - begin).otherwise(0))

    some = F.array_join(F.flatten(F.transform(keep_runs, run)), "\n")
    return F.when(F.size(keep_runs) == 1, F.coalesce(text, F.lit(""))).otherwise(some)
