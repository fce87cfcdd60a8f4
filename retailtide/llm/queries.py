"""One query per operator over the given tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, licenses, lines, lm, packing, quality, secrets, simhash, tokens, topk, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _is(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: counts and digest of the fixed patterns, and all spans."""
    found = secrets.scan(_read(spark, sf_dir, "documents"))
    order = F.create_map(*[x for i, kind in enumerate(secrets.KINDS) for x in (F.lit(kind), F.lit(i))])

    def text(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("o"), s["end"].alias("b"), s["kind"].alias("k"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["k"], s["a"], s["b"])), ",")

    random = F.transform("random", lambda s: F.struct(F.lit("random").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kinds = F.transform("fixed", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(kind))).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    base = F.sha2(text(F.col("fixed")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, text(F.concat("fixed", random)).alias("spans"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.near_copies(_read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id", "n_links")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of each document, with coverage and span."""
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 2048 tokens."""
    return packing.packed(_read(spark, sf_dir, "documents"), with_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document, by a classifier that learns from two thirds of the labels."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.classifier(docs, _read(spark, sf_dir, "labels"))
    return _judged(quality.scored(docs, model, keep=["doc_id"]), "quality_score", quality.held_out("doc_id", 3, 1), 0.5)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, by a classifier that learns from three quarters of the labels."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.classifier(docs, _read(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(docs, model, keep=["doc_id"]), "toxicity_score", quality.held_out("doc_id", 4, 2), 0.3)


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document, with edits and place."""
    return decontam.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for each hundredth vector."""
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of each document by the counts of all others."""
    return lm.scores(_read(spark, sf_dir, "documents"), leave_out=True)


def _judged(scored: DataFrame, score: str, held_out: Column, threshold: float) -> DataFrame:
    predicted = (F.col(score) >= threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col(score).alias("score"), predicted.alias("predicted"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of each document without its repeated lines."""
    found = lines.with_bitmaps(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = lines.kept_text(F.col("text"), F.col("keep_runs"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"), "keep_runs")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector after five rounds, with inertia and the digest of its centroid."""
    assigned, found = centroids.clustered(_read(spark, sf_dir, "embeddings"))
    told = centroids.with_inertia(assigned, found)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return told.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document."""
    return tokens.token_counts(_read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of each vector, a row per component."""
    found = whitening.whitened(_read(spark, sf_dir, "embeddings"))
    each = found.select("*", F.posexplode("values").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("place")].alias("explained"), "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_simhash": op2_simhash,
    "op3_licenses": op3_licenses,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_decontam": op7_decontam,
    "op8_topk": op8_topk,
    "op9_lines": op9_lines,
    "op10_lm": op10_lm,
    "op11_centroids": op11_centroids,
    "op12_tokens": op12_tokens,
    "op13_whitening": op13_whitening,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _clusters_sql(k: int, rounds: int) -> str:
    """Whole-number k-means by comparing every vector with every centroid."""
    parts = [
        """vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64 AND list_bool_and([x IS NOT NULL AND isfinite(coalesce(x, 0)) FOR x IN embedding])
)""",
        f"""centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c FROM vectors
    QUALIFY cluster < {k}
)""",
    ]
    for number in range(rounds + 1):
        parts.append(f"""near{number} AS MATERIALIZED (
    SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min((d, cluster)) AS best
    FROM (SELECT row, vec_id, v, cluster, list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, 65)])::BIGINT AS d
          FROM vectors CROSS JOIN centroids{number}) GROUP BY row
)""")
        if number < rounds:
            parts.append(f"""moved{number} AS (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c
    FROM (SELECT best[2] AS cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n
          FROM near{number}, range(1, 65) AS places(i) GROUP BY best[2], i) GROUP BY cluster
), centroids{number + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.c, o.c) AS c FROM centroids{number} o LEFT JOIN moved{number} m USING (cluster)
)""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance, sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia,
       sum(best[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN centroids{rounds} ON cluster = best[2]
"""


ORACLE: dict[str, str] = {
    "op11_centroids": _clusters_sql(40, 5),
    "op8_topk": """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE)::DOUBLE FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND list_bool_and([x IS NOT NULL AND isfinite(coalesce(x, 0)) FOR x IN embedding])
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank,
       c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
QUALIFY rank <= 10
""",
    "op9_lines": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, len(lines) AS n_lines, pos, lines[pos] AS line,
           translate(trim(lines[pos], {_BLANKS}), '{_UPPER}', '{_UPPER.lower()}') AS key
    FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos FROM split)
), frequent AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT l.*, f.key IS NOT NULL AND l.doc_id <> f.keeper AS dropped
    FROM lines l LEFT JOIN frequent f ON l.key = f.key
), flips AS (
    SELECT *, dropped <> coalesce(lag(dropped) OVER (PARTITION BY doc_id ORDER BY pos), false) AS flip FROM judged
), ends AS (
    SELECT doc_id, list(pos - 1 ORDER BY pos) AS ends FROM flips WHERE flip GROUP BY doc_id
)
SELECT j.doc_id, max(j.n_lines)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256,
       list_concat(coalesce(any_value(e.ends), []), [max(j.n_lines)])::INTEGER[] AS keep_runs
FROM judged j LEFT JOIN ends e ON j.doc_id = e.doc_id GROUP BY j.doc_id
""",
}
