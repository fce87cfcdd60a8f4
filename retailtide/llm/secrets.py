"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests singles out.

Each long run of key characters is read in the encoding its characters suggest. Three
tests look at it: chi-squared uniformity over the alphabet, runs of character classes, and
serial correlation. A run is a secret if none of them speaks against chance and together
they speak against ordinary text, at a level that holds the share of false finds over
the whole table down, length class by length class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .batches import map_batches, text_slices

#: The patterns, in the order in which kinds are listed, and the least length of a match (or of its group).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, LEAST_ACCESS = r"AKIA[A-Z0-9]+", 20
HEX, LEAST_HEX = r"[0-9a-f]+", 24
LEAST_ASSIGN = 6
KINDS = ("assign", "access", "hex", "random")

#: Characters of a run that is tested, at least.
LEAST_RUN = 20
#: Share of false finds among those of a length class, and the level of each test against chance.
FALSE_SHARE, CHANCE_LEVEL = 0.001, 0.001
#: Length classes begin at these lengths.
CLASSES = (20, 24, 32, 40, 48, 64, 96, 128)
#: Steps of -log10 p, by which finds are counted over the table.
P_STEPS, P_SCALE = 400, 10

# Letters of the keyword may be in either case, those of no other alphabet.
_ASSIGN = re.compile("(?ai:" + ASSIGN.split(")")[0] + "))" + ASSIGN.split(")", 1)[1])
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX.replace("+", f"{{{LEAST_HEX},}}"))
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
# what any of them needs; texts without it are not looked at
_MAYBE = rf"(?i:password|passwd|secret|token|api_?key)|AKIA|[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"

#: Alphabets, the narrowest first, and the chance that two characters of ordinary text or
#: of a decimal number over it are equal (estimates for Latin scripts; 1/10 for numbers).
_ALPHABETS = (
    ("hex", "0123456789abcdef", 0.1),
    ("HEX", "0123456789ABCDEF", 0.1),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.066),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz", 0.066),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.06),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", 0.06),
)
_SETS = [(name, set(letters), letters, same) for name, letters, same in _ALPHABETS]


def fixed_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_z(x: float, df: float) -> float:
    """Normal score of a chi-squared value (Wilson and Hilferty)."""
    return ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))


def battery(run: str) -> tuple[str, float, float]:
    """(encoding, p of chance, p of text) of one run.

    The first is the least of the three tests' p values under uniform random characters,
    times three; the second that of text as uniform and as mixed as this.
    """
    body = run.rstrip("=")
    marks = set(body)
    name, _, letters, same = next(a for a in _SETS if marks <= a[1]) if marks <= _SETS[-1][1] else _SETS[-1]
    code = {c: i for i, c in enumerate(letters)}
    values = np.array([code[c] for c in body if c in code], dtype=np.float64)
    n, k = len(values), len(letters)
    if n < 2:
        return name, 0.0, 1.0
    counts = np.bincount(values.astype(int), minlength=k)
    # 1. uniformity over the alphabet
    chi = float((counts**2).sum() * k / n - n)
    uniform = _chi2_z(max(chi, 1e-9), k - 1)
    # text: the same statistic has a shifted, scaled law (Patnaik)
    shift = (n - 1) * max(0.0, k * same - 1)
    scale = (k - 1 + 2 * shift) / (k - 1 + shift)
    textual = _chi2_z(max(chi, 1e-9) / scale, (k - 1 + shift) ** 2 / (k - 1 + 2 * shift))
    # 2. runs of the classes lower case, upper case and digit
    kind = np.array([0 if c.islower() else 1 if c.isupper() else 2 for c in body if c in code])
    share = np.bincount(np.array([0 if c.islower() else 1 if c.isupper() else 2 for c in letters]), minlength=3) / k
    change = 1 - float((share**2).sum())
    changes = int((kind[1:] != kind[:-1]).sum())
    spread = math.sqrt(max(change * (1 - change) * (n - 1), 1e-9))
    mixed = (changes - change * (n - 1)) / spread
    # text changes class about once in eight characters: a capital, a number
    rare = 0.12
    plain = (changes - rare * (n - 1)) / math.sqrt(rare * (1 - rare) * (n - 1))
    # 3. serial correlation of neighbours
    centred = values - (k - 1) / 2
    serial = float((centred[1:] * centred[:-1]).sum()) / ((k * k - 1) / 12 * math.sqrt(n - 1))
    chance = min(1.0, 3 * min(_upper(uniform), 2 * _upper(abs(mixed)), 2 * _upper(abs(serial))))
    text = _upper((plain - textual) / math.sqrt(2))
    return name, chance, text


def runs(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, encoding, p of text) of the runs in ``text`` that no test finds unlike chance."""
    found = []
    for m in _RUN.finditer(text):
        name, chance, plain = battery(m[0])
        if chance >= CHANCE_LEVEL:
            found.append((m.start(), m.end(), name, plain))
    return found


def _class(length: int) -> int:
    return sum(length >= c for c in CLASSES)


def _look(texts: pa.Array) -> tuple[list, list]:
    """Fixed spans and tested runs of each text."""
    texts = pc.fill_null(texts, "")
    maybe = pc.match_substring_regex(texts, _MAYBE).to_numpy(zero_copy_only=False)
    fixed, tested = [[]] * len(texts), [[]] * len(texts)
    for row in np.flatnonzero(maybe):
        text = texts[row].as_py()
        fixed[row] = [{"kind": k, "start": a, "end": b} for k, a, b in fixed_spans(text)]
        # p goes as steps of its logarithm, so that equal ones compare alike everywhere
        tested[row] = [
            {"start": a, "end": b, "encoding": e, "size": _class(b - a), "step": min(P_STEPS, int(-P_SCALE * math.log10(max(p, 1e-300))))}
            for a, b, e, p in runs(text)
        ]
    return fixed, tested


_FIXED = "array<struct<kind:string,start:bigint,end:bigint>>"
_TESTED = "array<struct<start:bigint,end:bigint,encoding:string,size:int,step:int>>"


def levels(tested: DataFrame) -> DataFrame:
    """(size, least): the step that finds of each length class must reach (Benjamini and Hochberg, by classes).

    ``tested`` has one row per run that was tested, with ``size`` and ``step``. Counts per
    class and step are all that is gathered: a few thousand numbers at any table size.
    """
    counts = tested.groupBy("size", "step").count().toPandas()
    rows = []
    for size, own in counts.groupby("size"):
        total = own["count"].sum()
        own = own.sort_values("step", ascending=False)
        beyond = own["count"].cumsum()
        # a step stands for p values up to 10 ** (-step / scale)
        good = own["step"][(10.0 ** (-own["step"] / P_SCALE)) * total <= FALSE_SHARE * beyond]
        if len(good):
            rows.append((int(size), int(good.min())))
    return tested.sparkSession.createDataFrame(rows, "size int, least int")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fixed, random) of each row: spans of the fixed patterns, and of runs that look random, in code points.

    ``fixed`` are (kind, start, end), leftmost and without overlap per kind; ``random`` are
    (start, end, encoding), in order, leaving out those that lie within a fixed span. A null
    text counts as empty. Only the two named columns are read; repeated rows give repeated
    results, though each counts among the runs of the table. An empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        tested_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("size", pa.int32()), ("step", pa.int32())]))
        for batch in batches:
            for part in text_slices(batch):
                fixed, tested = _look(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(fixed, fixed_type), pa.array(tested, tested_type)], names=["id", "fixed", "tested"]
                )

    id_type = picked.schema["id"].dataType.simpleString()
    looked = stored(map_batches(picked, run, f"id {id_type}, fixed {_FIXED}, tested {_TESTED}"), "secrets")
    least = {row["size"]: row["least"] for row in levels(looked.select(F.explode("tested").alias("t")).select("t.size", "t.step")).collect()}
    bar = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else F.lit(None).cast("map<int,int>")

    def random(t):
        covered = F.exists("fixed", lambda s: (s["start"] <= t["start"]) & (t["end"] <= s["end"]))
        return F.coalesce(t["step"] >= F.try_element_at(bar, t["size"]), F.lit(False)) & ~covered

    kept = F.transform(F.filter("tested", random), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["encoding"].alias("encoding")))
    return looked.select(F.col("id").alias(id_col), "fixed", kept.alias("random"))
