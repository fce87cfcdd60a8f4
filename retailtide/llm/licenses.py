"""License notices in texts: winnowed template fingerprints, an inverted index, banded alignment.

Of each window of neighbouring word runs of a template the smallest hash is kept
(winnowing), so that any stretch of ``RUN + WINDOW - 1`` words that a text shares with a
template holds an indexed run. Runs of a text that the index knows pick a template and a
place in the text; there the two are aligned, word by word, in a band around the diagonals
of the runs. The alignment gives the matched share of the template and the span; of templates
that claim one span the best stays, and none whose version differs.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Words, map_batches, mix, text_slices, word_hashes

#: Words of an indexed run, and neighbouring runs of which one is kept.
RUN, WINDOW = 3, 2
#: Share of a template's words that an alignment must match.
MIN_COVERAGE = 0.8
#: Diagonals on either side of those of the indexed runs.
MARGIN = 4

#: Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "ISC grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so"
    ),
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Licenses of one wording, by family, name and version.
GNU = (
    ("GPL", "General Public License", "program", ("1", "2", "3")),
    ("LGPL", "Lesser General Public License", "library", ("2.1", "3")),
    ("AGPL", "Affero General Public License", "program", ("3",)),
)
CREATIVE_COMMONS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CREATIVE_COMMONS_VERSIONS = ("2.0", "2.5", "3.0", "4.0")

for _family, _name, _work, _versions in GNU:
    for _version in _versions:
        _key = f"{_family}-{_version}" if "." in _version else f"{_family}-{_version}.0"
        TEMPLATES[_key] = f"This work is licensed under the GNU {_name}, version {_version}."
        TEMPLATES[f"{_key} name"] = f"GNU {_name}, version {_version}"
        TEMPLATES[f"{_key} header"] = (
            f"This {_work} is free software: you can redistribute it and/or modify it under the terms of the GNU {_name} as published "
            f"by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version."
        )
for _kind in CREATIVE_COMMONS:
    for _version in CREATIVE_COMMONS_VERSIONS:
        TEMPLATES[f"CC-{_kind}-{_version}"] = f"Licensed under CC {_kind} {_version}."


def version_runs(text: str, words: np.ndarray) -> list[tuple[int, ...]]:
    """The runs of neighbouring words of ``text`` that are numbers, as hashes."""
    plain = [word.decode() for word in _written(text)]
    runs: list[list[int]] = []
    for place, word in enumerate(plain):
        if word.isdecimal():
            if place and plain[place - 1].isdecimal():
                runs[-1].append(int(words[place]))
            else:
                runs.append([int(words[place])])
    return [tuple(run) for run in runs]


def _written(text: str) -> list[bytes]:
    found = Words(pa.array([text], pa.string()))
    return [found.data[i:j].tobytes() for i, j in zip(found.start, found.end, strict=True)]


def holds(region: np.ndarray, run: tuple[int, ...]) -> bool:
    """The words of ``run`` stand in ``region``, one after the other."""
    found = region.tolist()
    return any(tuple(found[i : i + len(run)]) == run for i in range(len(found) - len(run) + 1))


def run_hashes(words: np.ndarray, size: int = RUN) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring words."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    count = len(words) - size + 1
    total = words[:count]
    with np.errstate(over="ignore"):
        for i in range(1, size):
            total = mix(total * np.uint64(3) + words[i : i + count])
    return total


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash of each window, the rightmost of equal ones; of all hashes if they are fewer."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    window = min(window, len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int, int, int]:
    """The best local alignment within diagonals ``low`` to ``high`` (text place minus template place).

    (matched words, template begin and end, text begin and end). A match counts 1, a
    replaced, left out or added word -1; the first of equal alignments is taken.
    """
    width = high - low + 3  # a column of zeros on either side
    score = np.zeros((len(template) + 1, width), dtype=np.int32)
    came = np.zeros((len(template) + 1, width), dtype=np.int8)
    best = (0, 0, 0)
    for i in range(1, len(template) + 1):
        for c in range(1, width - 1):
            j = i + low + c - 1  # words of the text so far
            if not 0 < j <= len(text):
                continue
            same = template[i - 1] == text[j - 1]
            options = ((score[i - 1, c] + (1 if same else -1), 1), (score[i - 1, c + 1] - 1, 2), (score[i, c - 1] - 1, 3))
            value, step = max(options, key=lambda o: (o[0], -o[1]))
            if value > 0:
                score[i, c], came[i, c] = value, step
                if value > best[0]:
                    best = (int(value), i, c)
    _, i, c = best
    matched, t_end, d_end = 0, i, i + low + c - 1
    while came[i, c]:
        step = came[i, c]
        if step == 1:
            matched += bool(template[i - 1] == text[i + low + c - 2])
            i -= 1
        elif step == 2:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return matched, i, t_end, i + low + c - 1, d_end


@dataclass
class Index:
    """Templates by name, and where their kept runs stand."""

    templates: dict[str, str]
    words: list[np.ndarray] = field(init=False)
    places: dict[int, list[tuple[int, int]]] = field(init=False)

    def __post_init__(self) -> None:
        self.words = [word_hashes(text) for text in self.templates.values()]
        self.versions = [version_runs(text, words) for text, words in zip(self.templates.values(), self.words, strict=True)]
        self.places = defaultdict(list)
        for number, words in enumerate(self.words):
            hashes = run_hashes(words)
            for place in winnow(hashes):
                self.places[int(hashes[place])].append((number, int(place)))
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[[key >> 44 for key in self.places]] = True

    def matches(self, words: Words, min_coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, template, matched words, first and end word) of each passage, in order.

        The version numbers of a template must stand in the passage. Of templates that meet in some
        words that with most matched words stays, of these that of the greatest coverage, then the first.
        """
        best: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        for found in self.candidates(words, min_coverage):
            best[found[0]].append(found)
        for _, found in sorted(best.items()):
            kept: list[tuple[int, int, int, int, int]] = []
            for one in sorted(found, key=lambda f: (-f[2], len(self.words[f[1]]), f[1], f[3])):
                place = bisect(kept, one[3], key=lambda k: k[3])
                if (not place or kept[place - 1][4] <= one[3]) and (place == len(kept) or one[4] <= kept[place][3]):
                    kept.insert(place, one)
            yield from kept

    def candidates(self, words: Words, min_coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
        """The passages of each template by itself."""
        hashes = run_hashes(words.hash)
        hits = defaultdict(list)
        for at in np.flatnonzero(self.maybe[hashes >> np.uint64(44)]):
            if words.doc[at] == words.doc[at + RUN - 1]:
                for number, place in self.places.get(int(hashes[at]), ()):
                    hits[int(words.doc[at]), number].append((int(at), place))
        for (doc, number), found in sorted(hits.items()):
            template = self.words[number]
            low, high = words.first[doc], words.first[doc + 1]
            # hits of one passage lie on nearby diagonals and not far apart
            passages: list[list[tuple[int, int]]] = []
            for at, place in found:
                last = passages[-1][-1] if passages else None
                if last and at - last[0] <= len(template) and abs((at - place) - (last[0] - last[1])) <= MARGIN:
                    passages[-1].append((at, place))
                else:
                    passages.append([(at, place)])
            end_before = low
            for passage in passages:
                diagonals = [at - place for at, place in passage]
                begin = max(end_before, min(diagonals) - MARGIN)
                region = words.hash[begin : min(high, max(diagonals) + len(template) + MARGIN)]
                matched, _, _, first, end = align(template, region, min(diagonals) - MARGIN - begin, max(diagonals) + MARGIN - begin)
                named = all(holds(region[first:end], run) for run in self.versions[number])
                if matched >= min_coverage * len(template) and matched and named:
                    yield doc, number, matched, int(begin + first), int(begin + end)
                    end_before = begin + end


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(id, license, matched, template_words, coverage, start_word, end_word, start, end) of each notice in each row.

    Words are runs of letters and digits, A-Z as a-z; ``start`` and ``end`` are code points, end
    exclusive. A template shorter than a run is never found, nor is anything in a null or
    empty text. A passage has one license, the best (see :meth:`Index.matches`). Each passage of a text is given; repeated rows give repeated results; an
    empty table gives none. Other columns are not read. The templates are an argument,
    so they fit the driver and every task.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    given = dict(TEMPLATES if templates is None else templates)
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), T.StructField("license", T.StringType())])
    for name in ("matched", "template_words", "coverage", "start_word", "end_word", "start", "end"):
        schema = schema.add(name, T.DoubleType() if name == "coverage" else T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(given)
        names = list(given)
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                rows = []
                for doc, number, matched, first, end in index.matches(words, min_coverage):
                    base, size = words.offsets[doc], len(index.words[number])
                    chars = [len(words.data[base:place].tobytes().decode()) for place in (words.start[first], words.end[end - 1])]
                    rows.append((doc, names[number], matched, size, matched / size, first - words.first[doc], end - words.first[doc], *chars))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 9
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))],
                    names=schema.names,
                )

    return map_batches(picked, run, schema).withColumnRenamed("id", id_col)
