"""Token counts by the whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges the bytes of each. Before any
text is read, every string of the vocabulary is merged by the library's model alone;
those that come out as one token are proven. A pre-token that is proven counts one
without a merge; the rest are merged, each different one once while it is remembered.
"""

from __future__ import annotations

import functools
import os
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, text_slices

#: Pre-tokens beyond the proven ones that a worker remembers before it starts anew.
MEMORY = 500_000
#: Code points of a longer text that are cut into pre-tokens together.
LONG = 1 << 20
#: Longer pre-tokens are not remembered.
LONG_WORD = 64

# How the byte-level step cuts texts.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def proven_words(tokenizer) -> set[str]:
    """The vocabulary strings that the model gives back as one token, as they stand in a text."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    alone = [word for word, number in vocabulary.items() if [t.id for t in tokenizer.model.tokenize(word)] == [number]]
    as_bytes = {sign: byte for byte, sign in enumerate(byte_signs())}
    found = set()
    for word in alone:
        try:
            found.add(bytes(as_bytes[sign] for sign in word).decode())
        except (KeyError, UnicodeDecodeError):
            pass  # parts of a character are never a whole pre-token
    return found


def byte_signs() -> list[str]:
    """The sign by which byte-level vocabularies write each byte: printable Latin-1 as itself, others from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(others)) for byte in range(256)]


class WordCounts(dict):
    """Tokens of a pre-token; proven ones are there from the start, others are merged when asked for."""

    def __init__(self, tokenizer):
        self.merge = tokenizer.model.tokenize
        self.signs = str.maketrans(dict(enumerate(byte_signs())))
        self.proven = dict.fromkeys(proven_words(tokenizer), 1)
        super().__init__(self.proven)

    def __missing__(self, word: str) -> int:
        count = len(self.merge(word.encode().decode("latin-1").translate(self.signs)))
        if len(word) <= LONG_WORD:
            if len(self) > len(self.proven) + MEMORY:
                self.clear()
                self.update(self.proven)
            self[word] = count
        return count


class TokenCounter:
    """Counts the tokens of texts for one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path) as file:
            self._check(json.load(file))
        tokenizer = Tokenizer.from_file(path)
        self.words = WordCounts(tokenizer)
        self.cut = regex.compile(PRE_TOKENS)
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.library_cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.new_signs = unassigned()
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    @staticmethod
    def _check(told: dict) -> None:
        """The counts hold for tokenizers of this kind alone."""
        level, model = told["pre_tokenizer"] or {}, told["model"]
        added = [t for t in told["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        odd = told["normalizer"] or added or level.get("type") != "ByteLevel" or level.get("add_prefix_space") or not level.get("use_regex", True)
        if odd or model["type"] != "BPE" or any(model.get(n) for n in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
            raise ValueError("a byte-level BPE without normalizer, prefix space or stripping special tokens is needed")

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special token in it counts one."""
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        count = self.words.__getitem__
        if not text.isascii() and self.new_signs[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return sum(count(text[begin:end]) for _, (begin, end) in self.library_cut(text))
        if len(text) <= LONG:
            return sum(map(count, self.cut.findall(text)))
        # one pre-token at a time, so that a very long text needs no list of all
        return sum(count(found.group()) for found in self.cut.finditer(text))


def unassigned() -> np.ndarray:
    """Which code points Python's Unicode tables do not know.

    Newer tables may call them letters, so the library and the pattern may cut them in
    different ways; texts that hold one are cut by the library. The tests compare all others.
    """
    return np.fromiter((unicodedata.category(chr(i)) == "Cn" for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.cache
def token_counter(path: str) -> TokenCounter:
    """One counter for all tasks of a worker."""
    return TokenCounter(path)


def token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each whole text.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers`` library, or the
    name of one of the installed public tokenizers. No begin, end or other tokens are added;
    a special token that stands in a text counts one, as the library takes it by default.
    Null texts count as empty: no bytes, no tokens. Rows stay as many as they are, repeated
    ones and those with a null id too; other columns are not read; an empty table gives none.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if os.sep not in path:
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        counter = token_counter(path)
        for batch in batches:
            for part in text_slices(batch):
                texts = pc.fill_null(part.column("text"), "")
                sizes = pc.cast(pc.binary_length(texts), pa.int64())
                tokens = np.fromiter((counter.count(text.as_py()) for text in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("id"), sizes, pa.array(tokens), pa.array(tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    schema = f"id {picked.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_batches(picked, run, schema).withColumnRenamed("id", id_col)
