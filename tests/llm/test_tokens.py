"""Token counts against the library on whole tables, all characters and odd texts."""

import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailtide.llm import tokens
from retailtide.llm.queries import op12_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [d["text"] or "" for d in docs]
    expected = [(d["doc_id"], len(t.encode()), n, n > 1024) for d, t, n in zip(docs, texts, library(texts), strict=True)]
    assert sorted(map(tuple, op12_tokens(spark, sf_dir).collect())) == sorted(expected)


def test_every_character_is_cut_as_the_library_cuts_it():
    counter = tokens.token_counter(PATH)
    library = Tokenizer.from_file(PATH).pre_tokenizer
    new = tokens.unassigned()
    signs = [chr(i) for i in range(sys.maxunicode + 1) if not (0xD800 <= i < 0xE000 or new[i])]
    assert len(signs) > 280_000
    for begin in range(0, len(signs), 1 << 10):
        text = "".join(f"a{c}1{c}{c}.{c} {c}\n" for c in signs[begin : begin + (1 << 10)])
        assert [m.span() for m in counter.cut.finditer(text)] == [span for _, span in library.pre_tokenize_str(text)]


def test_characters_newer_than_the_tables(library):
    counter = tokens.token_counter(PATH)
    texts = [f"the{chr(c)}the {chr(c)}7{chr(c)} <|endoftext|>{chr(c)}" for c in (0x558, 0x88F, 0x323B0, 0x10940, 0xFFFF, 0x10FFFF)]
    assert [counter.count(t) for t in texts] == library(texts)


def test_random_texts(library):
    draw = random.Random(5)
    parts = [*"ab'stmdrevl 019.,-_\t\n\r\x1c\x85 　éßЖ中ः²½́‍\U0001f600\x00", "'ll", "'ve", "'re", "'S", "  ", "\n\n", "the", " The", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(30))) for _ in range(5000)]
    counter = tokens.token_counter(PATH)
    assert [counter.count(t) for t in texts] == library(texts)


def test_long_texts_and_a_small_memory(monkeypatch, library):
    monkeypatch.setattr(tokens, "MEMORY", 100)
    monkeypatch.setattr(tokens, "LONG", 1000)
    draw = random.Random(6)
    words = ["".join(draw.choices("abcdefghij", k=draw.randrange(1, 90))) for _ in range(400)]
    texts = [" ".join(draw.choices(words, k=3000)), "x" * 20_000, " " * 5000, "\n \n" * 3000, "'s" * 2000]
    counter = tokens.TokenCounter(PATH)
    assert [counter.count(t) for t in texts] == library(texts)
    assert len(counter.words) <= len(counter.words.proven) + 101


def test_proven_words():
    tokenizer = Tokenizer.from_file(PATH)
    proven = tokens.proven_words(tokenizer)
    assert len(proven) > 49_000 and " the" in proven and "<|endoftext|>" not in proven
    assert all(len(tokenizer.encode(w, add_special_tokens=False).ids) == 1 for w in sorted(proven)[::97])


def test_odd_rows(spark, library):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "same", 5), (3, "same", 5), (4, "<|endoftext|>" * 3 + " x", 5), (5, "w " * 700, 5), (6, "w" + " w" * 1023, 5)]
    frame = spark.createDataFrame([(i, t, n, "id") for i, t, n in rows], "doc_id bigint, text string, n_tokens int, id string")
    found = sorted(map(tuple, tokens.token_counts(frame).collect()), key=str)
    texts = [t or "" for _, t, _ in rows]
    expected = [(i, len(t.encode()), n, n > 1024) for (i, _, _), t, n in zip(rows, texts, library(texts), strict=True)]
    assert found == sorted(expected, key=str)
    assert (6, 2047, 1024, False) in found
    assert tokens.token_counts(frame.limit(0)).collect() == []


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
