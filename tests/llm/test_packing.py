"""Packing: ids against the tokenizer itself, first fit decreasing against a plain scan, whole sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagespine.llm import packing


@pytest.fixture(scope="session")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def word_ids():
    return packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", "Hello, World!! it's o'clock", "l'été Été ÉTÉ ß STRASSE naïve Ωμέγα ΣΟΦΌΣ ΣΣ ΑΣ.", "a\x0bb\x0cc\x85d\xa0e f\x1cg", "é ẞ İstanbul ıI",
    "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> A<|b|>C", "12 345 ½ ² 一二三 مرحبا 😀👍🏽 a😀b", "\x00\x01 a\x02b", "x" * 3000, "...,,;;||--- (a) [b] 'S 'll don'T Å K",
    "µ ªº ×÷ a÷b µm ŒUVRE ǅ ŉ",
])
def test_ids_are_the_tokenizers(word_ids, tokenizer, text):
    assert ids_of(word_ids.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_all_documents(word_ids, tokenizer, documents):
    texts = [r.text for r in documents.collect()]
    for text, whole in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert ids_of(word_ids.encode(text)) == whole.ids


def test_first_fit_decreasing():
    draw = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 300):
        lengths = draw.integers(1, 101, n)
        sequence, offset = packing.first_fit_decreasing(lengths, 100)
        rooms = []
        for i in np.argsort(-lengths, kind="stable"):
            fit = next((k for k, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
            if fit == len(rooms):
                rooms.append(100)
            assert (sequence[i], offset[i]) == (fit, 100 - rooms[fit])
            rooms[fit] -= lengths[i]


def check(docs, rows, tokenizer, length):
    expected = []
    for doc in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), length):
            part = ids[at : at + length]
            expected.append((doc.doc_id, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:5]) for r in rows)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sum(r.length for r in rows) / (length * len(sequences))


def test_documents(documents, tokenizer):
    assert check(documents, packing.pack(documents).collect(), tokenizer, packing.LENGTH) > 0.99


@pytest.mark.parametrize("length, group", [(2048, 20_000), (7, 50)])
def test_odd_documents(odd_documents, tokenizer, length, group):
    docs = odd_documents.filter("length(text) < 10000 OR text IS NULL")
    check(docs, packing.pack(docs, length, group_pieces=group).collect(), tokenizer, length)


def test_empty_table(no_documents):
    assert packing.pack(no_documents).count() == 0


