"""Byte-level BPE against the public library, round trips, and the hash table against a dictionary."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pagespine.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.vocabulary()


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_pair_table():
    draw = np.random.default_rng(3)
    keys = {(int(a), int(b)): k for k, (a, b) in enumerate(draw.integers(0, 300, (5000, 2)))}
    table = byte_bpe.PairTable(*np.array([(a, b, k) for (a, b), k in keys.items()]).T)
    asked = draw.integers(-1, 320, (40, 500, 2))
    found = table.look_up(asked[..., 0], asked[..., 1])
    assert all(found[i, j] == keys.get(tuple(asked[i, j].tolist()), byte_bpe.NONE) for i in range(40) for j in range(500))


@pytest.mark.parametrize("text", [
    "", "a", "Hello world, it's o'clock'll", " \n\n  a \t", "=" * 1000, "  " * 900, "漢字" * 400, "é" * 700, "x" * 3000, "ab" * 2000, "<|endoftext|> <|x|>",
    "\x1c\x1d\x85\xa0  a", "𝒳 ☃ मनीष مرحبا 😀👍🏽", "\x00\x01\x7f", "࢏\U00010940 a࢏ \U00011de0 12", "¼½ ²³ 一二三",
])
def test_ids_are_the_librarys(bpe, library, text):
    (ids,) = bpe.encode([text])
    assert ids_of(ids) == library.encode_ordinary(text)
    assert byte_bpe.decode(ids).decode() == text


def test_random_words(bpe, library):
    draw = np.random.default_rng(11)
    texts = []
    for letters in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "0123456789", "=-_ ", "éàü漢字ßa", "ab "):
        for size in (3, 40, 255, 256, 257, 600, 2500):
            texts.append("".join(draw.choice(list(letters), size)))
    assert [ids_of(ids) for ids in bpe.encode(texts)] == [library.encode_ordinary(text) for text in texts]


def test_long_row_takes_single_merges(bpe):
    """Merging many places in a round gives what merging one after another gives."""
    draw = np.random.default_rng(5)
    for letters in (b"ab", b"aab=", b"etaoinshr", bytes(range(256))):
        for size in (2, 3, 9, 60, 200):
            data = np.frombuffer(bytes(draw.choice(list(letters), size).tolist()), np.uint8)
            ids = bpe.single[data]
            assert byte_bpe.merge_long(ids.copy(), bpe.pairs) == byte_bpe.merge_rows(ids[None, :].copy(), bpe.pairs)[0]


def test_bounded_memory_ways(bpe, library, monkeypatch, documents):
    """Forgetting words, small matrices and cutting a text in parts change nothing."""
    texts = [r.text for r in documents.limit(60).collect()]
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    monkeypatch.setattr(byte_bpe, "CELLS", 64)
    monkeypatch.setattr(byte_bpe, "WORDS_AT_ONCE", 37)
    assert [ids_of(ids) for ids in bpe.encode(texts)] == [library.encode_ordinary(text or "") for text in texts]


def check(docs, rows, library):
    expected = []
    for doc in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode_ordinary(doc.text or ""), "<u4").tobytes()
        expected.append((doc.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((doc.text or "").encode()).hexdigest()))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(row)) for row in rows)


def query(monkeypatch, spark, docs):
    monkeypatch.setattr(queries, "_table", lambda spark, sf_dir, name: docs)
    return queries.op11_byte_bpe(spark, "").collect()


def test_documents(monkeypatch, spark, documents, library):
    check(documents, query(monkeypatch, spark, documents), library)


def test_odd_documents(monkeypatch, spark, odd_documents, library):
    check(odd_documents, query(monkeypatch, spark, odd_documents), library)


def test_separate_steps(odd_documents):
    apart = byte_bpe.decoded(byte_bpe.encoded(odd_documents)).collect()
    assert sorted(map(repr, apart)) == sorted(map(repr, byte_bpe.round_trip(odd_documents).collect()))


def test_empty_table(monkeypatch, spark, no_documents):
    assert query(monkeypatch, spark, no_documents) == []


def test_very_long_text(bpe, library):
    text = "un été à la mer, 12 fois; " * 80_000 + "x" * 100_000
    assert ids_of(bpe.encode([text])[0]) == library.encode_ordinary(text)
