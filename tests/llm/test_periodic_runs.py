"""Runs against a comparison of all words with all periods; the wavelet tree against a scan; the query's columns."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from pagespine.llm import periodic_runs, queries


def plain_runs(words):
    """(start, length, period) of all runs, period by period."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def made_text(draw, size):
    letters, words = draw.choice(["a", "ab", "abc", "abcdefghij"]), []
    while len(words) < size:
        if draw.random() < 0.5:
            unit = [draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 24, 33, 40]))]
            if draw.random() < 0.3:
                unit = unit * draw.choice([1, 2, 3, 5]) + [draw.choice(letters)]
            words += (unit * 8)[: int(len(unit) * draw.uniform(1, 6))]
        else:
            words += [draw.choice(letters) for _ in range(draw.choice([1, 2, 10, 20]))]
    return " ".join(words)


def test_successor():
    draw = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 200):
        values = draw.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        low = draw.integers(0, n + 1, 300)
        high = np.maximum(low, draw.integers(0, n + 1, 300))
        least = draw.integers(0, n, 300)
        plain = [min((v for v in values[a:b].tolist() if v >= x), default=n) for a, b, x in zip(low, high, least, strict=True)]
        assert tree.successor(low, high, least).tolist() == plain


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_made_texts(seed):
    draw = random.Random(seed)
    for _ in range(25):
        texts = [made_text(draw, draw.choice([0, 5, 23, 24, 100, 300])) for _ in range(draw.choice([1, 2, 6]))]
        for text, (n, runs, collapsed) in zip(texts, periodic_runs.find(texts), strict=True):
            words = split(text)
            expected = plain_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == expected
            assert (n, collapsed) == (len(words), plain_collapsed(words, expected))


def test_borders():
    unit = [f"w{i}" for i in range(20)]
    cases = {
        " ".join("a" * 23): [], " ".join("a" * 24): [(0, 24, 1)], " ".join(["x"] + ["a", "b"] * 12): [(1, 24, 2)],
        " ".join(unit * 3): [(0, 60, 20)], " ".join((unit * 3)[:-1]): [], " ".join(["a"] * 30 + ["b"] * 30): [(0, 30, 1), (30, 30, 1)],
    }
    assert [[(r["start"], r["length"], r["period"]) for r in runs] for _, runs, _ in periodic_runs.find(list(cases))] == list(cases.values())


def test_neighbouring_texts_stay_apart():
    assert all(not runs for _, runs, _ in periodic_runs.find(["a " * 12] * 50))


def test_texts_cut_in_parts(monkeypatch):
    draw = random.Random(9)
    texts = [made_text(draw, 200) + " \n\t x\x0b" for _ in range(10)]
    whole = periodic_runs.find(texts)
    monkeypatch.setattr(periodic_runs, "PART_BYTES", 7)
    assert periodic_runs.find(texts) == whole


@pytest.mark.parametrize("text, n_runs", [("a " * 400_000, 1), ("a a a b " * 100_000, 1), ("x y " * 40_000 + "z " + "x y " * 40_000, 2)])
def test_very_long_texts(text, n_runs):
    start = time.time()
    ((_, runs, _),) = periodic_runs.find([text])
    assert len(runs) == n_runs and time.time() - start < 60


def expected_row(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


def query(monkeypatch, spark, docs):
    monkeypatch.setattr(queries, "_table", lambda spark, sf_dir, name: docs)
    return queries.op12_periodic_runs(spark, "")


def test_documents(monkeypatch, spark, documents):
    short = documents.filter("length(text) < 4000 OR text IS NULL")
    expected = [expected_row(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()]
    assert sum(row[1] for row in expected) > 50
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in query(monkeypatch, spark, short).collect())


def test_odd_documents(monkeypatch, spark, odd_documents):
    docs = odd_documents.filter("doc_id IS NULL OR doc_id NOT IN (9)").unionByName(odd_documents.selectExpr("doc_id + 1000 as doc_id", *odd_documents.columns[1:]))
    docs = docs.filter("length(text) < 5000 OR text IS NULL")
    expected = [expected_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in query(monkeypatch, spark, docs).collect())


def test_empty_table(monkeypatch, spark, no_documents):
    assert query(monkeypatch, spark, no_documents).count() == 0
