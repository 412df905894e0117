"""Contamination against a plain search for every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagespine.llm import contamination
from tests.llm.conftest import SF


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, window=contamination.WINDOW):
    windows = {}
    for name, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(name) if name is not None else "null")
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, names = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        out.append((doc_id, len(words), len(hit), tuple(sorted(names))))
    return sorted(out, key=repr)


def result(found):
    return sorted(((r.doc_id, r.n_words, sum(h.e - h.s for h in r.hits), tuple(r.items)) for r in found.collect()), key=repr)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_documents(documents, benchmark):
    found = contamination.scan(documents, benchmark)
    expected = plain(documents.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect())
    assert result(found) == expected
    assert 0 < sum(n > 0 for _, _, n, _ in expected) < len(expected)
    kept = {r.doc_id for r in contamination.clean(documents, benchmark).collect()}
    assert kept == {i for i, _, n, _ in expected if not n}


@pytest.mark.parametrize("block_bytes", [1 << 20, 200, 1])
def test_random_texts(spark, block_bytes):
    draw = random.Random(5)

    def text(n):
        return " ".join(draw.choice(["a", "b", "C", "ü"]) for _ in range(n))

    items = [(i, text(draw.choice([0, 1, 2, 5, 12, 14]) or 0)) for i in range(6)] + [(3, text(13)), (None, text(12)), (9, None), (10, "--")]
    items = [x for x in items if len(plain_words(x[1])) != 1] if block_bytes == 1 else items
    docs = [(i, text(draw.randrange(60)) + "\n" + (draw.choice(items)[1] or "")) for i in range(40)] + [(None, None), (7, ""), (8, "a-a"), (8, "a-a")]
    found = contamination.scan(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes
    )
    assert result(found) == plain(docs, items)


def test_matches_are_maximal_and_verbatim(documents, benchmark):
    texts = {r.doc_id: plain_words(r.text) for r in documents.collect()}
    items = {str(r.item_id): plain_words(r.text) for r in benchmark.collect()}
    for row in contamination.scan(documents, benchmark).filter("size(matches) > 0").collect():
        words = texts[row.doc_id]
        for m in row.matches:
            item = items[m.item_id]
            assert words[m.start : m.start + m.length] == item[m.item_start : m.item_start + m.length]
            assert m.length >= min(contamination.WINDOW, len(item))
            before = m.start and m.item_start and words[m.start - 1] == item[m.item_start - 1]
            after = words[m.start + m.length : m.start + m.length + 1] == item[m.item_start + m.length : m.item_start + m.length + 1] != []
            assert not before and not after


def test_odd_documents(odd_documents, benchmark):
    found = contamination.scan(odd_documents, benchmark)
    assert result(found) == plain(odd_documents.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect())
    clean = contamination.clean(odd_documents.withColumn("contamination", F.lit(1)), benchmark)
    assert clean.columns == [*odd_documents.columns, "contamination"]


def test_empty_tables(odd_documents, no_documents, benchmark):
    assert contamination.scan(no_documents, benchmark).count() == 0
    assert contamination.clean(odd_documents, benchmark.limit(0)).count() == odd_documents.count()
