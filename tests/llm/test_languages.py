"""Language profiles: held-out accuracy, and vectors against their plain definition."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagespine.llm import languages


def test_bundle_is_the_sum_of_bound_letters():
    text = "Ab, c"
    symbols = [0, 1, 2, 0, 3, 0]
    vectors = languages._letters()[2].astype(int)
    plain = sum(np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c] for a, b, c in zip(symbols, symbols[1:], symbols[2:]))
    owner, run, count = languages._counted([text], [0])
    assert (languages._bundles(owner, run, count, 1)[0] == plain).all()


def test_held_out_accuracy(documents):
    rows = languages.identify(documents).join(documents.select("doc_id", "lang", F.length("text").alias("size")), "doc_id").collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert set(Counter(r.lang_pred for r in held)) == set(Counter(r.lang for r in held))


def test_only_text_and_learned_rows_count(documents):
    """Languages and sources of held-out rows, and sources of all rows, do not matter."""
    changed = documents.withColumn("lang", F.when(languages.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    assert sorted(languages.identify(changed).collect()) == sorted(languages.identify(documents).collect())


def test_result_does_not_depend_on_partitions(documents):
    assert sorted(languages.identify(documents.repartition(7)).collect()) == sorted(languages.identify(documents.coalesce(1)).collect())


def test_odd_documents(odd_documents):
    rows = languages.identify(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        if row.doc_id in (1, 2, 3, 11):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        elif row.doc_id is not None:
            assert row.lang_pred in ("en", "de", "fr")
        if row.doc_id is None:
            assert not row.held_out


def test_nothing_learned(odd_documents, no_documents):
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in languages.identify(unlabelled).collect()} == {"und"}
    assert languages.identify(no_documents).count() == 0


@pytest.mark.parametrize("text", ["", "  ", "12", "a", "ß", "\U0001d4b3"])
def test_short_texts(text):
    assert len(languages._runs(text)) == sum(c.isalpha() for c in text)
