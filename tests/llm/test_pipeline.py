"""The pipeline against a plain computation of every stage, and its registration."""

import importlib
import os
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagespine.llm import quality
from pagespine.llm.queries import ORACLES, QUERIES
from tests.llm import test_contamination, test_lines, test_near_duplicates, test_packing
from tests.llm.conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain_quality_kept(rows):
    measured = quality.measure([text for _, text in rows])
    names = [part.split()[0] for part in quality.MEASURES.split(", ")]
    for row, values in zip(rows, measured, strict=True):
        scope = dict(zip(names, values, strict=True))
        if not any(eval(fails.replace("OR", "or"), {}, scope) for _, fails in quality.RULES):
            yield row


def plain_stages(rows, items):
    rows = list(plain_quality_kept(rows))
    yield sorted(rows)
    rows = [(doc, text) for doc, text, _, _ in test_lines.plain(rows)]
    yield sorted(rows)
    kept = {doc for doc, _, _, keep in test_near_duplicates.plain_components(rows) if keep}
    rows = [r for r in rows if r[0] in kept]
    yield sorted(rows)
    clean = {doc for doc, _, n, _ in test_contamination.plain(rows, items) if not n}
    rows = [r for r in rows if r[0] in clean]
    yield sorted(rows)


def test_stages(spark, documents, tmp_path):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    docs = documents
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain_stages(rows, items), strict=False):
        out = stage(spark, docs, SF)
        assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == expected
        assert expected
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    test_packing.check(docs, packed, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 2048)
    whole = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")
    assert sorted(map(tuple, whole.collect())) == sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed)


def test_odd_documents(spark, odd_documents):
    docs = odd_documents.filter("length(text) < 50000 OR text IS NULL")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_documents.columns
    assert {r.doc_id for r in docs.collect()} == {4}
    assert corpus_pipeline.pack(spark, docs, SF).count() == 1


def test_no_documents(spark, no_documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, SF).count() == 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES if name != "pipeline"}
    assert set(QUERIES) <= set(entry.queries())


def test_entry_without_this_part(tmp_path):
    """What remains when the folders of this part are gone still imports."""
    for name in os.listdir(ROOT):
        if name not in ("pagespine", "corpus_pipeline.py", ".git"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    (tmp_path / "pagespine").mkdir()
    for name in os.listdir(f"{ROOT}/pagespine"):
        if name != "llm":
            os.symlink(f"{ROOT}/pagespine/{name}", tmp_path / "pagespine" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'block_text' in q and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


@pytest.mark.parametrize("name", ["n_chars", "kept"])
def test_clashing_names(spark, documents, name):
    docs = documents.limit(50).withColumn(name, F.lit(5))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_queries_equal_sql(spark):
    """Where SQL can express an operator, both give the same rows."""
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name, statement in ORACLES.items():
        found, wanted = QUERIES[name](spark, SF), duck.execute(statement)
        columns = [c[0] for c in wanted.description]
        assert sorted(columns) == sorted(found.columns)
        assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, wanted.fetchall())), name
