import os
import subprocess
import sys

import duckdb
import pytest
from pyspark import cloudpickle

import __spark_entry__ as entry
from checks import compare, oracles
from checks.queries import PREDICATES, QUERIES
from pagespine.operators import clusters

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_query_has_sql():
    assert set(QUERIES) - set(oracles.WITHOUT_SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_queries_equal_sql(spark):
    names = [*PREDICATES, "discover_documents", "reject_malformed", "skipped_documents", "heading_score", "nonblank_lines", "write_stage", "line_style", "blocks_raw", "feature_vectors", "read_blocks", "rule_labels", "document_kmeans", "post_process", "run_report", "outlines_end_to_end"]
    assert compare.main(SF_DIR, *names) == []


@needs_data
@pytest.mark.parametrize("name", list(PREDICATES))
def test_every_text_test_has_hits_and_misses(name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    values = set(duck.execute(f"SELECT DISTINCT {name} FROM ({entry.oracle_sql()[name]})").df()[name])
    assert len(values) >= 2


def test_executors_need_no_copy_of_the_package(spark, tmp_path):
    (tmp_path / "udf").write_bytes(cloudpickle.dumps(clusters._point_labeller(2).func))
    code = (
        "import pyarrow as pa; from pyspark import cloudpickle; f = cloudpickle.load(open('udf', 'rb'));"
        "p = pa.array([[[0.0] * 7, [9.0] * 7, [1.0] * 7], [[5.0] * 7]]); s = pa.array([[1.0, 2.0, None], [1.0]]);"
        "print(f(p, s).to_pylist(), f(p.slice(1), s.slice(1)).to_pylist())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[{'labels': [1, 0, 1], 'settled': True}, {'labels': [0], 'settled': True}] [{'labels': [0], 'settled': True}]", done.stderr
