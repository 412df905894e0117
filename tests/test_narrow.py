"""Tables that the queries derive from the documents hold what the steps on them ask for, and give what whole rows gave."""

import pytest
from pyspark.sql import functions as F

from checks import tables
from checks.queries import QUERIES
from pagespine.functions import text as T
from pagespine.operators import corpus_model, layout, postprocess
from pagespine.operators.spread import PLACE, dealt
from pagespine.plans import outlines as plan
from pagespine.session import stage_table

TEXT = "\n".join(f"Line {n} of a text with more words than a heading of fifteen words may have, as {n} lines show" for n in range(30))


@pytest.fixture()
def given(spark, tmp_path):
    rows = [(n, f"Heading {n}\n{TEXT[n:]}") for n in range(6)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_positions_are_counted_where_blocks_lie(spark):
    pages = [("long", p, n) for p in (0, 255, 256, 900) for n in range(3)] + [("short", p, n) for p in range(4) for n in range(2)]
    df = spark.createDataFrame([(d, p, (p << 32) + n) for d, p, n in pages], "document_name string, page_number int, seq bigint")
    short = stage_table(dealt(df.filter("document_name = 'short'")), "short", PLACE)
    assert exchanges(layout.list_positions(short)) == 0
    placed = stage_table(dealt(df), "both", PLACE)
    shown = ["document_name", "seq", "position"]
    found = rows_of(layout.list_positions(placed).select(*shown))
    assert found == rows_of(layout.list_positions(df).select(*shown))
    assert [r[2] for r in sorted(found) if r[0] == "short"] == list(range(8))


def test_style_and_cluster_queries_store_no_texts(spark, given, monkeypatch):
    kept = {}

    def spied(df, name, by=None):
        kept[name] = df.columns
        return stage_table(df, name, by)

    monkeypatch.setattr(tables, "stage_table", spied)
    for name in ("style_uniform", "route_documents", "scaled_features", "cluster_labels", "cluster_font", "clustering_state"):
        QUERIES[name](spark, given).collect()
    assert kept.pop("lines") and not [c for columns in kept.values() for c in columns if c in ("text", "traits", "fontname")]
    assert rows_of(QUERIES["route_documents"](spark, given)) == rows_of(
        plan.routed(tables.blocks(spark, given)).select("document_name", "seq", "is_uniform"))


def test_reports_and_models_store_no_whole_blocks(spark, given, monkeypatch):
    kept = {}

    def spied(df, name, by=None):
        kept[name] = df.columns
        return stage_table(df, name, by)

    monkeypatch.setattr(tables, "stage_table", spied)
    model = corpus_model.with_points(tables.blocks(spark, given).select(*PLACE, "page_number", "seq", "feature_vector"))
    assert "text" in kept.pop("blocks")
    tables._stored.pop((spark.sparkContext.applicationId, given, "blocks"))
    assert rows_of(corpus_model.with_points(tables.vectors(spark, given))) == rows_of(model)
    for name in ("corpus_model", "run_report"):
        assert QUERIES[name](spark, given).count()
    assert "vectors" in kept and "blocks" not in kept


def test_labelled_tables_hold_headings_only(spark, given):
    assert tables.labelled(spark, given).filter("features.word_count > 15 AND text IS NOT NULL").isEmpty()
    assert tables.finished(spark, given).filter("predicted_label = 'Body' AND text IS NOT NULL").isEmpty()
    whole = plan.first_labels(tables.blocks(spark, given).drop("cluster_label"))
    kept = ["document_name", "page_number", "seq", "text", "predicted_label"]
    assert rows_of(QUERIES["post_process"](spark, given)) == rows_of(postprocess.post_process(whole).select(*kept))


def test_predicates_read_texts_once(spark, given):
    made = QUERIES["valid_heading_start"] if "valid_heading_start" in QUERIES else QUERIES["is_valid_heading_start"]
    plan_of = made(spark, given)._jdf.queryExecution().optimizedPlan().toString()
    assert "traits" not in plan_of and "feature_vector" not in plan_of


def test_dates_without_a_sign_are_not_searched(spark):
    df = spark.createDataFrame([("12/3/21",), ("1-2-2021",), ("12.3.21",), ("1/2",), (None,), ("",)], "text string")
    assert [r.d for r in df.select(T.is_date(F.col("text")).alias("d")).collect()] == [True, True, False, False, None, False]
