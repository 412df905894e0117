import random

import pytest
from pyspark.sql import functions as F

from pagespine.operators import layout, spread
from pagespine.plans import outlines as plan

DOCUMENTS = {"small": 3, "huge": 40, "plain": 12}
STYLES = [("Arial", 10.0), ("Arial-Bold", 10.0), ("Arial", 14.0), ("Arial-Bold", 18.0), ("Times", 8.5), ("Times", 24.0)]
TEXTS = ["Plain words here", "1.2 Scope", "Running head", "***", "Page 3", "lower case", "Contents ..... 4", "NOTES HERE", "Long " * 18, "Overview"]


@pytest.fixture
def lines(make_lines):
    """A document with most of the lines, one of uniform style, one small, one of noise, one blank."""
    rng = random.Random(11)
    rows = []
    for doc, pages in DOCUMENTS.items():
        for page in range(pages):
            for n in range(12):
                font, size = rng.choice(STYLES[:2] if doc == "plain" else STYLES)
                rows.append((doc, page, n, rng.choice(TEXTS), font, size))
    rows += [("noise", 0, n, "***", f"F{n}", 9.0) for n in range(12)]
    rows += [("blank", 0, 0, "  ", "F", 9.0)]
    return make_lines(rows)


def rows(df):
    return sorted((r.document_name, r.title, tuple(map(tuple, r.outline))) for r in df.collect())


def test_splitting_and_row_order_change_nothing(lines, monkeypatch):
    expected = rows(plan.outlines(lines))
    assert {r[0] for r in expected} == {"small", "huge", "plain"}
    monkeypatch.setattr(spread, "PAGES_PER_BUCKET", 2)
    monkeypatch.setattr(spread, "BLOCKS_PER_BUCKET", 3)
    monkeypatch.setattr(layout, "LINES_PER_STRETCH", 5)
    split = plan.Settings(task_blocks=30, long_pages=True)
    assert rows(plan.outlines(lines.orderBy(F.rand(3)), split)) == expected


def test_run(lines, spark):
    documents = spark.createDataFrame([(d,) for d in (*DOCUMENTS, "noise", "blank", "absent", "broken")], "document_name string")
    broken = lines.filter("document_name = 'small'").withColumns({"document_name": F.lit("broken"), "page_number": F.lit(None).cast("int")})
    made = plan.run(documents, lines.unionByName(broken))
    status = {r.document_name: r.status for r in made["report"].collect()}
    assert status == {
        "small": "done", "huge": "done", "plain": "done", "noise": "nothing but noise", "blank": "no blocks",
        "absent": "no lines", "broken": "no lines",
    }
    assert [r.document_name for r in made["rejects"].collect()] == ["broken"]
    labelled = made["labelled"]
    titles = labelled.filter("predicted_label = 'Title'").groupBy("document_name").count()
    assert titles.filter("count > 1").isEmpty()
    assert labelled.filter("predicted_label != 'Body' AND features.word_count > 15").isEmpty()
    assert rows(made["outlines"]) == rows(plan.outlines(lines))


def test_blocks_partition_the_nonblank_lines(lines):
    text = layout.nonblank_lines(lines).groupBy("document_name", "page_number").agg(
        F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY line_no)").alias("page_text"))
    joined = layout.to_raw_blocks(lines).groupBy("document_name", "page_number").agg(
        F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY seq)").alias("block_text"))
    both = text.join(joined, ["document_name", "page_number"], "full")
    assert both.filter("page_text <=> block_text").count() == both.count() > 50


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_lines_are_shuffled_once(lines):
    blocks = plan.heading_texts(plan.to_blocks(lines, plan.Settings(long_pages=False)))
    assert exchanges(blocks) == 1


def test_facts_and_titles_read_few_columns(lines, spark, tmp_path):
    plan.to_blocks(lines).write.parquet(str(tmp_path / "blocks"))
    facts = plan.document_facts(spark.read.parquet(str(tmp_path / "blocks")))
    scan = facts._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in scan.split("ReadSchema")[1]


def test_settings_reach_the_steps(lines):
    shorter = plan.outlines(lines, plan.Settings(max_heading_words=1))
    items = shorter.select(F.explode("outline").alias("i")).select("i.text")
    assert items.filter(F.size(F.split("text", r"\s+")) > 1).isEmpty()
