"""Steps on rows that are stored by document and bucket leave them where they lie, and give what they gave before."""

from pyspark.sql import functions as F

from pagespine.functions import text as T
from pagespine.operators import clusters, layout, outline, postprocess, rules
from pagespine.operators.features import with_features, with_vectors
from pagespine.operators.spread import PLACE, dealt
from pagespine.plans import outlines as plan
from pagespine.session import stage_table
from pagespine.sources import files

KIND = "document_name string, page_number int, seq bigint, text string, features struct<y_coordinate:double, word_count:int>"


def stored(spark, rows):
    df = spark.createDataFrame([(d, p, (p << 32) + n, t, (y, 2)) for d, p, n, t, y in rows], KIND)
    traits = F.struct(F.col("text").alias("text_key"))
    return stage_table(dealt(df.withColumn("traits", traits)), "rows", PLACE)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_texts_are_counted_where_they_lie(spark):
    rows = stored(spark, [("a", p, 0, "header" if p < 3 else "other", 1.0) for p in range(5)])
    assert exchanges(postprocess.text_pages(rows)) == 0 and exchanges(postprocess.repeated_keys(rows)) == 0
    assert {tuple(r) for r in postprocess.text_pages(rows).collect()} == {("a", "header", 3), ("a", "other", 2)}
    assert [r.text_key for r in postprocess.repeated_keys(rows).collect()] == ["header"]


def test_texts_of_documents_of_several_buckets(spark):
    """One text on three pages of two buckets, one twice on a page that fills several buckets and once elsewhere."""
    rows = [("long", p, 0, "header", 1.0) for p in (0, 1, 300)] + [("long", 0, n, "twice", 2.0) for n in (1, 5000)] + [("long", 1, 1, "twice", 2.0)]
    blocks = stored(spark, rows + [("short", p, 0, "header", 1.0) for p in (0, 1)])
    assert {tuple(r) for r in postprocess.text_pages(blocks).collect()} == {("long", "header", 3), ("long", "twice", 2), ("short", "header", 2)}
    flagged = postprocess.with_repeats(blocks, postprocess.repeated_keys(blocks)).filter("repeated").collect()
    assert sorted((r.document_name, r.text, r.page_number) for r in flagged) == [("long", "header", p) for p in (0, 1, 300)]


def test_space_before_where_blocks_lie(spark):
    rows = [("a", 0, 0, "x", 700.0), ("a", 0, 1, "y", 650.0), ("a", 0, 2, "z", 650.0), ("a", 1, 0, "x", None), ("b", 0, 0, "x", 10.0)]
    blocks = stored(spark, rows)
    spaced = rules.with_space_before(blocks)
    assert exchanges(spaced) == 0
    shown = ["document_name", "seq", "features.space_before", "tops_page"]
    by_heights = rules.with_space_before(blocks.drop("bucket"))
    assert sorted(map(tuple, spaced.select(*shown).collect())) == sorted(map(tuple, by_heights.select(*shown).collect()))


def test_block_files_are_opened_once(spark, tmp_path):
    block = '{"text":"x","page_number":0,"fontsize":9.0,"features":{}}'
    (tmp_path / "a.json").write_text(f"[{block}]")
    (tmp_path / "b.json").write_text("no array")
    (tmp_path / "c.json").write_text("")
    blocks, left_out = files.read_blocks(spark, str(tmp_path))
    for made in (blocks, left_out):
        assert "binaryfile" not in made._jdf.queryExecution().executedPlan().toString().lower()
    assert [r.document_name for r in blocks.collect()] == ["a"]
    assert sorted(r.document_name for r in left_out.collect()) == ["b", "c"]


def test_dates_are_those_of_the_plain_patterns(spark):
    texts = ["Market", "x jan", "\u017fep 3", "\u017fEPTEMBER", "xJan", "12/3/21", "112/3/21", "a 1-2-2021.", "\u0661/\u0662/\u0663\u0664", "1/2/3", "may_", "mayx", "Mond", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    month, number = T.MONTH_WORD.replace("(?=[JFMASOND])", ""), T.NUMERIC_DATE.replace(r"(?=\d{1,2}[/-])", "")
    assert month != T.MONTH_WORD and number != T.NUMERIC_DATE
    plain = F.col("text").rlike(month) | F.col("text").rlike(number)
    assert df.filter(plain != T.is_date(F.col("text"))).isEmpty() and 0 < df.filter(plain).count() < len(texts)


MEASURED = "document_name string, page_number int, seq bigint, fontsize double, feature_vector array<double>"


def measured(spark, pages_of):
    """Blocks of documents by name and pages; fonts and vectors vary with the block."""
    rows = [(d, p, (p << 32) + n, 9.0 + (p + n) % 4, [float((p * 7 + n * k) % (5 + k)) for k in range(7)]) for d, pages in pages_of.items() for p in pages for n in range(6)]
    return stage_table(dealt(spark.createDataFrame(rows, MEASURED)), "measured", PLACE)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_facts_and_clusters_of_documents_in_one_bucket_need_no_shuffle(spark):
    """blocks meet the facts and clusters of their documents where they lie."""
    rows = measured(spark, {"a": range(4), "b": range(3)})
    assert exchanges(plan.routed(rows)) == 0
    found = clusters.placed_clusters(rows)
    assert exchanges(found) == 0
    assert exchanges(clusters.clustering_state(stage_table(found, "grouped", PLACE))) == 0


def test_facts_and_clusters_do_not_depend_on_buckets(spark):
    pages = {"a": range(4), "b": range(3), "long": (0, 1, 255, 256, 700)}
    rows = measured(spark, pages)
    plain = spark.createDataFrame(rows.drop("bucket").collect(), MEASURED)
    shown = ["document_name", "seq", "is_uniform", "n_blocks", "first_page"]
    assert rows_of(plan.routed(rows).select(*shown)) == rows_of(plan.routed(plain).select(*shown))
    by = ["document_name", "seq", "cluster_label", "settled"]
    whole = clusters.cluster_small(clusters.scaled_features(plain))
    found = stage_table(clusters.placed_clusters(rows), "grouped", PLACE)
    assert rows_of(found.select(*by)) == rows_of(whole.select(*by)) == rows_of(clusters.cluster_blocks(plain).select(*by))
    state = clusters.clustering_state(found).collect()
    assert sorted((r.document_name, r.n_blocks, r.n_moved) for r in state) == [(d, 6 * len(p), 0) for d, p in sorted(pages.items())]


def test_blocks_without_texts_count_the_same_words(spark, make_lines):
    """texts end before the lines' shuffle; words and keywords are told before."""
    texts = ["two words", "Overview: of three", "a b\x1cc d", " x ", "Introduction", "  "]
    lines = make_lines([(d, p, n, texts[(p + n) % 6], "F", 9.0 + n // 4) for d in "ab" for p in range(3) for n in range(12)])
    without, whole = layout.to_dealt_blocks(lines, texts=False), layout.to_dealt_blocks(lines)
    assert "text" not in without.columns
    shown = ["document_name", "seq", "fontsize", "features.word_count", "feature_vector"]
    assert rows_of(with_vectors(with_features(without)).select(*shown)) == rows_of(with_vectors(with_features(whole)).select(*shown))
    scans = without._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[0]
    assert "text#" not in scans


def test_outlines_are_made_where_rows_lie(spark):
    """F3, F4, F16, F17: documents in one bucket; a long one and rows without a document take the other way to the same rows."""
    rows = [(d, p, (p << 32) + n, f"{d} {p} {n}", label) for d, pages in (("a", (0, 1)), ("b", (0,)), ("long", (0, 300)), (None, (0, 400)))
            for p in pages for n, label in enumerate(("Body", "H1", "Title", "H2"))]
    df = spark.createDataFrame([*rows, ("body", 0, 0, "x", "Body")], "document_name string, page_number int, seq bigint, text string, predicted_label string")
    blocks = stage_table(dealt(df), "labelled", PLACE)
    assert exchanges(outline.document_outline(blocks.filter("document_name IN ('a', 'b')"))) <= 3  # those of rows without a document
    assert rows_of(outline.document_outline(blocks)) == rows_of(outline.document_outline(df))


def test_labels_store_no_second_copy_of_the_blocks(spark, make_lines, monkeypatch):
    """F3, F4, F13, F16 to F18: what is stored between blocks and labels is what clustering asks for."""
    lines = make_lines([("v", p, n, f"Some text {n}", "F", 9.0 + n % 3) for p in range(3) for n in range(8)])
    blocks, kept = stage_table(plan.placed_blocks(lines), "blocks", PLACE), []

    def spied(df, name, by=None):
        kept.extend(df.columns)
        return stage_table(df, name, by)

    monkeypatch.setattr(plan, "stage_table", spied)
    assert plan.first_labels(blocks).count() == blocks.count() > 0
    assert kept and not {"text", "traits", "features"} & set(kept)
