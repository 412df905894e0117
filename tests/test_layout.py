import random

from pyspark.sql import functions as F

from checks import tables
from pagespine.operators import features, layout


def blocks_of(lines, **options):
    rows = layout.to_raw_blocks(lines, **options).orderBy("document_name", "seq").collect()
    return [(r.page_number, r.block_no, r.text) for r in rows]


A, B = ("Arial", 10.0), ("Arial-Bold", 14.0)


def test_breaks(make_lines):
    lines = make_lines([
        ("d", 0, 0, "One", *A), ("d", 0, 1, " two ", *A), ("d", 0, 2, "Head", *B), ("d", 0, 3, "three", *A),
        ("d", 0, 4, "  ", *B), ("d", 0, 5, "four", *A), ("d", 0, 6, "Overview: x", *A), ("d", 0, 7, "five", *A), ("d", 1, 0, "six", *A),
    ])
    assert blocks_of(lines) == [
        (0, 0, "One\ntwo"), (0, 1, "Head"), (0, 2, "three\nfour"), (0, 3, "Overview: x\nfive"), (1, 0, "six"),
    ]


def test_keyword_on_first_line_opens_nothing(make_lines):
    assert blocks_of(make_lines([("d", 0, 0, "Introduction", *A), ("d", 0, 1, "text", *A)])) == [(0, 0, "Introduction\ntext")]


def test_box_and_features(make_lines, spark):
    lines = make_lines([("d", 0, 0, "a b", *B), ("d", 0, 1, "c", *B)])
    row = features.with_features(layout.to_raw_blocks(lines)).first()
    assert row.features.asDict() == {
        "font_size": 14.0, "indentation": 72.0, "is_bold": 1, "y_coordinate": 712.0, "centering_offset": 169.5, "word_count": 3,
    }
    vector = features.with_vectors(spark.createDataFrame([(row.asDict(),)], "b struct<features:struct<font_size:double,indentation:double,is_bold:int,y_coordinate:double,centering_offset:double,word_count:int>>").select("b.*")).first()
    assert vector.feature_vector == [14.0, 72.0, 1.0, 169.5, 3.0, 712.0, 5.143]


def test_missing_features_take_defaults(spark):
    df = spark.createDataFrame([(None,)], "features struct<font_size:double,indentation:double,is_bold:int,y_coordinate:double,centering_offset:double,word_count:int>")
    assert features.with_vectors(df).first().feature_vector == [0.0, 0.0, 0.0, 999.0, 0.0, 0.0, 0.0]


def test_line_style_tie_goes_to_first_met(spark, make_lines):
    chars = [("d", 0, 0, i, f, s) for i, (f, s) in enumerate([("X", 9.0), ("Y", 9.0), ("Y", 9.004), ("X", 9.001)])]
    chars += [("d", 0, 1, i, f, 9.0) for i, f in enumerate("PQQ")]
    df = spark.createDataFrame(chars, "document_name string, page_number int, line_no int, char_idx int, fontname string, size double")
    lines = make_lines([("d", 0, n, "t", "?", 1.0) for n in range(3)])
    rows = layout.with_line_styles(lines, df).orderBy("line_no").collect()
    assert [(r.fontname, r.fontsize) for r in rows] == [("X", 9.0), ("Q", 9.0), ("Unknown", 0.0)]


def test_line_styles_are_sorted_once(spark):
    """Counts of characters go to the task of their line unsorted; only there they are sorted."""
    chars = spark.range(40).selectExpr(
        "concat('d', id % 2) AS document_name", "CAST(id DIV 40 AS INT) AS page_number", "CAST(id % 4 AS INT) AS line_no", "CAST(id AS INT) AS char_idx",
        "if(id % 5 < 2, 'X', 'Y') AS fontname", "9.0D AS size",
    )
    styles = layout.line_styles(chars)
    plan = styles._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.index("Sort [") < plan.index("Exchange") and plan.count("Exchange") == 2
    assert {(r.document_name, r.line_no): (r.fontname, r.fontsize) for r in styles.collect()} == {(f"d{n % 2}", n): ("Y", 9.0) for n in range(4)}


def test_line_styles_keep_null_and_unusual_fonts(spark):
    chars = [("d", 0, 0, 0, "é字", 9.004), ("d", 0, 0, 1, "é字", 9.0), ("d", 0, 0, 2, "A", 9.0), ("d", None, 0, 0, None, 8.0), (None, 0, 0, 0, "B", None)]
    df = spark.createDataFrame(chars, "document_name string, page_number int, line_no int, char_idx int, fontname string, size double")
    assert {tuple(r) for r in layout.line_styles(df).collect()} == {("d", 0, 0, "é字", 9.0), ("d", None, 0, None, 8.0), (None, 0, 0, "B", None)}


def test_lines_read_once_are_not_stored(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(1, "one two\nthree")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = []
    monkeypatch.setattr(tables, "stage_table", lambda df, name, by=None: made.append(name) or df)
    once = tables.chars(spark, str(tmp_path)).collect()
    assert not made
    tables.lines(spark, str(tmp_path))
    assert made == ["lines"] and sorted(tables.chars(spark, str(tmp_path)).collect()) == sorted(once)


def test_vertical_lines_are_left_out(make_lines):
    lines = make_lines([("d", 0, 0, "a", *A), ("d", 0, 1, "b", *A)])
    lines = lines.withColumn("orientation", F.when(F.col("line_no") == 1, "vertical").otherwise("horizontal"))
    assert blocks_of(lines) == [(0, 0, "a")]


def walk(rows):
    """Blocks by a plain walk over the lines of one page."""
    out, style = [], None
    for text, font, size in rows:
        text = text.strip()
        if not text:
            continue
        word = text.split(" ")[0].lower().strip("•*: ")
        if style is None or (font, size) != style or word in ("introduction", "overview", "methodology", "appendix"):
            out.append([])
        out[-1].append(text)
        style = (font, size)
    return ["\n".join(b) for b in out]


def test_long_pages_give_the_same_blocks(make_lines, monkeypatch):
    monkeypatch.setattr(layout, "LINES_PER_STRETCH", 4)
    rng = random.Random(3)
    pages = [[(rng.choice(["a b", " ", "Overview x", "c"]), *rng.choice([A, A, A, B])) for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    lines = make_lines([("d", p, n, *line) for p, page in enumerate(pages) for n, line in enumerate(page)])
    assert layout.has_long_pages(lines)
    expected = [(p, i, t) for p, page in enumerate(pages) for i, t in enumerate(walk(page))]
    assert blocks_of(lines) == expected
    assert blocks_of(lines, long_pages=False) == expected


def test_order_of_input_rows_does_not_matter(make_lines):
    rows = [("d", 0, n, f"t{n}", *(A if n % 3 else B)) for n in range(20)]
    assert blocks_of(make_lines(rows)) == blocks_of(make_lines(random.Random(1).sample(rows, 20)))


def test_positions_count_over_pages(make_lines):
    lines = make_lines([("d", p, n, "t", *(A if n % 2 else B)) for p in (0, 2, 5000) for n in range(3)])
    rows = layout.list_positions(layout.to_raw_blocks(lines)).orderBy("seq").collect()
    assert [r.position for r in rows] == list(range(9))
