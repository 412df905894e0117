"""Text lines to blocks: runs of lines in one style on one page."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagespine.constants import BROADCAST_DOCUMENTS, HEADING_KEYWORDS, LINES_PER_STRETCH, UNKNOWN_STYLE
from pagespine.functions import text as T
from pagespine.functions.numbers import round_half_even
from pagespine.operators.spread import BUCKET, PLACE, bucket_of, by_extent, dealt, page_keys, reading_key
from pagespine.session import stage_table

PAGE = ["document_name", "page_number"]
LINE = [*PAGE, "line_no"]


def line_styles(chars: DataFrame) -> DataFrame:
    """The most frequent (font, size) of each line; a tie goes to the style met first.

    Characters are counted before their shuffle. The counts then go to the task of their line as they are: a line has few,
    so choosing among them before that shuffle would sort all of them and leave hardly fewer.
    """
    # Lines are far too many for the small map that Spark puts before its hash map; a binary key leaves that out.
    styled = chars.select(*LINE, "char_idx", F.col("fontname").cast("binary").alias("font"), round_half_even(F.col("size"), 2).alias("fontsize"))
    counted = styled.groupBy(*LINE, "font", "fontsize").agg(F.count("*").alias("n"), F.min("char_idx").alias("met"))
    best = F.max_by(F.struct(F.col("font").cast("string").alias("fontname"), "fontsize"), F.struct("n", -F.col("met")))
    return counted.repartition(*LINE).groupBy(*LINE).agg(best.alias("style")).select(*LINE, "style.*")


def with_line_styles(lines: DataFrame, chars: DataFrame) -> DataFrame:
    """Lines with the style of their characters; lines without any get a placeholder."""
    font, size = UNKNOWN_STYLE
    return (
        lines.drop("fontname", "fontsize")
        .join(line_styles(chars), LINE, "left")
        .withColumn("fontname", F.coalesce("fontname", F.lit(font)))
        .withColumn("fontsize", F.coalesce("fontsize", F.lit(size)))
    )


def horizontal_lines(lines: DataFrame) -> DataFrame:
    """Keep horizontal text where the input tells the direction."""
    return lines.filter("orientation = 'horizontal'") if "orientation" in lines.columns else lines


def nonblank_lines(lines: DataFrame) -> DataFrame:
    """Stripped lines, without those that hold only white space."""
    return lines.withColumn("text", T.strip(F.col("text"))).filter("text != ''")


def has_long_pages(lines: DataFrame) -> bool:
    """Whether some page has more lines than one task should order.

    On a stored table the test reaches the scan and is answered from file statistics.
    """
    return not lines.filter(F.col("line_no") >= LINES_PER_STRETCH).select("line_no").isEmpty()


def style_changes(lines: DataFrame, long_pages: bool | None = None) -> DataFrame:
    """Mark lines whose style differs from the line before on the page (``style_change``), and lines with one before (``follows``).

    Lines get a ``stretch``, the part of the page that one task orders: 0 on all pages of ordinary length, which
    keep their single shuffle. Only long pages, if there are any, have the style before each stretch looked up
    from one summary row per stretch.
    """
    if long_pages is None:
        long_pages = has_long_pages(lines)
    before = F.lag(F.struct("fontname", "fontsize"))
    if not long_pages:
        return _changes(lines.withColumn("previous", before.over(W.partitionBy(*page_keys(lines)).orderBy("line_no"))).withColumn("stretch", F.lit(0)))
    pages = lines.filter(F.col("line_no") >= LINES_PER_STRETCH).select(*PAGE).distinct()
    if pages.limit(BROADCAST_DOCUMENTS + 1).count() <= BROADCAST_DOCUMENTS:
        pages = F.broadcast(pages)
    short = style_changes(lines.join(pages, PAGE, "left_anti"), False)
    long = lines.join(pages, PAGE, "left_semi").withColumn("stretch", F.floor(F.col("line_no") / LINES_PER_STRETCH).cast("int"))
    ends = long.groupBy(*PAGE, "stretch").agg(F.max_by(F.struct("fontname", "fontsize"), "line_no").alias("last"))
    ends = ends.select(*PAGE, "stretch", F.lag("last").over(W.partitionBy(*PAGE).orderBy("stretch")).alias("earlier"))
    inside = long.withColumn("previous", before.over(W.partitionBy(*PAGE, "stretch").orderBy("line_no")))
    joined = inside.join(ends, [*PAGE, "stretch"]).withColumn("previous", F.coalesce("previous", "earlier")).drop("earlier")
    return short.unionByName(_changes(joined))


def _changes(lines: DataFrame) -> DataFrame:
    follows = F.col("previous").isNotNull()
    changed = follows & ~F.col("previous").eqNullSafe(F.struct("fontname", "fontsize"))
    return lines.withColumns({"style_change": changed, "follows": follows}).drop("previous")


def number_blocks(lines: DataFrame, keywords=HEADING_KEYWORDS, long_pages: bool | None = None) -> DataFrame:
    """Give each non-blank line the number of its block on the page.

    A block ends before a line in another style or a line that starts with a keyword. Long pages are numbered
    within stretches; the blocks before a stretch are summed on one row per stretch.
    """
    if long_pages is None:
        long_pages = has_long_pages(lines)
    keyword = F.col("keyword") if "keyword" in lines.columns else T.starts_with_keyword(F.col("text"), keywords)
    opens = F.col("style_change") | (F.col("follows") & keyword)
    in_order = W.partitionBy(*page_keys(lines), *(["stretch"] if long_pages else [])).orderBy("line_no")
    count = F.sum("opens").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("int")
    numbered = style_changes(lines, long_pages).withColumn("opens", opens.cast("int")).withColumn("block_no", count)
    if long_pages:
        inside = numbered.filter("stretch > 0 OR opens > 0").groupBy(*PAGE, "stretch").agg(F.max("block_no").alias("n"))
        later = W.partitionBy(*PAGE).orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
        offsets = inside.select(*PAGE, "stretch", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("offset")).filter("stretch > 0")
        numbered = numbered.join(offsets, [*PAGE, "stretch"], "left").withColumn(
            "block_no", (F.col("block_no") + F.coalesce("offset", F.lit(0))).cast("int")
        )
    return numbered.drop("opens", "stretch", "offset", "style_change", "follows", "keyword")


def fold_blocks(numbered: DataFrame) -> DataFrame:
    """One row per block: joined text, bounding box, style, page size.

    All lines of a block have one style, so its greatest value is that of the last line too. Lines without texts
    (see ``without_texts``) give the number of words in its place.
    """
    if "text" in numbered.columns:
        held, told = "text", F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY line_no)")
    else:
        held, told = "word_count", F.sum("word_count").cast("int")
    return (
        numbered.groupBy(*page_keys(numbered), "block_no")
        .agg(
            told.alias(held),
            F.max("fontname").alias("fontname"),
            F.max("fontsize").alias("fontsize"),
            F.struct(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")).alias("bbox"),
            F.max("page_width").alias("page_width"),
            F.max("page_height").alias("page_height"),
            F.count("*").alias("n_lines"),
        )
        .select(
            "document_name", "page_number", "block_no",
            reading_key(F.col("page_number"), F.col("block_no")).alias("seq"),
            held, "fontname", "fontsize", "bbox", "page_width", "page_height", "n_lines", *([BUCKET] if BUCKET in numbered.columns else []),
        )
    )


def to_raw_blocks(lines: DataFrame, keywords=HEADING_KEYWORDS, long_pages: bool | None = None) -> DataFrame:
    lines = horizontal_lines(lines)
    if long_pages is None:
        long_pages = has_long_pages(lines)
    return fold_blocks(number_blocks(nonblank_lines(lines), keywords, long_pages))


def without_texts(lines: DataFrame, keywords=HEADING_KEYWORDS) -> DataFrame:
    """Non-blank lines with what blocks ask of their texts: whether they start with a keyword, and how many words they hold."""
    return lines.withColumns({"keyword": T.starts_with_keyword(F.col("text"), keywords), "word_count": T.word_count(F.col("text"))}).drop("text")


def to_dealt_blocks(lines: DataFrame, keywords=HEADING_KEYWORDS, long_pages: bool = False, texts: bool = True) -> DataFrame:
    """Blocks that lie by document and bucket.

    Lines of ordinary pages are dealt out so at once, in their only shuffle. With long pages, whose blocks fill
    several buckets, the blocks are. Without ``texts`` blocks have the numbers of their words only.
    """
    if long_pages:
        blocks = dealt(to_raw_blocks(lines, keywords, True))
        return blocks if texts else blocks.withColumn("word_count", T.word_count(F.col("text"))).drop("text")
    bucketed = nonblank_lines(horizontal_lines(lines)).withColumn(BUCKET, bucket_of(F.col("page_number"), F.lit(0)))
    bucketed = bucketed if texts else without_texts(bucketed, keywords)
    return fold_blocks(number_blocks(dealt(bucketed), keywords, False))


def list_positions(blocks: DataFrame, order=("seq",)) -> DataFrame:
    """The place of each block in its document by page and ``order``, counted from 0 without gaps.

    Ordering only needs sort keys; this is for readers who want the list index. Where rows have buckets, documents in one of
    them are numbered where they lie (give it a stored table then).
    """
    if BUCKET not in blocks.columns:
        return positions_by_ranges(blocks, order)
    alone, others = by_extent(blocks)
    in_order = W.partitionBy(*PLACE).orderBy("page_number", *order)
    placed = alone.filter("document_name IS NOT NULL").withColumn("position", (F.row_number().over(in_order) - 1).cast("bigint"))
    return placed if others is None else placed.unionByName(positions_by_ranges(others, order))


def positions_by_ranges(blocks: DataFrame, order=("seq",)) -> DataFrame:
    """``list_positions`` for documents of any size.

    Rows are dealt out by ranges of their order and stored with a running number; a document's blocks before a range are
    summed on one row per range.
    """
    keys = ["document_name", "page_number", *order]
    sorted_rows = blocks.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("running", F.monotonically_increasing_id())
    stored = stage_table(sorted_rows.withColumn("range", F.shiftright("running", 33)), "positions")
    ranges = stored.groupBy("document_name", "range").agg(F.min("running").alias("start"), F.count("*").alias("n"))
    earlier = W.partitionBy("document_name").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = stored.join(ranges, ["document_name", "range"])
    return placed.withColumn("position", F.col("before") + F.col("running") - F.col("start")).drop("range", "running", "start", "before", "n")
