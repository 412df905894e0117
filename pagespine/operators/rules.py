"""Labels for documents of uniform style, by scoring."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagespine.constants import FIRST_ON_PAGE_SPACE, TITLE_WORDS
from pagespine.operators.spread import BUCKET, attach, has_split_pages, page_keys
from pagespine.operators.traits import with_traits

PAGE = ["document_name", "page_number"]


def rule_order() -> Column:
    """Sort key of ruled documents: page, then top to bottom, then arrival."""
    depth = -F.coalesce(F.col("features.y_coordinate"), F.lit(0.0))
    return F.struct(F.col("page_number").alias("page"), depth.alias("depth"), F.col("seq").alias("seq"))


def with_gaps(blocks: DataFrame) -> DataFrame:
    """Add ``gap`` and ``tops_page`` (see ``with_space_before``) to blocks of ordinary pages, which a task orders where they lie."""
    top = F.coalesce(F.col("features.y_coordinate"), F.lit(0.0))
    above = F.lag("top").over(W.partitionBy(*page_keys(blocks)).orderBy(F.desc("top"), "seq"))
    gap = F.coalesce(F.col("above") - F.col("top"), F.lit(FIRST_ON_PAGE_SPACE))
    topped = blocks.withColumn("top", top).withColumn("above", above)
    return topped.withColumns({"gap": gap, "tops_page": F.col("above").isNull()}).drop("top", "above")


def with_space_before(blocks: DataFrame) -> DataFrame:
    """Add the distance to the block above on the page, and ``tops_page`` for the block without one.

    Blocks at one height have no distance except the first of them, so the
    window runs over the distinct heights of a page and not over its blocks. Where rows
    have buckets and none of their pages fills several, blocks are ordered where they lie. Give it a stored table.
    """
    if "gap" not in blocks.columns and BUCKET in blocks.columns and not has_split_pages(blocks):
        blocks = with_gaps(blocks)
    if "gap" in blocks.columns:
        return blocks.withColumn("features", F.col("features").withField("space_before", F.col("gap"))).drop("gap")
    top = F.coalesce(F.col("features.y_coordinate"), F.lit(0.0))
    heights = blocks.groupBy(*PAGE, top.alias("top")).agg(F.min("seq").alias("seq"))
    above = F.lag("top").over(W.partitionBy(*PAGE).orderBy(F.desc("top")))
    gaps = heights.withColumn("above", above).select(
        *PAGE, "seq",
        F.coalesce(F.col("above") - F.col("top"), F.lit(FIRST_ON_PAGE_SPACE)).alias("gap"),
        F.col("above").isNull().alias("tops_page"),
    )
    return (
        blocks.join(gaps, [*PAGE, "seq"], "left")
        .withColumn("features", F.col("features").withField("space_before", F.coalesce("gap", F.lit(0.0))))
        .withColumn("tops_page", F.coalesce("tops_page", F.lit(False)))
        .drop("gap")
    )


def first_page() -> Column:
    """Aggregate: the page that holds the first block of a document."""
    return F.min("page_number").alias("first_page")


def with_first_page(blocks: DataFrame) -> DataFrame:
    if "first_page" in blocks.columns:
        return blocks
    return attach(blocks, blocks.groupBy("document_name").agg(first_page()), ["document_name"])


def heading_score(optional: list[str]) -> Column:
    """Points for looking like a heading. All points and limits below."""
    words, space = F.col("features.word_count"), F.col("features.space_before")
    parts = [
        F.when(F.col(f"features.{name}") != 0, 3)
        for name in ("is_bold", *optional)
    ] + [
        F.when(F.col("traits.upper") & (words > 1), 1),
        F.when(space > 25, 2).when(space > 15, 1),
        F.when(words < 10, 2).when(words < 20, 1),
        F.when(F.col("traits.level").isNotNull(), 4),
    ]
    return sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(0))


def score_label(score: Column) -> Column:
    """The points that each level takes."""
    return F.when(score >= 7, "H1").when(score >= 5, "H2").when(score >= 3, "H3").otherwise("Body")


def score_blocks(blocks: DataFrame, title_words: int = TITLE_WORDS) -> DataFrame:
    """Add ``place``, spacing, score and label; noise is labelled, not yet dropped."""
    return (
        with_space_before(with_first_page(with_traits(blocks)))
        .withColumn("place", rule_order())
        .withColumn("heading_score", heading_score(optional_styles(blocks)))
        .withColumn("predicted_label", scored_label(title_words))
        .drop("first_page", "tops_page", BUCKET)
    )


def optional_styles(blocks: DataFrame) -> list[str]:
    """Styles that count for a heading and that some inputs give."""
    given = blocks.schema["features"].dataType.fieldNames()
    return [name for name in ("is_italics", "is_underline", "is_all_caps") if name in given]


def scored_label(title_words: int = TITLE_WORDS) -> Column:
    """The label of a block with its score, spacing and first page."""
    first = F.col("tops_page") & (F.col("page_number") == F.col("first_page"))
    short = F.col("features.word_count") < title_words
    return F.when(F.col("traits.noise"), "Noise").when(first & short, "Title").otherwise(score_label(F.col("heading_score")))


def rule_labels(blocks: DataFrame, title_words: int = TITLE_WORDS) -> DataFrame:
    """Labelled blocks without noise; ``place`` keeps the order they are in."""
    return score_blocks(blocks, title_words).filter("predicted_label != 'Noise'").drop("heading_score")
