"""Corrections that both labellers share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagespine.constants import HEADING_LEVELS, MAX_HEADING_WORDS, REPEAT_PAGES
from pagespine.operators.spread import BUCKET, attach, by_extent, with_bucket
from pagespine.operators.traits import with_traits

DOC = "document_name"


def list_order() -> Column:
    """Sort key of documents whose blocks stay in arrival order."""
    return F.struct(F.lit(0).alias("page"), F.lit(0.0).alias("depth"), F.col("seq").alias("seq"))


def keyed_pages(blocks: DataFrame) -> DataFrame:
    """The text key and the page of each block that has a text."""
    keyed = with_bucket(blocks) if BUCKET not in blocks.columns else blocks
    return keyed.select(DOC, F.col("traits.text_key").alias("text_key"), BUCKET, "page_number").filter("text_key != ''")


def bucket_pages(rows: DataFrame) -> DataFrame:
    """On how many of the pages of a bucket each text key stands, and in which parts of it; ``pages_of`` are disjoint."""
    counts = F.count_distinct("page_number").alias("n_pages"), F.collect_set(BUCKET).alias("buckets")
    return rows.groupBy(DOC, "text_key", page_bucket().alias("pages_of")).agg(*counts)


def first_bucket_pages(rows: DataFrame) -> DataFrame:
    """The same for documents in one bucket. Rows stored by document and bucket are counted where they lie."""
    return rows.groupBy(DOC, "text_key", BUCKET).agg(F.count_distinct("page_number").alias("n_pages"))


def page_bucket() -> Column:
    """The pages of a bucket, without its part of each page."""
    return F.shiftright(BUCKET, 24)


def text_pages(blocks: DataFrame) -> DataFrame:
    """On how many pages each text key of a document stands."""
    alone, others = by_extent(keyed_pages(blocks))
    counted = first_bucket_pages(alone).drop(BUCKET)
    return counted if others is None else counted.unionByName(bucket_pages(others).groupBy(DOC, "text_key").agg(F.sum("n_pages").alias("n_pages")))


def repeated_keys(blocks: DataFrame, pages: int = REPEAT_PAGES) -> DataFrame:
    """Keys on more than ``pages`` pages (running headers and footers), a row for each bucket they stand in.

    Counts combine before every shuffle, so a header on every page of a huge document is a few rows by then. Only documents
    of several buckets have counts to be summed. Give it a stored table.
    """
    alone, others = by_extent(keyed_pages(blocks))
    named = [DOC, "text_key", BUCKET, F.lit(True).alias("repeated")]
    found = first_bucket_pages(alone).filter(F.col("n_pages") > pages).select(*named)
    if others is None:
        return found
    whole = F.sum("n_pages").over(W.partitionBy(DOC, "text_key"))
    among = bucket_pages(others).withColumn("whole", whole).filter(F.col("whole") > pages)
    return found.unionByName(among.withColumn(BUCKET, F.explode("buckets")).select(*named))


def with_repeats(blocks: DataFrame, repeats: DataFrame) -> DataFrame:
    """Add ``repeated``, joined per bucket so that no task sees all copies of a text and rows stored by bucket may stay."""
    return blocks.withColumn("text_key", F.col("traits.text_key")).join(repeats, [DOC, BUCKET, "text_key"], "left").withColumn(
        "repeated", F.coalesce("repeated", F.lit(False))
    ).drop("text_key")


def numbered_label() -> Column:
    """A leading number decides the level, whatever the label was."""
    return F.coalesce(F.col("traits.level"), F.col("predicted_label"))


def first_titles(blocks: DataFrame, repeats: DataFrame) -> DataFrame:
    """The place of the first title candidate of each document.

    It counts even when a later correction demotes it. Candidates shrink to
    one row per text before repeating texts are taken out.
    """
    return (
        blocks.filter((numbered_label() == "Title") & ~F.col("traits.rejected"))
        .groupBy(DOC, F.col("traits.text_key").alias("text_key"))
        .agg(F.min("place").alias("title_place"))
        .join(repeats.select(DOC, "text_key").distinct(), [DOC, "text_key"], "left_anti")
        .groupBy(DOC)
        .agg(F.min("title_place").alias("title_place"))
    )


def override_by_number(blocks: DataFrame) -> DataFrame:
    """Send what can't be a heading to the body; elsewhere apply the leading number."""
    dismissed = F.col("repeated") | F.col("traits.rejected")
    return blocks.withColumn("predicted_label", F.when(dismissed, "Body").otherwise(numbered_label()))


def keep_first_title(blocks: DataFrame) -> DataFrame:
    later = (F.col("predicted_label") == "Title") & (F.col("place") > F.col("title_place"))
    return blocks.withColumn("predicted_label", F.when(later, "H1").otherwise(F.col("predicted_label")))


def demote(blocks: DataFrame, max_words: int = MAX_HEADING_WORDS) -> DataFrame:
    """Long texts and lower-case starts become body."""
    headline = F.col("predicted_label").isin("Title", *HEADING_LEVELS)
    unfit = headline & is_unfit(max_words)
    return blocks.withColumn("predicted_label", F.when(unfit, "Body").otherwise(F.col("predicted_label")))


def is_unfit(max_words: int = MAX_HEADING_WORDS) -> Column:
    """Too long for a heading, or starting in lower case."""
    return (F.coalesce(F.col("features.word_count"), F.lit(0)) > max_words) | ~F.col("traits.valid_start")


def candidates(blocks: DataFrame) -> DataFrame:
    """Blocks that the corrections may leave a title or heading; the rest is body whatever happens."""
    return blocks.filter((numbered_label() != "Body") & ~F.col("traits.rejected"))


def correct(blocks: DataFrame, repeats: DataFrame, titles: DataFrame, max_words: int = MAX_HEADING_WORDS) -> DataFrame:
    """Apply the corrections, given what holds for all blocks of the documents."""
    flagged = attach(with_repeats(blocks, repeats), titles, [DOC], places=blocks)
    return demote(keep_first_title(override_by_number(flagged)), max_words)


def post_process(blocks: DataFrame, pages: int = REPEAT_PAGES, max_words: int = MAX_HEADING_WORDS) -> DataFrame:
    """All corrections. ``place``, if present, is the order that decides which title is first."""
    kept = blocks.columns
    ordered = blocks if "place" in kept else blocks.withColumn("place", list_order())
    ordered = with_traits(ordered if BUCKET in kept else with_bucket(ordered))
    repeats = repeated_keys(ordered, pages)
    return correct(ordered, repeats, first_titles(ordered, repeats), max_words).select(*kept)
