"""Facts about a whole document, brought to its rows without gathering the document.

One document may hold a large share of all rows. Aggregates over a document
combine before their shuffle, so they are safe. Joining the result back on
the document alone would not be: all its rows would meet in one task. Rows
therefore carry a bucket of bounded size, each fact is copied once per bucket
that exists, and the join uses document and bucket.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.constants import BLOCKS_PER_BUCKET, BROADCAST_DOCUMENTS, PAGES_PER_BUCKET
from pagespine.session import parts_of

BUCKET = "bucket"

#: The keys that stage tables are stored by.
PLACE = ["document_name", BUCKET]


def reading_key(page: Column, block_no: Column) -> Column:
    """One number that sorts blocks by page and then by place on the page."""
    return F.shiftleft(page.cast("bigint"), 32) + block_no.cast("bigint")


def bucket_of(page: Column, seq: Column) -> Column:
    pages = F.coalesce(page, F.lit(0)).cast("bigint")
    place = F.coalesce(seq, F.lit(0)).cast("bigint").bitwiseAND(F.lit(2**32 - 1))
    return F.shiftleft(F.floor(pages / PAGES_PER_BUCKET), 24) + F.floor(place / BLOCKS_PER_BUCKET)


def with_bucket(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn(BUCKET, bucket_of(F.col("page_number"), F.col("seq")))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows in the tasks of their document's buckets: one shuffle that all later steps by ``PLACE`` build on."""
    rows = rows if BUCKET in rows.columns else with_bucket(rows)
    return rows.repartition(parts_of(rows.sparkSession), *PLACE)


def has_split_pages(rows: DataFrame) -> bool:
    """Whether some page fills more than one bucket. Give it a stored table."""
    return not rows.filter(F.col(BUCKET).bitwiseAND(F.lit(2**24 - 1)) != 0).select(BUCKET).isEmpty()


def by_extent(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of documents that lie in the first bucket alone, and the rows of all others, if there are any. Give it a stored table.

    What is counted by document in the first part is counted where its rows are. On a stored table the others are mostly found
    by file statistics.
    """
    doc = PLACE[0]
    beyond = rows.filter(F.col(BUCKET) != 0).select(doc).distinct()
    n = beyond.limit(BROADCAST_DOCUMENTS + 1).count()
    if n == 0:
        return rows, None
    if n <= BROADCAST_DOCUMENTS:
        names = F.broadcast(beyond)
        return rows.join(names, doc, "left_anti"), rows.join(names, doc, "left_semi")
    spread = rows.select(*PLACE).distinct().join(beyond, doc, "left_semi")
    return rows.join(spread, PLACE, "left_anti"), rows.join(spread, PLACE, "left_semi")


def meet(rows: DataFrame, facts: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Join ``facts``, one row per ``by``, to ``rows``; by ``PLACE`` in the tasks where both lie, with the few facts held in memory."""
    return rows.join(facts.hint("shuffle_hash"), PLACE, how) if by == PLACE else attach(rows, facts, by, how)


def with_facts(rows: DataFrame, facts, how: str = "left") -> DataFrame:
    """Rows beside the facts of their documents, which ``facts(rows, keys)`` sums by the keys it is given.

    Documents in the first bucket alone are summed, and meet their facts, where they lie; the others go through ``attach``.
    Give it a stored table.
    """
    if BUCKET not in rows.columns:
        return attach(rows, facts(rows, PLACE[:1]), PLACE[:1], how)
    alone, others = by_extent(rows)
    met = meet(alone, facts(alone, PLACE), PLACE, how)
    return met if others is None else met.unionByName(meet(others, facts(others, PLACE[:1]), PLACE[:1], how))


def page_keys(rows: DataFrame) -> list[str]:
    """Keys of a page. A bucket holds whole pages here, so it does not divide them, but it lets dealt rows stay in place."""
    return ["document_name", *([BUCKET] if BUCKET in rows.columns else []), "page_number"]


def attach(rows: DataFrame, facts: DataFrame, on: list[str], how: str = "left", places: DataFrame | None = None) -> DataFrame:
    """Join ``facts``, one row per ``on``, to ``rows``.

    The buckets that exist are read from ``places``, or else from ``rows`` once
    more; give a stored table when ``rows`` is costly.
    """
    rows = rows if BUCKET in rows.columns else with_bucket(rows)
    places = rows if places is None else places
    spread = places.select(*on, BUCKET).distinct().join(facts, on)
    return rows.join(spread, [*on, BUCKET], how)
