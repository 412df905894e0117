"""The whole way from lines to outlines, for all documents in one run."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagespine import constants as C
from pagespine.operators import clusters, layout, outline, postprocess, rules, style
from pagespine.operators.features import with_features, with_vectors
from pagespine.operators.spread import BUCKET, PLACE, by_extent, dealt, has_split_pages, with_facts
from pagespine.operators.traits import with_traits
from pagespine.session import stage_table
from pagespine.plans import runs
from pagespine.sources import accounts, changes, files, report, sinks

DOC = "document_name"
FILE_BLOCK = [DOC, "page_number", "seq", "text", "fontname", "fontsize", "features"]

#: What blocks of ordinary pages carry from the beginning, for the rules.
GAP = ("gap", "tops_page")


@dataclass(frozen=True)
class Settings:
    heading_keywords: tuple = C.HEADING_KEYWORDS
    n_clusters: int = C.N_CLUSTERS
    title_words: int = C.TITLE_WORDS
    task_blocks: int = C.BLOCKS_PER_TASK
    std_threshold: float = C.STD_THRESHOLD
    unique_threshold: int = C.UNIQUE_THRESHOLD
    min_blocks: int = C.MIN_BLOCKS
    repeat_pages: int = C.REPEAT_PAGES
    max_heading_words: int = C.MAX_HEADING_WORDS
    long_pages: bool | None = None


def to_blocks(lines: DataFrame, settings: Settings = Settings(), by_place: bool = False, texts: bool = True) -> DataFrame:
    """Lines to blocks with features and vectors; one shuffle, on (document, page), or by document and bucket, then without texts if wanted."""
    if not by_place:
        return with_vectors(with_features(layout.to_raw_blocks(lines, settings.heading_keywords, settings.long_pages)))
    long_pages = layout.has_long_pages(lines) if settings.long_pages is None else settings.long_pages
    return with_vectors(with_features(layout.to_dealt_blocks(lines, settings.heading_keywords, long_pages, texts)))


def document_facts(blocks: DataFrame, settings: Settings = Settings(), by: list[str] = [DOC]) -> DataFrame:
    """All that labelling asks about a document as a whole, from one pass over its blocks."""
    uniform = style.is_uniform(settings.std_threshold, settings.unique_threshold, settings.min_blocks)
    facts = blocks.groupBy(*by).agg(*style.style_columns(), *clusters.moment_columns(), rules.first_page())
    return facts.withColumn("is_uniform", uniform).drop("size_std", "n_sizes")


def routed(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Blocks with all that is known about their documents: rules apply where ``is_uniform``, clustering elsewhere.

    Rows without a text, which the rules need, get no traits. Give it a stored table.
    """
    known = with_traits(blocks) if "text" in blocks.columns else blocks
    return with_facts(known, lambda rows, by: document_facts(rows, settings, by), "inner")


def placed_blocks(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Blocks with traits, dealt by document and bucket; on ordinary pages with the gap above each block too."""
    long_pages = layout.has_long_pages(lines) if settings.long_pages is None else settings.long_pages
    raw = layout.to_dealt_blocks(lines, settings.heading_keywords, long_pages)
    blocks = with_vectors(with_features(raw))
    return with_traits(blocks if long_pages else rules.with_gaps(blocks))


def first_labels(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Labels of either labeller, before corrections, with the bucket of each row. Give it a stored table.

    What clustering asks of the varied documents is stored by document and bucket, and so are its labels, which meet the
    blocks without a shuffle; rows are labelled in one pass over both kinds of documents. Facts about a document are
    summed again for that pass, where its blocks lie, so that no second copy of the blocks is stored.
    """
    placed = blocks if BUCKET in blocks.columns else stage_table(dealt(blocks), "placed", PLACE)
    if "gap" not in placed.columns and not has_split_pages(placed):
        placed = rules.with_gaps(placed)
    rows = routed(placed, settings)
    varied = accounts.watched(rows, "routed", uniform=F.col("is_uniform")).filter("NOT is_uniform")
    varied = stage_table(varied.select(*PLACE, "seq", "fontsize", "n_blocks", "feature_vector", *clusters.MOMENTS), "routed", PLACE)
    alone, others = by_extent(varied)
    found = clusters.cluster_members(clusters.scale(alone), settings.n_clusters, settings.task_blocks, by=PLACE)
    if others is not None:
        found = found.unionByName(dealt(clusters.cluster_members(clusters.scale(others), settings.n_clusters, settings.task_blocks)))
    members = stage_table(accounts.watched(found, "clusters"), "clusters", PLACE)
    rows = rows.drop("n_blocks", *clusters.MOMENTS)
    own_features = F.col("features")
    if "space_before" not in rows.schema["features"].dataType.fieldNames():
        own_features = own_features.withField("space_before", F.lit(None).cast("double"))
    scored = rules.with_space_before(rows.withColumn("own_features", own_features))
    scored = scored.withColumn("heading_score", rules.heading_score(rules.optional_styles(rows)))
    labelled = scored.join(members, [*PLACE, "seq"], "left").withColumns({
        "predicted_label": F.when(F.col("is_uniform"), rules.scored_label(settings.title_words)).otherwise(F.col("cluster_name")),
        "place": F.when(F.col("is_uniform"), rules.rule_order()).otherwise(postprocess.list_order()),
        "features": F.when(F.col("is_uniform"), F.col("features")).otherwise(F.col("own_features")),
    })
    labelled = accounts.watched(labelled, "scored", noise=F.col("predicted_label") == "Noise")
    return labelled.filter("predicted_label != 'Noise'").drop(
        "own_features", "heading_score", "cluster_name", "is_uniform", "first_page", "tops_page")


def label_blocks(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Blocks with their final labels. Give it a stored table.

    Labelling works on rows without long texts; their labels join the stored blocks once, at the end.
    """
    narrow = stage_table(first_labels(heading_texts(blocks, settings), settings), "labels", PLACE)
    final = postprocess.post_process(narrow, settings.repeat_pages, settings.max_heading_words)
    labels = final.select(
        *PLACE, "page_number", "seq", "place", "predicted_label", "cluster_label", "settled", F.col("features.space_before").alias("space_before"))
    whole = with_traits(blocks if BUCKET in blocks.columns else dealt(blocks)).join(labels, [*PLACE, "page_number", "seq"])
    return whole.withColumn("features", F.col("features").withField("space_before", F.col("space_before"))).drop("space_before", BUCKET, *GAP)


def heading_texts(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Keep only the texts an outline can show.

    A title or heading has few words and does not start in lower case, so the
    long texts end here; traits stand for them in the steps that follow.
    """
    words = F.coalesce(F.col("features.word_count"), F.lit(0))
    shown = (words <= settings.max_heading_words) & F.col("traits.valid_start")
    return with_traits(blocks).withColumn("text", F.when(shown, F.col("text"))).drop("fontname")


def outlines(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One outline row per document.

    Long texts are shuffled once, with the lines, to the tasks of their document's buckets; all stages are stored by these
    keys. Only blocks that may end as a title or heading go through the corrections, and a document's first title
    is found where its headings meet anyway.
    """
    blocks = accounts.watched(heading_texts(placed_blocks(lines, settings), settings), "blocks", lines=F.col("n_lines"))
    return outlines_of(stage_table(blocks, "blocks", PLACE), settings)


def outlines_of(narrow: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One outline row per document of a stored table of blocks without long texts."""
    needed = [*PLACE, "page_number", "seq", "text", "place", "predicted_label", "traits", "features.word_count"]
    labelled = stage_table(accounts.watched(first_labels(narrow, settings).select(*needed), "labels"), "labels", PLACE)
    accounts.remember("labels", labelled)
    repeats = postprocess.repeated_keys(labelled, settings.repeat_pages)
    heads = postprocess.candidates(labelled).withColumn("features", F.struct("word_count"))
    numbered = postprocess.override_by_number(postprocess.with_repeats(heads, repeats))
    return outline.outline_of_candidates(numbered, labelled.select(DOC).distinct(), settings.max_heading_words)


def run(documents: DataFrame, lines: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """All stage tables, the outlines, the rejected documents and the report."""
    rejects = stage_table(report.unusable_lines(lines), "rejects")
    lines = report.usable_lines(lines, rejects)
    blocks = stage_table(placed_blocks(lines, settings), "blocks", PLACE)
    return _made(documents, lines, blocks, settings) | {"rejects": rejects}


def accounted_outlines(lines: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """Stored outlines and the counts of all stages. Fails if rows went missing on the way.

    Beside the stages' own counts it takes one more pass over the texts of the lines and one over the names of the labelled documents.
    """
    with accounts.account() as book:
        book.enter("lines", rows=lines.count(), nonblank=layout.nonblank_lines(layout.horizontal_lines(lines)).count())
        made = outlines(lines, settings)
        made = stage_table(accounts.watched(made, "outlines", headings=F.size("outline")), "outlines")
        book.enter("labels", documents=book.stored["labels"].select(DOC).distinct().count())
        return made, book.settle()


def kept_outlines(spark: SparkSession, lines: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Outlines in ``folder``/outlines. If a run breaks off, the next one with the same input goes on at the first stage missing.

    ``lines`` must be a table of files. The stage tables go when the outlines are written.
    """
    path = f"{folder.rstrip('/')}/outlines"
    with runs.open_run(spark, folder, f"{runs.file_fingerprint(lines)} {settings}") as ledger:
        sinks.write_stage(outlines(lines, settings), path)
        ledger.close()
    return spark.read.parquet(path)


def file_outlines(spark: SparkSession, parsed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Outlines of parsed block files."""
    blocks = files.explode_blocks(parsed).select(*FILE_BLOCK)
    return outlines_of(stage_table(dealt(heading_texts(with_vectors(blocks), settings)), "blocks", PLACE), settings)


def update_outlines(spark: SparkSession, folder: str, out: str, settings: Settings = Settings(), n_parts: int = 64) -> dict[str, int]:
    """Bring the results under ``out`` up to date with a folder of block files; only what changed is worked on.

    Every file has one row: document, fingerprint of its bytes, why it was left out (if it was) and its outline.
    Rows lie in ``n_parts`` folders by document. Files that are new, have other bytes or are gone decide which folders are
    written anew; in those, the rows of other documents are carried over. Gives the numbers of files and folders.
    """
    listed = stage_table(changes.fingerprints(files.block_files(spark, folder)), "fingerprints")
    before = changes.stored_results(spark, out)
    differ = stage_table(changes.compare(listed, before), "changes")
    fresh = files.parse_files(files.block_files(spark, folder, differ.filter("change != 'gone'").select("path")), twins_of=listed)
    fresh = stage_table(fresh, "parsed")
    made = file_outlines(spark, fresh, settings)
    rows = differ.filter("change != 'gone'").select(DOC, "path", "fingerprint").join(fresh.select("path", "reason"), "path", "left").join(made, DOC, "left")
    return changes.replace_parts(spark, out, rows, before, differ, n_parts)


def run_files(spark: SparkSession, folder: str, out: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """From a folder of block files to outlines under ``out``, which replace what is there."""
    blocks, rejects = files.read_blocks(spark, folder)
    blocks = stage_table(dealt(with_traits(with_vectors(blocks.select(*FILE_BLOCK)))), "blocks", PLACE)
    documents = files.discover_documents(spark, folder, "json")
    made = _made(documents, None, blocks, settings) | {"rejects": stage_table(rejects, "rejects")}
    sinks.write_outlines(made["outlines"], out)
    return made


def _made(documents: DataFrame, lines: DataFrame | None, blocks: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    labelled = stage_table(label_blocks(blocks, settings), "labelled")
    made = stage_table(outline.document_outline(labelled), "outlines")
    return {
        "blocks": blocks.drop(BUCKET, *GAP),
        "labelled": labelled,
        "outlines": made,
        "unsettled": labelled.filter("NOT settled").select(DOC).distinct(),
        "report": report.run_report(documents, lines, blocks, labelled, made),
    }
