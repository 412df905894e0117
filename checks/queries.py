"""One query per operator, over the given documents laid out as in ``checks.tables``."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import tables
from pagespine.functions import text as T
from pagespine.operators import corpus_model as corpus
from pagespine.operators import clusters, features, layout, outline, postprocess, rules, style
from pagespine.operators.spread import BUCKET, PLACE, attach
from pagespine.plans import outlines as plan
from pagespine.plans import runs
from pagespine.session import STORED_AS, checkpoint_dir, remove, stage_table
from pagespine.sources import changes, files, report, sinks
from pagespine.streaming import arrivals

DOC = "document_name"
LINE = [DOC, "page_number", "line_no"]
BLOCK = [DOC, "page_number", "seq"]
FEATURES = [f"features.{n}" for n in ("font_size", "indentation", "is_bold", "y_coordinate", "centering_offset", "word_count")]


def _doc_number():
    return F.expr("CAST(replace(document_name, 'doc_', '') AS BIGINT)")


def _json_outline():
    return F.to_json(F.struct("title", "outline")).alias("outline")


def _documents(spark, sf):
    return tables.documents(spark, sf).select(F.concat(F.lit("doc_"), "doc_id").alias(DOC))


def _raw(spark, sf):
    return layout.to_raw_blocks(tables.lines(spark, sf))


def _nonblank(spark, sf):
    return layout.nonblank_lines(tables.lines(spark, sf))


def _outlines(spark, sf):
    return outline.document_outline(tables.finished(spark, sf))


def _predicate(make, name):
    def query(spark, sf):
        text = T.strip(F.col("text"))
        return tables.raw(spark, sf).select(DOC, "seq", make(text).alias(name))

    return query


# Sources and sinks

def discover_documents(spark, sf):
    """The files found in the given folder, each with the rows it holds."""
    found = files.discover_documents(spark, sf, suffix="parquet").select("filename", DOC)
    held = spark.read.parquet(f"{sf}/*.parquet").groupBy(F.col("_metadata.file_name").alias("filename")).agg(F.count("*").alias("n_rows"))
    return found.join(held, "filename", "left").select("filename", DOC, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def document_name(spark, sf):
    named = tables.documents(spark, sf).withColumn(
        "file_name",
        F.expr("""CASE doc_id % 4 WHEN 0 THEN concat('doc_', doc_id, '.pdf') WHEN 1 THEN concat('doc.v2_', doc_id, '.PDF')
                  WHEN 2 THEN concat('.doc_', doc_id) ELSE concat('doc_', doc_id) END"""),
    )
    return named.select("doc_id", files.base_name(F.col("file_name")).alias(DOC))


#: Folders that the block files lie in. One is written when the one before has been read and is gone, so the disk never holds all of them.
BLOCK_FOLDERS = 8


def _packed_blocks(spark, sf):
    """A JSON block array per document, by folder; every seventh one is broken, and some lack a size or have a wrong one."""
    number = _doc_number() % 7
    size = F.when(number != 3, F.when(number == 5, F.concat(F.col("fontsize").cast("string"), F.lit("pt"))).otherwise(F.col("fontsize").cast("string")))
    block = F.struct("text", "fontname", size.alias("fontsize"), "page_number", "features")
    ordered = F.sort_array(F.collect_list(F.struct("seq", block.alias("block"))))
    value = F.regexp_replace(F.to_json(F.transform(ordered, lambda r: r["block"])), r'"fontsize":"([0-9.]+)"', '"fontsize":$1')
    packed = tables.blocks(spark, sf).groupBy(DOC).agg(value.alias("value"))
    broken = F.substring("value", 2, 2**31 - 1)
    files_of = packed.withColumn("value", F.when(number == 0, broken).otherwise(F.col("value")))
    folder = F.pmod(F.xxhash64(DOC), F.lit(BLOCK_FOLDERS)).cast("int").alias("folder")
    path = f"{checkpoint_dir(spark)}/packed-blocks-{uuid.uuid4().hex}"
    rows = files_of.select(F.concat(DOC, F.lit(".txt")).alias("name"), "value", folder)
    rows.write.partitionBy("folder").option("compression", STORED_AS).parquet(path)
    return spark.read.schema("name string, value string, folder int").parquet(path)


def _from_block_files(spark, sf, **options):
    """What is read of all block files, and what is left out. ``read_blocks`` stores it, so a folder may go once it has been read."""
    packed, read = _packed_blocks(spark, sf), []
    for folder in range(BLOCK_FOLDERS):
        path = f"{checkpoint_dir(spark)}/block-files-{uuid.uuid4().hex}"
        if not sinks.write_named_files(packed.filter(F.col("folder") == folder), path).isEmpty():
            read.append(files.read_blocks(spark, path, suffix="txt", **options))
            remove(spark, path)
    return tuple(reduce(DataFrame.unionByName, parts) for parts in zip(*read, strict=True))


def read_blocks(spark, sf):
    return _positions(_from_block_files(spark, sf)[0])


def _positions(blocks):
    seq = blocks.withColumn("position", F.col("seq"))
    same_page = seq.groupBy(DOC, "page_number").agg(F.min("position").alias("page_start"))
    return seq.join(same_page, [DOC, "page_number"]).select(
        DOC, "page_number", F.expr("shiftleft(CAST(page_number AS BIGINT), 32) + position - page_start").alias("seq"),
        "position", "text", "fontname", "fontsize", *FEATURES,
    )


def read_large_blocks(spark, sf):
    """The same files, all taken for too large to be held as a value."""
    return _positions(_from_block_files(spark, sf, large=0)[0])


def reject_malformed(spark, sf):
    return _from_block_files(spark, sf)[1]


def _damaged_lines(spark, sf):
    """Every eleventh document lacks a coordinate on some lines."""
    gap = (_doc_number() % 11 == 0) & (F.col("line_no") == 0)
    return tables.lines(spark, sf).withColumn("y1", F.when(~gap, F.col("y1")))


def rejects(spark, sf):
    return report.unusable_lines(_damaged_lines(spark, sf))


def write_stage(spark, sf):
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    sinks.write_stage(tables.ruled(spark, sf), path)  # what stands there goes
    sinks.write_stage(tables.blocks(spark, sf), path)
    return spark.read.parquet(path).select(*BLOCK, "text", "fontname", "fontsize", *FEATURES)


def skipped_documents(spark, sf):
    """Some documents lose a coordinate, others all of their text; no block is left of either."""
    damaged = _damaged_lines(spark, sf)
    blank = F.when(_doc_number() % 11 == 1, F.lit(" \t ")).otherwise(F.col("text"))
    usable = report.usable_lines(damaged, report.unusable_lines(damaged)).withColumn("text", blank)
    return report.skipped_documents(_documents(spark, sf), layout.to_raw_blocks(usable))


def run_report(spark, sf):
    return report.run_report(
        _documents(spark, sf), tables.lines(spark, sf), tables.narrow(spark, sf), tables.finished(spark, sf), _outlines(spark, sf)
    )


def outline_json(spark, sf):
    return outline.outline_json(_outlines(spark, sf))


def outline_wrapped(spark, sf):
    wrapped = outline.wrapped_outline(_outlines(spark, sf))
    return wrapped.select(
        DOC, "document_info.filename", "document_info.base_name",
        F.array_join("document_info.pipeline_stages", ",").alias("pipeline_stages"), F.to_json("outline").alias("outline"),
    )


# Lines to blocks

def line_style(spark, sf):
    return layout.line_styles(tables.chars(spark, sf))


def line_style_default(spark, sf):
    return layout.with_line_styles(tables.lines(spark, sf), tables.chars(spark, sf)).select(*LINE, "fontname", "fontsize")


def nonblank_lines(spark, sf):
    """Every fifth line counts as vertical here."""
    turned = F.when(F.col("line_no") % 5 == 4, "vertical").otherwise("horizontal")
    lines = tables.lines(spark, sf).withColumn("orientation", turned)
    return layout.nonblank_lines(layout.horizontal_lines(lines)).select(*LINE, "text")


def first_word(spark, sf):
    return _nonblank(spark, sf).select(*LINE, T.first_word(F.col("text")).alias("first_word"))


def keyword_start(spark, sf):
    return _nonblank(spark, sf).select(*LINE, T.starts_with_keyword(F.col("text")).alias("keyword_start"))


def style_change(spark, sf):
    return layout.style_changes(_nonblank(spark, sf)).select(*LINE, "style_change")


def block_id(spark, sf):
    return layout.number_blocks(_nonblank(spark, sf)).select(*LINE, "block_no")


def block_text(spark, sf):
    return _raw(spark, sf).select(*BLOCK, "text")


def block_bbox(spark, sf):
    return _raw(spark, sf).select(*BLOCK, "bbox.*")


def block_style(spark, sf):
    return _raw(spark, sf).select(*BLOCK, "fontname", "fontsize")


def blocks_raw(spark, sf):
    stored = tables.stored(spark, sf, "raw", lambda: tables.raw(spark, sf), PLACE)
    placed = layout.list_positions(stored)
    return placed.select(*BLOCK, "position", "text", "fontname", "fontsize", "bbox.*", "page_width", "page_height")


def block_features(spark, sf):
    return features.with_features(_raw(spark, sf)).select(*BLOCK, *FEATURES)


def featured_blocks(spark, sf):
    return features.with_features(_raw(spark, sf)).select(*BLOCK, "text", "fontname", "fontsize", *FEATURES)


# Vectors

def _vector_columns(df):
    return df.select(*BLOCK, *[F.col("feature_vector")[i].alias(f"v{i}") for i in range(7)])


def feature_defaults(spark, sf):
    """Every other block of a page loses three of its features."""
    some = F.col("block_no") % 2 == 1
    thin = F.col("features")
    for name in ("font_size", "centering_offset", "y_coordinate"):
        thin = thin.withField(name, F.when(some, F.col(f"features.{name}")))
    return _vector_columns(features.with_vectors(tables.blocks(spark, sf).withColumn("features", thin)))


def indent_ratio(spark, sf):
    return tables.blocks(spark, sf).select(*BLOCK, features.indent_ratio().alias("indent_ratio"))


def feature_vectors(spark, sf):
    return _vector_columns(features.with_vectors(features.with_features(_raw(spark, sf))))


# Style and rules

def style_uniform(spark, sf):
    return style.style_stats(tables.unstored_blocks(spark, sf)).withColumn("size_std", F.round("size_std", 6))


def route_documents(spark, sf):
    return plan.routed(tables.measured(spark, sf)).select(DOC, "seq", "is_uniform")


def rule_order(spark, sf):
    ordered = tables.ruled(spark, sf).withColumn("place", rules.rule_order())
    return layout.list_positions(ordered.select(*BLOCK, BUCKET, "place"), ["place"]).select(DOC, "seq", "position")


def space_before(spark, sf):
    spaced = rules.with_space_before(tables.ruled(spark, sf))
    return spaced.select(DOC, "seq", F.round("features.space_before", 6).alias("space_before"))


def drop_noise(spark, sf):
    return rules.rule_labels(tables.ruled(spark, sf)).select(DOC, "seq", "text")


def heading_score(spark, sf):
    """With the styles that some inputs give: every third block is in italics, and so on."""
    given = F.col("features")
    for n, name in enumerate(("is_italics", "is_underline", "is_all_caps")):
        given = given.withField(name, (F.col("block_no") % (n + 3) == 0).cast("int"))
    return rules.score_blocks(tables.ruled(spark, sf).withColumn("features", given)).select(DOC, "seq", "heading_score")


def score_label(spark, sf):
    return rules.score_blocks(tables.ruled(spark, sf)).select(DOC, "seq", rules.score_label(F.col("heading_score")).alias("score_label"))


def rule_labels(spark, sf):
    return rules.rule_labels(tables.ruled(spark, sf)).select(DOC, "seq", "text", "predicted_label")


# Clusters

def _grouped(spark, sf):
    """Stored by document and bucket, so that blocks meet the facts about their clusters without a shuffle."""
    return tables.stored(spark, sf, "grouped", lambda: clusters.placed_clusters(_to_cluster(spark, sf)), PLACE)


def _to_cluster(spark, sf):
    """What clustering and the labels of clusters ask of a block."""
    return tables.varied(spark, sf).select(*BLOCK, BUCKET, "fontsize", "feature_vector")


def cluster_k(spark, sf):
    """The number of centers that clustering starts from."""
    scaled = clusters.scale(tables.with_facts(spark, sf).filter("NOT is_uniform"))
    start = clusters.LargeDocumentKMeans(scaled).seeds()
    return start.select(DOC, sum(F.col(c).isNotNull().cast("int") for c in start.columns if c != DOC).alias("k"))


def scaled_features(spark, sf):
    return clusters.scale(tables.with_facts(spark, sf).filter("NOT is_uniform")).select(DOC, "seq", *clusters.AXES)


def document_kmeans(spark, sf):
    return clusters.cluster_blocks(_to_cluster(spark, sf)).select(DOC, "seq", "cluster_label")


def large_document_kmeans(spark, sf):
    """The way of documents beyond one task, taken for all."""
    return clusters.cluster_blocks(_to_cluster(spark, sf), task_blocks=0).select(DOC, "seq", "cluster_label")


def corpus_model(spark, sf):
    """One model over the blocks of all documents: fitted, saved, loaded and applied."""
    points = tables.stored(spark, sf, "points", lambda: corpus.with_points(tables.vectors(spark, sf)))
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    corpus.save(corpus.fit(points), path)
    return corpus.cluster_sizes(corpus.load(path), points)


def clustering_state(spark, sf):
    return clusters.clustering_state(_grouped(spark, sf))


def cluster_font(spark, sf):
    return clusters.cluster_fonts(_grouped(spark, sf))


def cluster_rank(spark, sf):
    return clusters.cluster_ranks(clusters.cluster_fonts(_grouped(spark, sf)))


def cluster_labels(spark, sf):
    return clusters.cluster_labels(_grouped(spark, sf)).select(DOC, "seq", "cluster_label", "predicted_label")


# Corrections

def text_pages(spark, sf):
    return postprocess.text_pages(tables.labelled(spark, sf))


def repeating_text(spark, sf):
    return postprocess.repeated_keys(tables.labelled(spark, sf)).select(DOC, "text_key").distinct()


def _repeats(spark, sf):
    """Stored by document and bucket, as the labels are, so that they meet without a shuffle."""
    needed = [*PLACE, "page_number", "seq", "place", "predicted_label", "traits", "features"]
    blocks = tables.labelled(spark, sf).select(*needed)

    def flagged():
        repeats = postprocess.repeated_keys(blocks)
        return attach(postprocess.with_repeats(blocks, repeats), postprocess.first_titles(blocks, repeats), [DOC], places=blocks)

    return tables.stored(spark, sf, "flagged", flagged, PLACE)


def reject_non_headings(spark, sf):
    return _repeats(spark, sf).select(DOC, "seq", "repeated", (F.col("repeated") | F.col("traits.rejected")).alias("dismissed"))


def numbering_override(spark, sf):
    return postprocess.override_by_number(_repeats(spark, sf)).select(DOC, "seq", "predicted_label")


def single_title(spark, sf):
    return postprocess.keep_first_title(postprocess.override_by_number(_repeats(spark, sf))).select(DOC, "seq", "predicted_label")


def demote_headings(spark, sf):
    named = postprocess.keep_first_title(postprocess.override_by_number(_repeats(spark, sf)))
    return postprocess.demote(named).select(DOC, "seq", "predicted_label")


def post_process(spark, sf):
    return tables.whole_finished(spark, sf).select(*BLOCK, "text", "predicted_label")


# Outlines

def outline_order(spark, sf):
    blocks = tables.finished(spark, sf)
    placed = blocks.withColumn("place", outline.outline_order(blocks.columns))
    return layout.list_positions(placed.select(*BLOCK, BUCKET, "place"), ["place"]).select(DOC, "seq", "position")


def document_title(spark, sf):
    return outline.document_titles(tables.finished(spark, sf))


def headings(spark, sf):
    return outline.headings(tables.finished(spark, sf)).select(DOC, F.col("place.place.seq").alias("seq"), "level", "text", "page")


def document_outline(spark, sf):
    return _outlines(spark, sf).select(DOC, "title", F.size("outline").alias("n_headings"), _json_outline())


def empty_outlines(spark, sf):
    return outline.empty_outlines(_outlines(spark, sf))


def outlines_end_to_end(spark, sf):
    return plan.outlines(tables.lines(spark, sf)).select(DOC, "title", _json_outline())


# Runs that keep what they made

def _block_arrays(spark, sf):
    """A JSON block array per document, under the name of its file."""
    block = F.struct("text", "fontname", "fontsize", "page_number", "features")
    ordered = F.sort_array(F.collect_list(F.struct("seq", block.alias("block"))))
    packed = tables.blocks(spark, sf).groupBy(DOC).agg(F.to_json(F.transform(ordered, lambda r: r["block"])).alias("value"))
    return packed.select(F.concat(DOC, F.lit(".json")).alias("name"), "value")


def _shown(outlines):
    return outlines.select(DOC, "title", F.size("outline").alias("n_headings"), _json_outline())


def streamed_outlines(spark, sf):
    """Block files that arrive in a folder, in two batches, read back from the sink."""
    folder = f"{checkpoint_dir(spark)}/arriving-{uuid.uuid4().hex}"
    sinks.write_named_files(stage_table(_block_arrays(spark, sf), "block-arrays"), folder)
    half = -(-files.listed(spark, folder, "json").count() // 2)
    arrivals.watch(spark, folder, f"{folder}-out", f"{folder}-checkpoint", files_per_batch=half).awaitTermination()
    return _shown(arrivals.outlines(spark, f"{folder}-out"))


def updated_outlines(spark, sf):
    """A first run without every ninth document and with the others of every seventh place cut to an empty array; then all of them."""
    number = F.crc32(F.col("name").cast("binary"))
    folder = f"{checkpoint_dir(spark)}/changing-{uuid.uuid4().hex}"
    rows = stage_table(_block_arrays(spark, sf), "block-arrays")
    first = rows.filter(number % 9 != 0).withColumn("value", F.when(number % 7 == 0, "[]").otherwise(F.col("value")))
    for state in (first, rows):
        sinks.write_named_files(state, folder)
        plan.update_outlines(spark, folder, f"{folder}-out", n_parts=16)
    return _shown(changes.outlines_in(spark, f"{folder}-out"))


def resumed_outlines(spark, sf):
    """A run that breaks off after its labels and is taken up again."""
    folder = f"{checkpoint_dir(spark)}/kept-{uuid.uuid4().hex}"
    lines = tables.lines(spark, sf)
    with runs.open_run(spark, folder, f"{runs.file_fingerprint(lines)} {plan.Settings()}"):
        plan.outlines(lines)  # all stages are stored, the outlines are not
    return _shown(plan.kept_outlines(spark, lines, folder))


def accounted_rows(spark, sf):
    """What every stage of the whole run counted."""
    _, totals = plan.accounted_outlines(tables.lines(spark, sf))
    rows = [(stage, name, n) for stage, counts in totals.items() for name, n in counts.items()]
    return spark.createDataFrame(rows, "stage string, counted string, n bigint")


PREDICATES = {
    "is_page_number": T.is_page_number,
    "is_mostly_punct": T.is_mostly_punctuation,
    "is_symbols_digits": T.is_only_symbols_or_digits,
    "is_date": T.is_date,
    "is_toc_entry": T.is_contents_entry,
    "is_citation": T.is_citation,
    "valid_heading_start": T.is_valid_heading_start,
    "numbering_level": T.numbering_level,
    "is_upper": T.is_upper,
    "is_alnum": T.is_alnum,
}

QUERIES = {
    f.__name__: f
    for f in (
        discover_documents, document_name, read_blocks, reject_malformed, rejects, write_stage, skipped_documents,
        run_report, outline_json, outline_wrapped, line_style, line_style_default, nonblank_lines, first_word,
        keyword_start, style_change, block_id, block_text, block_bbox, block_style, blocks_raw, block_features,
        featured_blocks, feature_defaults, indent_ratio, feature_vectors, style_uniform, route_documents, rule_order,
        space_before, drop_noise, heading_score, score_label, rule_labels, cluster_k, scaled_features, document_kmeans,
        large_document_kmeans, cluster_font, cluster_rank, cluster_labels, text_pages, repeating_text,
        reject_non_headings, numbering_override, single_title, demote_headings, post_process, outline_order,
        document_title, headings, document_outline, empty_outlines, outlines_end_to_end,
        streamed_outlines, updated_outlines, resumed_outlines, accounted_rows, clustering_state, corpus_model, read_large_blocks,
    )
}
QUERIES.update({name: _predicate(make, name) for name, make in PREDICATES.items()})
