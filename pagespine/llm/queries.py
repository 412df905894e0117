"""The operators of this subpackage as queries over the given tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from pagespine.llm import (
    byte_bpe, contamination, filter_audit, languages, licenses, lines, near_duplicates, oracles, packing, periodic_runs, pii, quality, secrets, warc,
)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    return pii.scan(_table(spark, sf_dir, "documents"))


def op2_secrets(spark, sf_dir):
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark, sf_dir):
    return near_duplicates.scan(_table(spark, sf_dir, "documents"))


def op4_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_languages(spark, sf_dir):
    return languages.identify(_table(spark, sf_dir, "documents"))


def op6_contamination(spark, sf_dir):
    found = contamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["e"] - x["s"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
        F.array_max(F.transform("matches", lambda m: m["length"])).alias("longest"),
    )


def op7_line_dedup(spark, sf_dir):
    return lines.scan(_table(spark, sf_dir, "documents"))


def op8_licenses(spark, sf_dir):
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    found = warc.archive(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured")


def op10_quality_rules(spark, sf_dir):
    book = quality.ledger(_table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id", "measures.n_words", "measures.word_chars", "measures.n_symbols", "measures.n_dup_lines", "measures.n_repeat_words",
        (~quality.passes(book.failures, "base")).alias("base_failed"), quality.passes(book.failures).alias("kept"), "failures",
    )


def op11_byte_bpe(spark, sf_dir):
    made = byte_bpe.round_trip(_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.scan(periodic_runs.with_periodic_tails(_table(spark, sf_dir, "documents")))
    run = "struct<start: bigint, length: bigint, period: bigint>"
    # Runs are listed by start, then period; only a strictly greater exponent takes the place of an earlier one.
    strongest = F.aggregate("runs", F.lit(None).cast(run), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    ended = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("best", strongest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(ended, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_filter_audit(spark, sf_dir):
    words = filter_audit.survival_words(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audit(filter_audit.subset_survivors(words))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_secrets, op3_near_duplicates, op4_packing, op5_languages, op6_contamination, op7_line_dedup,
        op8_licenses, op9_warc, op10_quality_rules, op11_byte_bpe, op12_periodic_runs, op13_filter_audit,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES = oracles.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
