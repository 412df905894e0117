"""From raw documents to packed training sequences.

Each stage works on all that the one before it kept and is stored before the next one starts,
so a lost executor costs one stage's work at most. All but the last return the columns of
the documents.
"""

import uuid

from pagespine.llm import contamination, lines, near_duplicates, packing, quality
from pagespine.session import checkpoint_dir


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the quality policy."""
    return quality.filtered(docs)


def line_dedup(spark, docs, sf_dir):
    """Documents without the lines whose templates recur across them."""
    return lines.without_boilerplate(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return near_duplicates.deduplicated(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without any passage of the benchmark."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark, docs, sf_dir):
    """Pieces of documents in sequences of tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Tokenizing and packing are not expressible; tests/llm/test_pipeline.py follows every stage in plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
