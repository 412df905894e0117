"""What later steps ask of a block's text, worked out once and kept narrow."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagespine.functions import text as T


def with_traits(blocks: DataFrame) -> DataFrame:
    """Add ``traits``, so that labelling need not carry or shuffle whole texts.

    ``text_key`` stands for the stripped text in equality tests; ``""`` marks an empty one.
    """
    if "traits" in blocks.columns:
        return blocks
    text = F.col("stripped")
    words = F.col("features.word_count")
    traits = F.struct(
        F.when(F.length(text) <= 64, text).otherwise(F.sha2(text, 256)).alias("text_key"),
        T.never_heading(text).alias("rejected"),
        T.numbering_level(text).alias("level"),
        T.is_valid_heading_start(text).alias("valid_start"),
        T.is_upper(text).alias("upper"),
        (T.is_page_number(text) | ((words == 1) & ~T.is_alnum(text))).alias("noise"),
    )
    return blocks.withColumn("stripped", T.strip(F.col("text"))).withColumn("traits", traits).drop("stripped")
