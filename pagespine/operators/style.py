"""Whether a document uses one type style throughout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.constants import MIN_BLOCKS, STD_THRESHOLD, UNIQUE_THRESHOLD


def style_columns() -> list[Column]:
    """Aggregates of a document that the verdict rests on."""
    size = F.coalesce(F.col("fontsize"), F.lit(0.0))
    return [
        F.count("*").alias("n_blocks"),
        F.stddev_pop(size).alias("size_std"),
        F.count_distinct(size).alias("n_sizes"),
    ]


def is_uniform(
    std_threshold: float = STD_THRESHOLD, unique_threshold: int = UNIQUE_THRESHOLD, min_blocks: int = MIN_BLOCKS
) -> Column:
    """Enough blocks, and sizes that hardly differ or are hardly more than one."""
    flat = (F.col("size_std") < std_threshold) | (F.col("n_sizes") <= unique_threshold)
    return (F.col("n_blocks") >= min_blocks) & flat


def style_stats(blocks: DataFrame, *thresholds) -> DataFrame:
    """Per document: number of blocks, spread and variety of font sizes, and the verdict."""
    return blocks.groupBy("document_name").agg(*style_columns()).withColumn("is_uniform", is_uniform(*thresholds))
