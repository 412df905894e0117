"""Layout features of blocks and their vectors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.constants import DEFAULT_CENTERING_OFFSET
from pagespine.functions import text as T
from pagespine.functions.numbers import round_half_even


def with_features(raw_blocks: DataFrame) -> DataFrame:
    """Replace box and page size by the features derived from them."""
    left, right = F.col("bbox.x0"), F.col("bbox.x1")
    measured = raw_blocks.withColumns(
        {"left": left, "top": F.col("bbox.y1"), "off_center": F.abs(left + (right - left) / 2 - F.col("page_width") / 2)}
    ).withColumns(
        {
            "font_size": F.col("fontsize").cast("double"),
            "indentation": round_half_even(F.col("left"), 2),
            "is_bold": F.lower("fontname").contains("bold").cast("int"),
            "y_coordinate": round_half_even(F.col("top"), 2),
            "centering_offset": round_half_even(F.col("off_center"), 2),
            "word_count": T.word_count(F.col("text")) if "text" in raw_blocks.columns else F.col("word_count"),
        }
    )
    names = ["font_size", "indentation", "is_bold", "y_coordinate", "centering_offset", "word_count"]
    return measured.withColumn("features", F.struct(*names)).drop(
        "bbox", "page_width", "page_height", "left", "top", "off_center", *names
    )


def feature(name: str, default: float = 0.0) -> Column:
    return F.coalesce(F.col(f"features.{name}").cast("double"), F.lit(default))


def indent_ratio() -> Column:
    size = feature("font_size")
    return F.when(size > 0, feature("indentation") / size).otherwise(F.lit(0.0))


def with_vectors(blocks: DataFrame) -> DataFrame:
    """Add the seven numbers that clustering compares; absent features take their defaults."""
    vector = F.array(
        feature("font_size"),
        feature("indentation"),
        feature("is_bold"),
        feature("centering_offset", DEFAULT_CENTERING_OFFSET),
        feature("word_count"),
        feature("y_coordinate"),
        round_half_even(F.col("indent_ratio"), 3),
    )
    return blocks.withColumn("indent_ratio", indent_ratio()).withColumn("feature_vector", vector).drop("indent_ratio")
