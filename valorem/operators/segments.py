"""Segment tagging, the stable hash split and segment sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions import clean

CATEGORY = "Position category"
CATEGORY_INDEXED = "Position category indexed"


def with_segments(df: DataFrame, category: str = CATEGORY) -> DataFrame:
    """Normalise the category (lower, null -> 'unknown'), index it, tag the model segment."""
    return (df.withColumn(category, clean.normalized_category(category))
              .withColumn(CATEGORY_INDEXED, clean.category_index(category))
              .withColumn("segment", clean.model_segment(CATEGORY_INDEXED)))


def segment_rows(df: DataFrame, segment: str) -> DataFrame:
    """Rows of one model segment (equality filter for goalkeeper, membership for field)."""
    idx = S.GOALKEEPER_INDEXES if segment == "goalkeeper" else S.FIELD_INDEXES
    col = F.col(CATEGORY_INDEXED)
    cond = (col == float(idx[0])) if len(idx) == 1 else col.isin([float(i) for i in idx])
    return df.filter(cond)


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from the md5 of the key (null key -> 0).

    Unlike ``randomSplit`` it depends neither on partitioning nor on row
    order, so a row lands in the same split on every run and every engine.
    """
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(h % F.lit(buckets), F.lit(0))


def with_split(df: DataFrame, key: str = "ID", train_percent: int = S.TRAIN_FRACTION_PERCENT) -> DataFrame:
    return df.withColumn("split", F.when(hash_bucket(key) < train_percent, F.lit("train")).otherwise(F.lit("test")))


def segment_counts(df: DataFrame) -> DataFrame:
    """Rows per category with its index and model segment — one grouped pass."""
    tagged = with_segments(df)
    return (tagged.groupBy(CATEGORY, CATEGORY_INDEXED, "segment")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.col(CATEGORY).alias("category"),
                          F.col(CATEGORY_INDEXED).alias("category_index"),
                          F.coalesce(F.col("segment"), F.lit("excluded")).alias("model_segment"),
                          "n"))
