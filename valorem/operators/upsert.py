"""Keyed upsert of a new batch into the master table, and its statistics.

Union by name (missing columns filled with null), then one row per key: the
newest source wins, and inside a source the highest ``seq`` wins. The pick is
a ``max_by`` aggregate, so a key repeated across a third of the rows is
combined map-side rather than in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def read_existing(spark: SparkSession, path: str, fmt: str, like: DataFrame, **options) -> DataFrame:
    """Existing master, or an empty frame with ``like``'s schema when the path is missing."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], like.schema)
        raise


def tagged_union(existing: DataFrame, new: DataFrame, seq: str | None = None) -> DataFrame:
    old = existing.withColumn("_src", F.lit(0))
    fresh = new.withColumn("_src", F.lit(1))
    both = old.unionByName(fresh, allowMissingColumns=True)
    # without a sequence the row's own content decides between repeats: never the partitioning
    return both.withColumn("_seq", F.col(seq) if seq else F.xxhash64(*[F.col(c) for c in both.columns]))


def keep_last(existing: DataFrame, new: DataFrame, key: str = "ID", seq: str | None = None) -> DataFrame:
    both = tagged_union(existing, new, seq)
    cols = [c for c in both.columns if c not in (key, "_seq")]
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct("_src", "_seq")).alias("_row")
    out = both.groupBy(key).agg(picked).select(key, *[F.col("_row")[c].alias(c) for c in cols])
    return out.withColumnRenamed("_src", "source")


def upsert_stats(existing: DataFrame, new: DataFrame, key: str = "ID", seq: str | None = None) -> DataFrame:
    """existing / new / merged rows, added = merged - existing, removed = (existing + new) - merged.

    One pass: rows are grouped by key once (map-side partial counts), and the
    number of groups is the merged row count.
    """
    per_key = tagged_union(existing, new, seq).groupBy(key).agg(
        F.count_if(F.col("_src") == 0).alias("e"), F.count_if(F.col("_src") == 1).alias("n"))
    st = per_key.agg(F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("existing_rows"),
                     F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("new_rows"),
                     F.count(F.lit(1)).alias("merged_rows"))
    return st.select(
        "existing_rows", "new_rows", "merged_rows",
        (F.col("merged_rows") - F.col("existing_rows")).alias("added"),
        (F.col("existing_rows") + F.col("new_rows") - F.col("merged_rows")).alias("removed"))
