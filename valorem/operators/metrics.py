"""Evaluation datasets: RMSE per group, model x segment pivot, calibration
factor, and the mean baselines every model is compared with.

All of them are single grouped aggregates over the scored rows, so they
scale with the row count and need no driver-side loop over models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(scored: DataFrame, by: list[str], label: str = "Value_log", prediction: str = "prediction",
         digits: int = 6) -> DataFrame:
    """sqrt(mean((prediction - label)^2)) and row count per group."""
    err = F.pow(F.col(prediction) - F.col(label), 2)
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err)), digits).alias("rmse"))


def pivot_segments(df: DataFrame, value: str, segments: tuple[str, ...] = ("goalkeeper", "field")) -> DataFrame:
    """model rows x one column per segment (explicit pivot values: no extra job)."""
    return df.groupBy("model").pivot("segment", list(segments)).agg(F.first(value))


def calibration(scored: DataFrame, by: list[str], label: str = "Value_log", prediction: str = "prediction",
                digits: int = 6) -> DataFrame:
    """sum(actual) / sum(predicted) on the money scale — the multiplicative
    factor that makes predicted totals match actual totals."""
    return scored.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(F.expm1(label)), F.sum(F.expm1(prediction))), digits).alias("factor"))


def baseline_predictions(prepared: DataFrame) -> DataFrame:
    """Rows scored by two label-mean baselines fitted on the training split:
    ``segment_mean`` (mean log value of the row's segment) and ``global_mean``."""
    train = prepared.filter(F.col("split") == "train")
    seg_means = train.groupBy("segment").agg(F.avg("Value_log").alias("seg_mean"))
    all_mean = train.agg(F.avg("Value_log")).scalar()
    base = prepared.select("segment", "split", "Value_log")
    # one row per model segment: bounded broadcast
    by_seg = base.join(F.broadcast(seg_means), "segment").select(
        F.lit("segment_mean").alias("model"), "segment", "split", "Value_log", F.col("seg_mean").alias("prediction"))
    by_all = base.select(F.lit("global_mean").alias("model"), "segment", "split", "Value_log",
                         all_mean.alias("prediction"))
    return by_seg.unionByName(by_all)
