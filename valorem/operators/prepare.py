"""Model-ready preparation: cap -> log1p -> sigma-band trim, and scaler statistics.

Statistics are *fitted* once into a small frame (one row per segment) and
then *applied*: training filters the band, scoring only flags rows outside
it (a single message has no standard deviation of its own). The statistics
frame has one row per model segment — at most two — so broadcasting it is
bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions.clean import capped


def cap_log(df: DataFrame, cap: float = S.VALUE_CAP, value: str = "Value") -> DataFrame:
    """Winsorise Value at ``cap`` (None: no cap) and add Value_log = log1p(Value)."""
    out = df.withColumn(value, capped(value, cap)) if cap is not None else df
    return out.withColumn("Value_log", F.log1p(F.col(value)))


def sigma_for(group: str | None, sigmas: dict[str, float] = S.TRIM_SIGMAS, default: float = 3.0) -> Column:
    if group is None:
        return F.lit(default)
    expr = None
    for seg, k in sigmas.items():
        expr = F.when(F.col(group) == seg, F.lit(k)) if expr is None else expr.when(F.col(group) == seg, F.lit(k))
    return expr.otherwise(F.lit(default))


def fit_band(df: DataFrame, group: str = "segment", sigmas: dict[str, float] = S.TRIM_SIGMAS) -> DataFrame:
    """(group, mean, sd, lo, hi) of Value_log per group; sd is the sample stddev, 0 for a single row (which is then its own band)."""
    st = df.groupBy(group).agg(F.avg("Value_log").alias("log_mean"),
                               F.when(F.count("Value_log") > 0, F.coalesce(F.stddev_samp("Value_log"), F.lit(0.0))).alias("log_sd"))
    k = sigma_for(group, sigmas)
    return st.select(group, "log_mean", "log_sd",
                     (F.col("log_mean") - k * F.col("log_sd")).alias("band_lo"),
                     (F.col("log_mean") + k * F.col("log_sd")).alias("band_hi"))


def apply_band(df: DataFrame, band: DataFrame, group: str = "segment", drop: bool = True) -> DataFrame:
    """Keep rows inside [band_lo, band_hi] (inclusive; null Value_log is dropped),
    or with ``drop=False`` flag them with ``is_outlier``.

    Grouped by the model segment the band has at most two rows and is
    broadcast; for any other grouping the join is left to the planner, whose
    adaptive execution broadcasts it only when its measured size allows.
    """
    b = band.select(group, "band_lo", "band_hi")
    j = df.join(F.broadcast(b) if group == "segment" else b, group, "left")
    inside = F.col("Value_log").between(F.col("band_lo"), F.col("band_hi"))
    if drop:
        return j.filter(inside).drop("band_lo", "band_hi")
    return j.withColumn("is_outlier", ~F.coalesce(inside, F.lit(False))).drop("band_lo", "band_hi")


def trim_all(df: DataFrame, k: float = S.TRIM_SIGMAS["feed"]) -> DataFrame:
    """Band over all rows together (statistics as scalar subqueries)."""
    from valorem.operators.profile import scalar_stats
    st = scalar_stats(df, {"m": F.avg("Value_log"), "s": F.stddev_samp("Value_log")})
    m, s = st["m"], st["s"]
    return df.filter(F.col("Value_log").between(m - F.lit(k) * s, m + F.lit(k) * s))


def trim_segments(df: DataFrame, cap: float = S.VALUE_CAP, sigmas: dict[str, float] = S.TRIM_SIGMAS) -> DataFrame:
    """cap -> log -> per-segment band; rows outside every model segment are dropped."""
    seg = cap_log(df.filter(F.col("segment").isNotNull()), cap)
    return apply_band(seg, fit_band(seg, "segment", sigmas), "segment")


def feature_stats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Mean and sample stddev of each feature slot per segment — what a
    ``StandardScaler`` fitted on that segment's vectors holds."""
    aggs, rows = [], []
    all_feats = list(dict.fromkeys(S.GOALKEEPER_FEATURES + S.FIELD_FEATURES))
    for i, f in enumerate(all_feats):
        x = F.col(f).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    for seg, feats in S.SEGMENTS.items():
        for slot, f in enumerate(feats):
            i = all_feats.index(f)
            rows.append(F.when(F.col("segment") == seg, F.struct(
                F.lit(slot).alias("slot"), F.lit(f).alias("feature"),
                F.round(F.col(f"m{i}"), digits).alias("mean"), F.round(F.col(f"s{i}"), digits).alias("std"))))
    per_seg = df.groupBy("segment").agg(*aggs)
    return (per_seg.select("segment", F.explode(F.array_compact(F.array(*rows))).alias("r"))
                   .select("segment", "r.*"))
