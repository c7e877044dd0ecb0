"""Report datasets: group totals and shares, distinct top-k, filtered top-k,
prediction attachment and two-entity comparison tables.

De-duplication is written as a ``min_by``/``max_by`` aggregate over a struct
ordering key instead of a ``row_number`` window: the aggregate combines
map-side, so a name that holds a third of all rows never lands whole in one
task. Top-k is ``orderBy(...).limit(k)``, which Spark plans as a per-partition
top-k followed by a merge of k rows per partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import skew


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coercing numeric parse: anything that is not a number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with null (or NaN) in any of ``columns``."""
    cond = None
    for c in columns:
        dt = dict(df.dtypes)[c]
        ok = F.col(c).isNotNull()
        if dt in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df.filter(cond) if cond is not None else df


def report_base(df: DataFrame) -> DataFrame:
    """Master rows as the reports see them: numbers coerced, incomplete rows dropped."""
    return drop_missing(coerce_numeric(df, ["Value", "Wage", "Age", "Prediction_euros"]), S.REPORT_REQUIRED)


def keep_first(df: DataFrame, key: str, order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple.

    A null key forms one group, like pandas' drop_duplicates.
    """
    cols = [c for c in (columns or df.columns) if c != key]
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(picked).select(key, *[F.col("_row")[c].alias(c) for c in cols])


def top_distinct(df: DataFrame, key: str, value: str, k: int, columns: list[str],
                 tiebreak: str = "ID", prune: bool = True, sample_factor: int = 4) -> DataFrame:
    """Highest ``value`` per ``key``, then the k largest; ties broken by tiebreak, then key.

    With ``prune`` the de-duplication only sees rows that can matter: the
    top ``sample_factor * k`` rows by value (a per-partition top-k, no
    shuffle of the data) give the k-th largest per-key maximum among them,
    ``L``. At least k keys really reach ``L``, so every key of the answer has
    its maximum at or above it, and rows below ``L`` are dropped before the
    shuffle. ``L`` enters as a scalar subquery; when the sample holds fewer
    than k keys there is no filter. The result is exact either way.
    """
    needed = list(dict.fromkeys([key, value, tiebreak, *columns]))
    rows = df.select(*needed)
    if prune:
        sample = rows.filter(F.col(value).isNotNull()).orderBy(F.col(value).desc()).limit(sample_factor * k)
        per_key = sample.groupBy(key).agg(F.max(value).alias("_mx")).orderBy(F.col("_mx").desc()).limit(k)
        bound = per_key.agg(F.when(F.count(F.lit(1)) == k, F.min("_mx")).alias("_lo")).select("_lo").scalar()
        rows = rows.filter(bound.isNull() | (F.col(value) >= bound))
    # rows with a value first, then the highest value, then the smallest tiebreak
    best = keep_first(rows, key, [F.col(value).isNull(), -F.col(value), F.col(tiebreak)])
    return best.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k).select(*columns)


def top_filtered(df: DataFrame, condition: Column, value: str, k: int, columns: list[str],
                 tiebreak: str = "ID") -> DataFrame:
    """k largest ``value`` among rows satisfying ``condition`` (no de-duplication)."""
    return (df.filter(condition).orderBy(F.col(value).desc(), F.col(tiebreak).asc())
              .limit(k).select(*columns))


def group_total_share(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Sum of ``value`` per ``key`` (null keys dropped), the k largest, and each one's
    share of the displayed total in percent with one decimal."""
    totals = (df.filter(F.col(key).isNotNull()).groupBy(key)
                .agg(F.sum(value).alias("total_value"))
                .orderBy(F.col("total_value").desc(), F.col(key).asc()).limit(k))
    # the window runs over the k rows left after the limit
    whole = Window.partitionBy()
    return totals.select(
        key,
        F.round("total_value", 2).alias("total_value"),
        F.round(F.try_divide(F.col("total_value") * 100.0, F.sum("total_value").over(whole)), 1).alias("share_pct"),
    )


def attach_predictions(df: DataFrame, prediction_sets: list[DataFrame], key: str = "Name",
                       prediction: str = "Prediction_euros", fallback: str = "Value",
                       salt: int = 0, salt_by: str = "ID", spread: int = 0) -> DataFrame:
    """Left-join predictions on ``key``; the earlier set wins for a key present twice,
    and rows without a prediction fall back to ``fallback``.

    With ``spread`` (the join's partitions) the names with a large share of
    ``df`` are found first and they alone are dealt over salts by ``salt_by``
    (``skew.spread_join``). With ``salt`` > 1 every name is salted that many
    times. Either way a hot key does not depend on adaptive skew handling.

    Each set carries (key, prediction, order) columns; ``order`` (any
    orderable column, e.g. a struct) breaks ties inside a set. Several sources
    already in one frame can be passed as one set with the precedence as the
    first field of ``order`` — one scan instead of one per source.
    """
    tagged = None
    for i, p in enumerate(prediction_sets):
        t = p.select(key, prediction, F.col("order").alias("_order")).withColumn("_src", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    preds = keep_first(tagged, key, [F.col("_src"), F.col("_order")], [key, prediction])
    if spread > 1:
        joined = skew.spread_join(df, preds, key, skew.hot_keys(df, key, spread), salt_by)
    elif salt > 1:
        # a key holding a large share of ``df`` is split over ``salt`` join
        # partitions: each row draws a salt from its own id, and the
        # prediction side (one row per key) is replicated once per salt value
        left = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt)).cast("int"))
        right = preds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        joined = left.join(right, [key, "_salt"], "left").drop("_salt")
    else:
        joined = df.join(preds, key, "left")
    return joined.withColumn(prediction, F.coalesce(F.col(prediction), F.col(fallback)))


def comparison_long(df: DataFrame, names: list[str], categories: list[str],
                    key: str = "Name", order: str = "ID") -> DataFrame:
    """Long table comparing entities on ``categories`` (value / 100, radar angle,
    polygon closed by repeating the first category)."""
    chosen = keep_first(df.filter(F.col(key).isin(names)), key, [F.col(order)], [key, *categories])
    n = len(categories)
    pos_cats = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("category"),
                                  F.col(c).cast("double").alias("raw")) for i, c in enumerate(categories)]
                       + [F.struct(F.lit(n).alias("pos"), F.lit(categories[0]).alias("category"),
                                   F.col(categories[0]).cast("double").alias("raw"))])
    label = F.array_position(F.array(*[F.lit(x) for x in names]), F.col(key)).cast("int")
    return (chosen.select(F.col(key).alias("entity"), label.alias("entity_pos"), F.inline(pos_cats))
                  .select("entity", "entity_pos", "pos", "category",
                          F.round(F.col("pos") / F.lit(float(n)) * F.lit(2 * math.pi), 6).alias("angle"),
                          (F.col("raw") / 100.0).alias("ratio")))
