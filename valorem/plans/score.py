"""Scoring of tables and what-if requests with fitted segment models.

Scoring never filters on the label: the band fitted at training time only
*flags* rows outside it (``is_outlier``), so a single unlabelled row can be
scored. The inverse transform is ``expm1`` times a calibration factor
(default 1.0; the original application hard-coded about 9.934, available as
``schema.CALIBRATION_FACTOR_REFERENCE``); the what-if form path uses
``exp(prediction) * scale`` as the original did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions.clean import feed_route
from valorem.operators import prepare, segments, validate
from valorem.plans import train, trees


def score_table(models: dict, df: DataFrame, kinds: list[str], factor: float = 1.0,
                route_unknown_to_field: bool = False, band: DataFrame | None = None,
                cap: float = S.VALUE_CAP, check: bool = False) -> DataFrame:
    """(ID, Name, segment, model, prediction, Prediction_euros) for every row of
    ``df`` in a model segment — or, with ``route_unknown_to_field``, every row
    (the listener's routing: 'gardien' -> goalkeeper, anything else -> field).
    A row that misses features has a null prediction and their names in ``missing_features``.
    Missing kinds fall back to ``forest``.

    With ``band`` (the frozen training band, ``prepare.fit_band``) rows are
    never dropped: ``is_outlier`` flags those whose capped log value lies
    outside it (rows without a value are not outliers). With ``check``,
    ``same`` tells whether the models' tables give the same prediction.
    """
    tagged = segments.with_segments(df)
    if route_unknown_to_field:
        tagged = tagged.withColumn("segment", feed_route("Position category"))
    tagged = tagged.filter(F.col("segment").isNotNull())
    extra = []
    if band is not None:
        tagged = prepare.apply_band(prepare.cap_log(tagged, cap), band, "segment", drop=False)
        tagged = tagged.withColumn("is_outlier", F.col("is_outlier") & F.col("Value_log").isNotNull())
        extra = ["is_outlier"]
    usable = [k if any(key[1] == k for key in models) else "forest" for k in kinds]
    scored = train.predict(models, tagged, list(dict.fromkeys(usable)))
    out = ["ID", "Name", "segment", "model", "prediction", "missing_features", *extra]
    if check:
        scored, out = trees.checked(scored, models, out), [*out, "same"]
    euros = (F.expm1("prediction") * F.lit(factor)).alias("Prediction_euros")
    return scored.select(*out[:5], euros, *out[5:])


def whatif(models: dict, requests: DataFrame, kind: str = "forest", scale: float = S.WHATIF_SCALE) -> DataFrame:
    """Validate requests, score the valid ones: exp(prediction) * scale; invalid
    rows keep their error and a null prediction."""
    checked = validate.validate(requests).withColumn(
        "segment", F.when(F.col("is_goalkeeper"), F.lit("goalkeeper")).otherwise(F.lit("field")))
    # all rows are scored in place (no join back); invalid ones get a null value
    scored = train.predict({k: m for k, m in models.items() if k[1] == kind}, checked, [kind])
    return scored.select("ID", "is_goalkeeper", "valid", "error",
                         F.when(F.col("valid"), F.exp("prediction") * F.lit(scale)).alias("predicted_value"))
