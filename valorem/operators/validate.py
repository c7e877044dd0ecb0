"""What-if request validation as one column pass.

Each request carries ``is_goalkeeper`` and one value per feature of its
segment. A value that is null or absent takes its default (required fields 0,
others 1); numbers are truncated to integers. A text that is no number, NaN
and a number beyond the integers are errors, never defaults. The first failing
check (required fields in order, then the segment's other fields) gives the
error text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem import schema as S


def _message(field: str, lo: int, hi: int) -> str:
    if field == "Wage":
        return f"{field} must be between {lo:,} and {hi:,}"
    return f"{field} must be between {lo} and {hi}"


def _bad(field: str) -> str:
    return f"{field} must be a number"


def normalise_requests(df: DataFrame) -> DataFrame:
    """Defaults for missing values, then integer truncation; ``_bad`` lists the fields that hold no such number."""
    out, bad = {}, []
    required = [f for f, _, _ in S.REQUIRED_RANGES]
    for f in dict.fromkeys(required + S.GOALKEEPER_FEATURES + S.FIELD_FEATURES):
        default = F.lit(0 if f in required else 1).cast("bigint")
        if f not in df.columns:
            out[f] = default
            continue
        given = F.col(f)
        x = given.try_cast("double")
        x = F.when(~F.isnan(x) & (F.abs(x) < 9e18), x).try_cast("bigint")
        out[f] = F.when(given.isNull(), default).otherwise(x)
        bad.append(F.when(given.isNotNull() & x.isNull(), F.lit(f)))
    return df.withColumns({"_bad": F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>"), **out})


def _check(field: str, lo: int, hi: int) -> F.Column:
    return (F.when(F.array_contains("_bad", field), F.lit(_bad(field)))
            .when(~F.col(field).between(lo, hi), F.lit(_message(field, lo, hi))))


def validate(df: DataFrame) -> DataFrame:
    """Adds ``error`` (null when valid) and ``valid``."""
    req = normalise_requests(df)
    gk = F.col("is_goalkeeper")
    checks = []
    for f, lo, hi in S.REQUIRED_RANGES:
        checks.append(_check(f, lo, hi))
    lo, hi = S.OTHER_RANGE
    gk_only = [f for f in S.GOALKEEPER_FEATURES if f not in S.SHARED_FEATURES]
    field_only = [f for f in S.FIELD_FEATURES if f not in S.SHARED_FEATURES]
    checks.append(F.when(gk, F.coalesce(*[_check(f, lo, hi) for f in gk_only])))
    checks.append(F.when(~gk, F.coalesce(*[_check(f, lo, hi) for f in field_only])))
    err = F.coalesce(*checks)
    return req.withColumn("error", err).withColumn("valid", F.col("error").isNull()).drop("_bad")
