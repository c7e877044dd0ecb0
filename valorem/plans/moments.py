"""Linear models from sufficient statistics: one scan whatever the grid and the number of folds.

``moments`` gives n and every sum of products of (1, features, label) by
group, so any union of groups is a sum of matrices: the training set of a
fold is the whole less the fold. ``solve`` fits ridge (Cholesky) and elastic
net (coordinate descent) on such a matrix, of at most 12 x 12 numbers, with
the objective of Spark ML's LinearRegression (features and label in units of
their standard deviation). ``held_out_rmse`` needs no rows either.

Only the matrices reach the driver: groups x 12 x 12 numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.plans import train

#: (model, regParam, elasticNetParam): the grid points of train.grid.
GRID = ([("linear", r, 0.0) for r in (0.1, 1.0)] + [("elastic", r, a) for r in (0.01, 0.1) for a in (0.3, 0.7)])


def terms(segment: str) -> list[str]:
    return ["1", *S.segment_features(segment), train.LABEL]


def moments(rows: DataFrame, segment: str, by: list[str]) -> DataFrame:
    """``by``, row, col, total: sum of row x col over the group's complete rows, for the upper triangle of terms()."""
    names = terms(segment)
    value = {n: F.lit(1.0) if n == "1" else F.col(n).cast("double") for n in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    whole = rows.filter((F.col("segment") == segment) & (F.size(train.missing_features(segment)) == 0))
    sums = whole.groupBy(*by).agg(*[F.sum(value[a] * value[b]).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    out = F.explode(F.array(*[F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"_{i}").alias("total")) for i, (a, b) in enumerate(pairs)]))
    return sums.select(*by, out.alias("m")).select(*by, "m.*")


def matrices(rows: DataFrame, segment: str, by: str) -> dict[int, np.ndarray]:
    """The moments of each group as a symmetric matrix, by the group's key."""
    place = {n: i for i, n in enumerate(terms(segment))}
    out: dict[int, np.ndarray] = {}
    for r in moments(rows, segment, [by]).collect():
        m = out.setdefault(r[by], np.zeros((len(place), len(place))))
        m[place[r["row"]], place[r["col"]]] = m[place[r["col"]], place[r["row"]]] = r["total"]
    return out


def solve(m: np.ndarray, reg: float, alpha: float, tolerance: float = 1e-12) -> tuple[np.ndarray, float, float]:
    """(coefficients of the features as they are, intercept, largest violation of the optimality conditions)."""
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    if sd[-1] == 0:
        return np.zeros(len(sd) - 1), float(mean[-1]), 0.0
    unit = np.where(sd > 0, sd, 1.0)
    corr = cov / np.outer(unit, unit)
    r, c = corr[:-1, :-1].copy(), corr[:-1, -1]
    flat = sd[:-1] == 0
    l1, l2 = reg / sd[-1] * alpha, reg / sd[-1] * (1 - alpha)
    r[np.diag_indices_from(r)] += l2
    r[flat, flat] = 1.0  # a constant feature has no part in c, so its weight stays 0
    if l1 == 0:
        low = np.linalg.cholesky(r)
        w = np.linalg.solve(low.T, np.linalg.solve(low, c))
    else:
        w = np.zeros(len(c))
        for _ in range(100_000):
            before = w.copy()
            for j in range(len(w)):
                rest = c[j] - r[j] @ w + r[j, j] * w[j]
                w[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / r[j, j]
            if np.abs(w - before).max() < tolerance:
                break
    slope = c - r @ w
    kkt = np.where(w != 0, np.abs(slope - l1 * np.sign(w)), np.maximum(np.abs(slope) - l1, 0.0)).max()
    coefficients = np.where(flat, 0.0, w * sd[-1] / unit[:-1])
    return coefficients, float(mean[-1] - coefficients @ mean[:-1]), float(kkt)


def held_out_rmse(m: np.ndarray, coefficients: np.ndarray, intercept: float) -> float:
    """RMSE of a linear model on the rows of a matrix."""
    b = np.concatenate(([intercept], coefficients, [-1.0]))
    return float(np.sqrt(max(b @ m @ b, 0.0) / m[0, 0]))


def gap(m: np.ndarray, one: tuple[np.ndarray, float], other: tuple[np.ndarray, float]) -> float:
    """Root mean square difference of two linear models on the rows of a matrix, in standard deviations of the label."""
    b = np.concatenate(([one[1] - other[1]], one[0] - other[0]))
    n = m[0, 0]
    sd = np.sqrt(m[-1, -1] / n - (m[0, -1] / n) ** 2)
    return float(np.sqrt(max(b @ m[:-1, :-1] @ b, 0.0) / n) / sd)


def cross_validated(rows: DataFrame, segment: str, fold: str = "fold", others: dict | None = None) -> list[dict]:
    """Per grid point its mean held-out RMSE over the folds, whether it is its model's best, and the fit on all rows.

    ``others``: (model, reg, alpha) -> (coefficients, intercept) of models to be compared, whose gap() is given.
    """
    folds = matrices(rows, segment, fold)
    whole = sum(folds.values())
    out = []
    for model, reg, alpha in GRID:
        errors = [held_out_rmse(m, *solve(whole - m, reg, alpha)[:2]) for m in folds.values()]
        coefficients, intercept, kkt = solve(whole, reg, alpha)
        other = (others or {}).get((model, reg, alpha))
        away = gap(whole, (coefficients, intercept), (np.array(other[0]), other[1])) if other else None
        out.append({"segment": segment, "model": model, "reg": reg, "alpha": alpha, "rmse": float(np.mean(errors)),
                    "coefficients": coefficients.tolist(), "intercept": intercept, "kkt": kkt, "gap": away})
    for point in out:
        point["chosen"] = point["rmse"] == min(p["rmse"] for p in out if p["model"] == point["model"])
    return out


def linear_cv(spark: SparkSession, prepared: DataFrame, others: dict | None = None) -> DataFrame:
    """cross_validated of every segment on the training split, with the folds of train.fit: segment, model, reg, alpha, rmse, chosen, kkt, gap, ...

    ``others``: by segment, as for cross_validated.
    """
    rows = []
    for segment in S.SEGMENTS:
        part = prepared.filter((F.col("split") == "train") & (F.col("segment") == segment))
        part = part.withColumn("fold", F.pmod(F.xxhash64("ID", F.lit(train.SEED)), F.lit(S.CV_FOLDS[segment])).cast("int"))
        rows += [tuple(p.values()) for p in cross_validated(part, segment, others=(others or {}).get(segment))] if not part.isEmpty() else []
    return spark.createDataFrame(rows, "segment string, model string, reg double, alpha double, rmse double, coefficients array<double>, "
                                       "intercept double, kkt double, gap double, chosen boolean")
