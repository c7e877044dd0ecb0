"""Linear models from moment matrices: against plain least squares, Spark ML, and rows held out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.plans import moments, train
from valorem.sources.tables import master

from conftest import SF_SMALL


def matrix(x, y):
    rows = np.column_stack([np.ones(len(y)), x, y])
    return rows.T @ rows


def test_solver():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)) * [1, 10, 0.1, 3] + [5, 0, 2, 1]
    x[:, 3] = 7.0  # constant
    y = x[:, 0] * 2 - x[:, 1] * 0.3 + rng.normal(size=200)
    b, a, kkt = moments.solve(matrix(x, y), 0.0, 0.0)
    want = np.linalg.lstsq(np.column_stack([np.ones(200), x[:, :3]]), y, rcond=None)[0]
    assert np.allclose([a, *b[:3]], want, atol=1e-8) and b[3] == 0 and kkt < 1e-9
    b, a, kkt = moments.solve(matrix(x, y), 0.5, 0.7)
    assert kkt < 1e-9 and b[2] == 0
    assert moments.held_out_rmse(matrix(x, y), b, a) == pytest.approx(np.sqrt(np.mean((x @ b + a - y) ** 2)), rel=1e-9)
    assert moments.solve(matrix(x, np.full(200, 4.0)), 0.1, 0.5)[1] == pytest.approx(4.0)


def test_folds_and_ridge_as_spark_ml(spark):
    prepared = train.prepare_training(master(spark, SF_SMALL)).filter("segment = 'field'")
    rows = prepared.withColumn("fold", F.pmod(F.xxhash64("ID"), F.lit(3)).cast("int"))
    folds = moments.matrices(rows, "field", "fold")
    whole = moments.matrices(rows.withColumn("all", F.lit(0)), "field", "all")[0]
    assert len(folds) == 3 and np.allclose(sum(folds.values()), whole, rtol=1e-12)
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    est = LinearRegression(featuresCol="scaled_features", labelCol=train.LABEL, regParam=0.1)
    model = Pipeline(stages=train.feature_stages("field") + [est]).fit(rows)
    own, intercept, _ = moments.solve(whole, 0.1, 0.0)
    ml = model.stages[-1].coefficients.toArray() / model.stages[1].std.toArray()
    assert np.allclose(own, ml, rtol=1e-6, atol=1e-9) and intercept == pytest.approx(model.stages[-1].intercept, rel=1e-6)
    found = moments.cross_validated(rows, "field")
    assert len(found) == len(moments.GRID) and {p["model"] for p in found if p["chosen"]} == {"linear", "elastic"}
    holed = rows.withColumn("Age", F.lit(None).cast("int"))
    assert moments.moments(holed, "field", ["fold"]).count() == 0
    assert S.CV_FOLDS["field"] == 2
