"""Models as tables: the evaluator agrees with ``transform`` and sees small changes; importances from nodes."""

import re

import pytest
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.plans import train, trees
from valorem.sources.tables import master

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    prepared = train.prepare_training(master(spark, SF_SMALL)).cache()
    return prepared, train.fitted_models(spark, prepared, S.MODEL_KINDS, tune=False)


def test_every_prediction_agrees_and_a_changed_one_does_not(spark, fitted):
    prepared, models = fitted
    holed = prepared.withColumn("Age", F.when(~F.col("ID").like("%7"), F.col("Age")))
    scored = train.predict(models, holed, S.MODEL_KINDS)
    got = trees.checked(scored, models).groupBy("model").agg(F.count("*").alias("n"), F.min("same").alias("same"), F.count("prediction").alias("p")).collect()
    assert {r.model for r in got} == set(S.MODEL_KINDS) and all(r.same and 0 < r.p < r.n for r in got)
    moved = trees.checked(scored.withColumn("prediction", F.col("prediction") + 1e-6), models)
    assert moved.filter("prediction is not null").agg(F.max("same")).first()[0] is False
    assert trees.checked(scored.withColumn("prediction", F.lit(None).cast("double")), models).filter("same and size(missing_features) = 0").count() == 0


def test_nodes_are_whole_trees(spark, fitted):
    _, models = fitted
    nodes = trees.forest_nodes(models, spark)
    got = nodes.groupBy("segment", "model", "tree").agg(F.count("*").alias("n"), F.max("node").alias("last"), F.count_if(F.col("low") < 0).alias("leaves")).collect()
    assert len(got) == sum(m.stages[-1].getNumTrees for m in models.values() if hasattr(m.stages[-1], "trees"))
    assert all(r.last == r.n - 1 and r.n == 2 * r.leaves - 1 for r in got)


def test_importances_from_nodes(spark, fitted):
    _, models = fitted
    own = {(r.segment, r.model, r.feature): r.importance for r in trees.importances(models, spark).collect()}
    for r in train.importances(models, spark).collect():
        if r.model.startswith("forest"):
            assert abs(own.get((r.segment, r.model, r.feature), 0.0) - r.importance) < 1e-9


def test_no_forest(spark, fitted):
    prepared, models = fitted
    linear = {k: m for k, m in models.items() if k[1] == "linear"}
    assert trees.importances(linear, spark).count() == 0
    assert trees.checked(train.predict(linear, prepared, ["linear", "forest"]), linear).agg(F.min("same")).first()[0] is True


def test_the_models_are_no_column_beside_the_rows(spark, fitted):
    """A joined column of trees was copied for each row: time grew as rows x nodes."""
    prepared, models = fitted
    plan = trees.checked(train.predict(models, prepared, ["forest"]), models)._jdf.queryExecution().optimizedPlan().toString()
    above = [ln.strip(" +-").split(" ")[0] for ln in plan.splitlines() if re.match(r" *(\+- )?[A-Z]", ln)]  # from the result down to the two segments
    above = above[:above.index("Union")] if "Union" in above else above
    assert "Generate" in above and not {"Join", "Window"} & set(above), above


def test_going_down_ten_levels_is_compiled(spark, fitted):
    """The JVM leaves methods of over 8,000 bytes to its interpreter; the grids' deepest trees have ten levels."""
    prepared, models = fitted
    deep = {k: m.copy() for k, m in models.items()}
    for (_, kind), m in deep.items():
        if kind.startswith("forest"):
            m.stages[-1].setMaxDepth(10) if hasattr(m.stages[-1], "setMaxDepth") else m.stages[-1]._set(maxDepth=10)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = trees.checked(train.predict(deep, prepared, S.MODEL_KINDS), deep, ["ID", "segment", "model", "prediction", "missing_features"])
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000, sizes


def test_rows_that_repeat_come_out_as_often(spark, fitted):
    prepared, models = fitted
    scored = train.predict(models, prepared.unionByName(prepared), S.MODEL_KINDS)
    got = trees.checked(scored, models, ["ID", "segment", "model", "prediction", "missing_features"])
    assert got.columns == ["ID", "segment", "model", "prediction", "missing_features", "same"]
    assert got.count() == scored.count() and got.agg(F.min("same")).first()[0] is True
    assert got.select("ID", "segment", "model", "prediction").exceptAll(scored.select("ID", "segment", "model", "prediction")).count() == 0
