"""Fitted models as tables, and an evaluator of them that does not use ``transform``.

``forest_nodes``  every node of every tree as a row (from the forests' own saved form).
``checked``       scored rows with ``same``: the prediction computed again from that row.
``importances``   feature importances recomputed from the nodes' gains and weights.

The evaluator takes each row once for each tree of its forest and goes down a
level at a time by projections, then averages the leaves by row. The nodes are
arrays that all rows of a task share (scalar subqueries): as a joined column of
trees they were copied beside each row, and lambdas that go down such trees are
not compiled. No value but the averages is shuffled. The arrays' size follows
from the grids and not from the data: at most 120 trees of depth 8 or 50 of
depth 10, some 100,000 nodes (about 3 MB) a model, two segments and two such kinds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.session import scratch_path

TOLERANCE = 1e-9


def _has_trees(model) -> bool:
    return hasattr(model.stages[-1], "trees")


def forest_nodes(models: dict, spark: SparkSession) -> DataFrame:
    """segment, model, tree, node, feature, threshold, low, high, prediction, gain, weight.

    ``low`` and ``high`` are the nodes for values up to and over the
    threshold (of the scaled feature); both are -1 in a leaf, whose feature and
    threshold are null.
    """
    parts = []
    for (segment, kind), model in models.items():
        if not _has_trees(model):
            continue
        path = scratch_path(spark, f"nodes-{segment}-{kind}")
        model.stages[-1].write().save(path)
        n = F.col("nodeData")
        leaf = n.leftChild < 0
        parts.append(spark.read.parquet(f"{path}/data").select(
            F.lit(segment).alias("segment"), F.lit(kind).alias("model"), F.col("treeID").alias("tree"), n.id.alias("node"),
            F.when(~leaf, n.split.featureIndex).alias("feature"), F.when(~leaf, F.get(n.split.leftCategoriesOrThreshold, F.lit(0))).alias("threshold"),
            n.leftChild.alias("low"), n.rightChild.alias("high"), n.prediction.alias("prediction"), n.gain.alias("gain"),
            F.get(n.impurityStats, F.lit(0)).alias("weight")))
    if not parts:
        return spark.createDataFrame([], "segment string, model string, tree int, node int, feature int, threshold double, low int, high int, "
                                         "prediction double, gain double, weight double")
    return reduce(DataFrame.unionByName, parts)


def _placed(nodes: DataFrame) -> tuple[DataFrame, dict[tuple[str, str], list[int]]]:
    """``nodes`` with their ``place`` when the nodes of all trees stand one after another, and the places of each forest's roots.

    Nodes are numbered 0, 1, ... within a tree; there is one row a tree on the driver.
    """
    starts, roots, place = [], {}, 0
    for r in nodes.groupBy("segment", "model", "tree").count().orderBy("segment", "model", "tree").collect():
        starts.append((r["segment"], r["model"], r["tree"], place))
        roots.setdefault((r["segment"], r["model"]), []).append(place)
        place += r["count"]
    known = nodes.sparkSession.createDataFrame(starts, "segment string, model string, tree int, start int")
    return nodes.join(F.broadcast(known), ["segment", "model", "tree"]).withColumn("place", F.col("start") + F.col("node")), roots


def _shared(placed: DataFrame) -> dict[str, Column]:
    """What the nodes hold in the order of their places: arrays, each a single value (a scalar subquery). A leaf leads to itself."""
    leaf = F.col("low") < 0
    held = {"_feature": F.when(leaf, 0).otherwise(F.col("feature")), "_threshold": F.when(leaf, 0.0).otherwise(F.col("threshold")),
            "_low": F.when(leaf, F.col("place")).otherwise(F.col("start") + F.col("low")),
            "_high": F.when(leaf, F.col("place")).otherwise(F.col("start") + F.col("high")), "_leaf": F.col("prediction")}
    return {name: placed.agg(F.sort_array(F.collect_list(F.struct("place", value.alias("value"))))["value"].alias(name)).scalar()
            for name, value in held.items()}


def _values(segment: str, model) -> list[Column]:
    """The row's features in the segment's order, scaled as the model scales them."""
    std = model.stages[1].std.toArray().tolist()
    return [F.col(f).cast("double") * F.lit(1.0 / s if s else 0.0) for f, s in zip(S.segment_features(segment), std)]


def _linear(values: list[Column], coefficients: list[float], intercept: float) -> Column:
    return reduce(Column.__add__, [F.lit(c) * v for c, v in zip(coefficients, values)], F.lit(intercept))


def checked(scored: DataFrame, models: dict, keep: list[str] | None = None) -> DataFrame:
    """``scored`` (the output of train.predict), or its columns ``keep``, with ``same``: the prediction is that of the model's table, within TOLERANCE.

    A row without a prediction is the same when it misses features or its model does not exist.
    """
    kept = keep or scored.columns
    placed, roots = _placed(forest_nodes(models, scored.sparkSession))
    known, none, depth = F.lit(False), F.array(F.lit(-1)), 0  # -1: no node
    x, linear, trees = F.lit(None).cast("array<double>"), F.lit(None).cast("double"), none
    for (segment, kind), model in models.items():
        own, last, values = (F.col("segment") == segment) & (F.col("model") == kind), model.stages[-1], _values(segment, model)
        known = F.coalesce(own, F.lit(False)) | known
        if _has_trees(model):
            x, depth = F.when(own, F.array(*values)).otherwise(x), max(depth, last.getOrDefault("maxDepth"))
            trees = F.when(own, F.lit(roots[(segment, kind)])).otherwise(trees)
        else:
            linear = F.when(own, _linear(values, last.coefficients.toArray().tolist(), float(last.intercept))).otherwise(linear)
    lacking, shared = (F.size("missing_features") > 0) | ~known, _shared(placed)
    at = (scored.withColumns({"_row": F.monotonically_increasing_id(), "_lacking": lacking, "_linear": linear, "_x": x,
                              "_trees": F.when(lacking, none).otherwise(trees), **shared})
          .select(*kept, "_row", "_lacking", "_linear", "_x", *shared, F.explode("_trees").alias("_at")))
    # each tree of each row, a level at a time; a leaf stays where it is
    for _ in range(depth):
        low = F.get("_x", F.get("_feature", F.col("_at"))) <= F.get("_threshold", F.col("_at"))
        at = at.withColumn("_at", F.when(low, F.get("_low", F.col("_at"))).otherwise(F.get("_high", F.col("_at"))))
    # Rows are told apart by number: all their columns may repeat.
    again = (at.groupBy(*kept, "_row", "_lacking").agg(F.avg(F.coalesce(F.get("_leaf", F.col("_at")), F.col("_linear"))).alias("_again")))
    same = F.when(F.col("_lacking"), F.col("prediction").isNull()).otherwise(F.coalesce(F.abs(F.col("prediction") - F.col("_again")) <= TOLERANCE, F.lit(False)))
    return again.select(*kept, same.alias("same"))


def importances(models: dict, spark: SparkSession) -> DataFrame:
    """segment, model, feature, importance of the forests: gain x weight by feature, each tree's and then the forest's summing to 1."""
    inner = forest_nodes(models, spark).filter("low >= 0")
    by_tree = inner.groupBy("segment", "model", "tree").agg(F.sum(F.col("gain") * F.col("weight")).alias("of_tree"))
    share = (inner.groupBy("segment", "model", "tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("own"))
             .join(by_tree.filter("of_tree <> 0"), ["segment", "model", "tree"])
             .groupBy("segment", "model", "feature").agg(F.sum(F.col("own") / F.col("of_tree")).alias("own")))
    total = share.groupBy("segment", "model").agg(F.sum("own").alias("total"))
    names = F.coalesce(*[F.when(F.col("segment") == s, F.get(F.array(*[F.lit(f) for f in S.segment_features(s)]), F.col("feature"))) for s in S.SEGMENTS])
    return (share.join(total, ["segment", "model"])
            .select("segment", "model", names.alias("feature"), (F.col("own") / F.col("total")).alias("importance")))
