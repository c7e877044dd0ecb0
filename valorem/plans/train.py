"""Per-segment regression on log1p(Value): four model kinds, cross-validated.

Each fitted model is one ``PipelineModel`` — assembler + scaler + regressor —
so it can be saved, loaded and applied to new rows as a unit.

Kinds (and their grids, folds: goalkeeper 3, field 2):

* ``forest``      random forest, 20 trees depth 7; grid trees {20, 50} x depth {7, 10}
* ``linear``      plain least squares; grid regParam {0.1, 1.0}
* ``forest_sub``  random forest, 100 trees depth 6, row subsampling 0.8;
                  grid trees {80, 120} x depth {5, 8}
* ``elastic``     elastic net (0.01, 0.5); grid regParam {0.01, 0.1} x alpha {0.3, 0.7}

Determinism: every estimator and the fold split get an explicit seed, and the
training frame is hash-partitioned by whole rows and sorted inside partitions before
fitting, so bagging sees the same rows in the same places on every run.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import prepare, segments

LABEL = "Value_log"
SEED = S.SPLIT_SEED
#: Rows of a partition of the training frame, and the least number of partitions. Bagging and tree
#: splits depend on the number, so it follows from the rows and not from the cluster.
LAYOUT_ROWS = 500_000
LAYOUT_PARTITIONS = 8
#: Training rows of all fits that run at once. A forest keeps about 1 KB a row (bins, bagging counts and node ids of
#: each tree) until it is fitted; more fits at once would spill one another's rows and read them again at every level.
ROWS_AT_ONCE = 8_000_000


def feature_stages(segment: str) -> list:
    """Assemble the segment's features in fixed order, scale to unit stddev (no centring).

    No row is dropped here: ``fit`` is given complete rows only, and ``predict``
    gives rows that miss features a null prediction with their names.
    """
    return [VectorAssembler(inputCols=S.segment_features(segment), outputCol="features", handleInvalid="keep"),
            StandardScaler(inputCol="features", outputCol="scaled_features", withMean=False, withStd=True)]


def missing_features(segment: str) -> F.Column:
    """Names of the segment's features that a row lacks (null or NaN)."""
    return F.array_compact(F.array(*[
        F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), F.lit(f)) for f in S.segment_features(segment)]))


def incomplete_rows(prepared: DataFrame) -> DataFrame:
    """Per segment and split: rows, and rows that miss a feature and therefore can't train or be scored."""
    lacking = F.coalesce(*[F.when(F.col("segment") == s, F.size(missing_features(s)) > 0) for s in S.SEGMENTS], F.lit(False))
    return prepared.groupBy("segment", "split").agg(F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("incomplete"))


# Execution settings of the forests (they do not change the fitted trees):
# larger node batches per pass and cached node ids halve the passes over data.
FOREST_EXEC = dict(maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)


def estimator(kind: str, seed: int = SEED):
    common = dict(featuresCol="scaled_features", labelCol=LABEL)
    if kind == "forest":
        return RandomForestRegressor(numTrees=20, maxDepth=7, seed=seed, **FOREST_EXEC, **common)
    if kind == "linear":
        return LinearRegression(**common)
    if kind == "forest_sub":
        return RandomForestRegressor(numTrees=100, maxDepth=6, subsamplingRate=0.8, seed=seed, **FOREST_EXEC,
                                     **common)
    if kind == "elastic":
        return LinearRegression(regParam=0.01, elasticNetParam=0.5, **common)
    raise ValueError(f"unknown model kind {kind!r}")


def grid(kind: str, est) -> list:
    b = ParamGridBuilder()
    if kind == "forest":
        b = b.addGrid(est.numTrees, [20, 50]).addGrid(est.maxDepth, [7, 10])
    elif kind == "linear":
        b = b.addGrid(est.regParam, [0.1, 1.0])
    elif kind == "forest_sub":
        b = b.addGrid(est.numTrees, [80, 120]).addGrid(est.maxDepth, [5, 8])
    elif kind == "elastic":
        b = b.addGrid(est.regParam, [0.01, 0.1]).addGrid(est.elasticNetParam, [0.3, 0.7])
    return b.build()


def evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="rmse")


def prepare_training(df: DataFrame, cap: float = S.VALUE_CAP, parity: bool = False) -> DataFrame:
    """Master rows -> segment-tagged, split, capped, logged and band-trimmed rows.

    The band is fitted on the training split (``parity=True``: on all rows,
    like the original flow that trimmed before splitting) and applied to both
    splits.
    """
    seg, band = training_band(df, cap, parity)
    return prepare.apply_band(seg, band, "segment")


def training_band(df: DataFrame, cap: float = S.VALUE_CAP, parity: bool = False) -> tuple[DataFrame, DataFrame]:
    """(segment rows capped and logged, the frozen band fitted on them) — the
    band ``prepare_training`` trims with, and scoring flags against."""
    tagged = segments.with_split(segments.with_segments(df))
    seg = prepare.cap_log(tagged.filter(F.col("segment").isNotNull()), cap)
    fit_on = seg if parity else seg.filter(F.col("split") == "train")
    return seg, prepare.fit_band(fit_on, "segment")


def stable_layout(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fixed partition count and in-partition order, for reproducible bagging.

    The count is the caller's, or one for each LAYOUT_ROWS counted rows and at
    least LAYOUT_PARTITIONS, whatever the cluster: the same data give the same
    model everywhere.
    """
    n = partitions or max(LAYOUT_PARTITIONS, -(-df.count() // LAYOUT_ROWS))
    # hash of the whole row: deterministic, and a repeated ID cannot pile up in one partition
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartition(n, row_hash).sortWithinPartitions("ID", row_hash)


def fit(train: DataFrame, segment: str, kind: str, folds: int | None = None, parallelism: int = 4,
        seed: int = SEED, tune: bool = True) -> PipelineModel:
    """Cross-validated fit on one segment; returns the best full PipelineModel."""
    est = estimator(kind, seed)
    pipe = Pipeline(stages=feature_stages(segment) + [est])
    train = train.filter(F.size(missing_features(segment)) == 0)
    if not tune:
        return pipe.fit(train)
    folds = folds or S.CV_FOLDS[segment]
    # The fold follows from the row itself, not from where it lies.
    train = train.withColumn("fold", F.pmod(F.xxhash64("ID", F.lit(seed)), F.lit(folds)).cast("int"))
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid(kind, est), evaluator=evaluator(),
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    return cv.fit(train).bestModel


def fits_at_once(rows: int, jobs: int, parallelism: int) -> tuple[int, int]:
    """(jobs, fits of a job's cross-validation) that run at once, so that together they hold ROWS_AT_ONCE rows at most, or are one fit."""
    most = max(1, ROWS_AT_ONCE // max(1, rows))
    inner = max(1, min(parallelism, most))
    return max(1, min(jobs, most // inner)), inner


_CACHE: dict = {}


def fitted_models(spark: SparkSession, prepared: DataFrame, kinds: list[str], cache_key=None,
                  tune: bool = True, concurrency: int = 8, cv_parallelism: int = 4,
                  layout_partitions: int | None = None) -> dict[tuple[str, str], PipelineModel]:
    """{(segment, kind): model} for both segments; models are reused per cache_key.

    The (segment, kind) fits are independent Spark jobs over one persisted
    training frame; they are submitted from a small thread pool (like
    CrossValidator's ``parallelism``) so that many small jobs overlap
    instead of waiting on each other's scheduling latency. Fewer of them
    overlap when there are many rows (``fits_at_once``).
    """
    out, todo = {}, []
    for segment in S.SEGMENTS:
        for kind in kinds:
            key = (cache_key, segment, kind, tune)
            if cache_key is not None and key in _CACHE:
                out[(segment, kind)] = _CACHE[key]
            else:
                todo.append((segment, kind))
    if not todo:
        return out
    features = dict.fromkeys(f for s in S.SEGMENTS for f in S.segment_features(s))
    train = stable_layout(prepared.filter(F.col("split") == "train").select("segment", "ID", LABEL, *features),
                          layout_partitions).persist()
    # empty-segment guard: one grouped count, then fit only segments with rows
    present = {r["segment"]: r["count"] for r in train.groupBy("segment").count().collect()}
    todo = [job for job in todo if job[0] in present]
    concurrency, cv_parallelism = fits_at_once(max(present.values(), default=0), min(concurrency, len(todo)), cv_parallelism)
    try:
        def run(job):
            segment, kind = job
            t0 = time.time()
            model = fit(train.filter(F.col("segment") == segment), segment, kind, parallelism=cv_parallelism,
                        tune=tune)
            model._fit_seconds = time.time() - t0  # noqa: SLF001
            return job, model

        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for (segment, kind), model in pool.map(run, todo):
                out[(segment, kind)] = model
                if cache_key is not None:
                    _CACHE[(cache_key, segment, kind, tune)] = model
    finally:
        train.unpersist()
    return out


def predict(models: dict, rows: DataFrame, kinds: list[str], route: str = "segment") -> DataFrame:
    """Score every row with its segment's model of each kind; long output with ``model``.

    Per segment, the kinds' models are chained on one pass over the rows
    (each writes its own prediction column), then the predictions are
    stacked — two scans of the input however many kinds are scored.

    Every row of a segment comes out once per kind. Its prediction is null
    when it misses features (``missing_features`` names them) or when the
    segment has no model of that kind.
    """
    if not models:
        raise ValueError("no fitted model for the requested kinds")
    parts = []
    for segment in S.SEGMENTS:
        part = rows.filter(F.col(route) == segment).withColumn("missing_features", missing_features(segment))
        for kind in (k for k in kinds if (segment, k) in models):
            part = (models[(segment, kind)].transform(part)
                    .withColumnRenamed("prediction", f"_pred_{kind}").drop("features", "scaled_features"))
        whole = F.size("missing_features") == 0
        stacked = F.explode(F.array(*[
            F.struct(F.lit(k).alias("model"),
                     (F.when(whole, F.col(f"_pred_{k}")) if (segment, k) in models else F.lit(None).cast("double")).alias("prediction"))
            for k in kinds])).alias("_p")
        keep = [c for c in part.columns if not c.startswith("_pred_")]
        parts.append(part.select(*keep, stacked).select(*keep, "_p.model", "_p.prediction"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def train_eval(spark: SparkSession, master_df: DataFrame, kinds: list[str], cache_key=None,
               tune: bool = True, check: bool = False) -> DataFrame:
    """Test-split predictions (money scale) of every kind in both segments; with ``check`` also ``same`` (trees.checked)."""
    prepared = prepare_training(master_df)
    models = fitted_models(spark, prepared, kinds, cache_key, tune)
    test = prepared.filter(F.col("split") == "test")
    scored = predict(models, test, kinds)
    same = []
    if check:
        from valorem.plans import trees
        scored, same = trees.checked(scored, models), ["same"]
    return scored.select("ID", "Name", "segment", "model", LABEL, "prediction",
                         F.expm1(LABEL).alias("Value_euros"), F.expm1("prediction").alias("Prediction_euros"), *same)


def importances(models: dict, spark: SparkSession) -> DataFrame:
    """(segment, model, rank, feature, importance): tree importances sorted desc,
    linear coefficients sorted by absolute value desc. Bounded by the feature count."""
    rows = []
    for (segment, kind), model in models.items():
        last = model.stages[-1]
        names = S.segment_features(segment)
        if hasattr(last, "featureImportances"):
            vals = last.featureImportances.toArray().tolist()
            order = sorted(zip(names, vals), key=lambda kv: kv[1], reverse=True)
        else:
            vals = last.coefficients.toArray().tolist()
            order = sorted(zip(names, vals), key=lambda kv: abs(kv[1]), reverse=True)
        rows += [(segment, kind, r, f, float(v)) for r, (f, v) in enumerate(order)]
    return spark.createDataFrame(rows, "segment string, model string, rank int, feature string, importance double")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


REPORTED_PARAMS = ("numTrees", "maxDepth", "subsamplingRate", "regParam", "elasticNetParam")


def training_report(models: dict, spark: SparkSession, prepared: DataFrame) -> DataFrame:
    """Per (segment, model): train/test row counts, fit seconds, chosen
    parameters and feature count — the diagnostics a training run logs.

    Row counts come from one grouped pass over the prepared rows; the model
    side has one row per (segment, kind), so it is broadcast by construction.
    """
    meta = []
    for (segment, kind), model in models.items():
        last = model.stages[-1]
        params = {p.name: last.getOrDefault(p) for p in last.params
                  if p.name in REPORTED_PARAMS and (last.isSet(p) or last.hasDefault(p))}
        meta.append((segment, kind, type(last).__name__, int(last.numFeatures),
                     float(getattr(model, "_fit_seconds", float("nan"))),
                     ", ".join(f"{k}={v}" for k, v in sorted(params.items()))))
    meta_df = spark.createDataFrame(
        meta, "segment string, model string, model_class string, num_features int, fit_seconds double, params string")
    sizes = prepared.groupBy("segment").agg(F.count_if(F.col("split") == "train").alias("train_rows"),
                                            F.count_if(F.col("split") == "test").alias("test_rows"))
    return F.broadcast(meta_df).join(sizes, "segment", "left")
