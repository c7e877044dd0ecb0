"""Training, scoring, model round trip, streaming = batch, replay safety."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import metrics, prepare, segments
from valorem.plans import score, train
from valorem.session import scratch_path
from valorem.sources import feed
from valorem.sources.tables import master
from valorem.streaming import listener

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    prepared = train.prepare_training(master(spark, SF_SMALL)).cache()
    m = train.fitted_models(spark, prepared, S.MODEL_KINDS, tune=False)
    return prepared, m


def test_rmse_matches_evaluator_and_importances(spark, models):
    prepared, m = models
    test = prepared.filter(F.col("split") == "test")
    scored = train.predict(m, test, ["forest"])
    ours = {r.segment: r.rmse for r in metrics.rmse(scored, ["segment"], digits=12).collect()}
    for seg in S.SEGMENTS:
        ev = RegressionEvaluator(labelCol="Value_log", metricName="rmse").evaluate(scored.filter(F.col("segment") == seg))
        assert abs(ours[seg] - ev) < 1e-9
    imp = train.importances(m, spark).toPandas()
    forest = imp[imp.model == "forest"]
    for seg, feats in S.SEGMENTS.items():
        part = forest[forest.segment == seg]
        assert sorted(part.feature) == sorted(feats)
        assert abs(part.importance.sum() - 1.0) < 1e-9
        assert list(part.importance) == sorted(part.importance, reverse=True)


def test_model_round_trip(spark, models):
    prepared, m = models
    path = scratch_path(spark, "model")
    train.save(m[("field", "forest")], path)
    loaded = train.load(path)
    rows = prepared.filter(F.col("segment") == "field")
    a = m[("field", "forest")].transform(rows).select("ID", "prediction").collect()
    b = loaded.transform(rows).select("ID", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_hash_split_disjoint_complete(spark):
    df = segments.with_split(master(spark, SF_SMALL))
    n = df.count()
    c = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert c["train"] + c["test"] == n and 0.7 < c["train"] / n < 0.9


def test_score_and_whatif(spark, models):
    _, m = models
    df = master(spark, SF_SMALL)
    s = score.score_table(m, df, S.MODEL_KINDS)
    n_seg = segments.with_segments(df).filter(F.col("segment").isNotNull()).count()
    assert s.count() == n_seg * len(S.MODEL_KINDS)
    assert s.filter(F.col("Prediction_euros").isNull()).count() == 0
    req = segments.with_segments(df).withColumn("is_goalkeeper", F.coalesce(F.col("segment") == "goalkeeper", F.lit(False)))
    w = score.whatif(m, req).collect()
    assert len(w) == df.count()
    assert all((r.predicted_value is None) == (not r.valid) for r in w)


def test_stream_equals_batch_and_replay(spark, models):
    _, m = models
    df = master(spark, SF_SMALL)
    env = feed.publish(df, key="ID", columns=S.MESSAGE_COLUMNS)
    root = scratch_path(spark, "stream-test")
    feed.write_envelope(env, f"{root}/topic", files=4)
    bad = spark.createDataFrame([("x", "{broken", "entities", 0, 999, None)], S.ENVELOPE_SCHEMA)
    bad.write.mode("append").json(f"{root}/topic")

    def run():
        q = listener.start(listener.file_stream(spark, f"{root}/topic", max_files_per_trigger=2), m, ["forest"],
                           f"{root}/out", f"{root}/rejects", f"{root}/ckpt", available_now=True)
        q.awaitTermination()

    run()
    out = spark.read.parquet(f"{root}/out")
    batch = score.score_table(m, df, ["forest"], route_unknown_to_field=True)
    a = sorted((r.key, round(r.Prediction_euros, 6)) for r in out.select("key", "Prediction_euros").collect())
    b = sorted((r.ID, round(r.Prediction_euros, 6)) for r in batch.select("ID", "Prediction_euros").collect())
    assert a == b
    assert spark.read.parquet(f"{root}/rejects").count() == 1
    # same checkpoint again: nothing new to process, output unchanged
    run()
    assert spark.read.parquet(f"{root}/out").count() == len(a)


def test_feed_trim_all(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 1000]], "Value double")
    got = prepare.trim_all(prepare.cap_log(df, cap=None), k=1.0).count()
    assert got == 3


def test_replayed_batch_replaces_itself(spark, models):
    """A micro-batch re-run under the same batch id (recovery after a failure
    between writing and committing) overwrites its own partition."""
    _, m = models
    df = master(spark, SF_SMALL)
    env = feed.publish(df, key="ID", columns=S.MESSAGE_COLUMNS)
    batch = listener.decoded(env)
    root = scratch_path(spark, "replay")
    run = listener.batch_scorer(m, ["forest", "linear"], f"{root}/out", f"{root}/rej")
    run(batch, 7)
    n1 = spark.read.parquet(f"{root}/out").count()
    run(batch, 7)
    assert spark.read.parquet(f"{root}/out").count() == n1
    run(batch.limit(5), 8)
    assert spark.read.parquet(f"{root}/out").count() == n1 + 5 * 2


def test_band_fitted_on_train_by_default_and_on_all_rows_in_parity(spark):
    from valorem.operators import prepare as P
    m = master(spark, SF_SMALL)
    tagged = P.cap_log(segments.with_split(segments.with_segments(m)).filter(F.col("segment").isNotNull()), S.VALUE_CAP)
    band_train = {r.segment: (r.band_lo, r.band_hi) for r in P.fit_band(tagged.filter(F.col("split") == "train")).collect()}
    band_all = {r.segment: (r.band_lo, r.band_hi) for r in P.fit_band(tagged).collect()}

    def inside(rows, band):
        return sum(1 for r in rows if band[r.segment][0] <= r.Value_log <= band[r.segment][1])

    rows = tagged.select("segment", "Value_log").collect()
    assert train.prepare_training(m).count() == inside(rows, band_train)
    assert train.prepare_training(m, parity=True).count() == inside(rows, band_all)


def test_forest_refit_is_reproducible(spark, models):
    prepared, _ = models
    rows = train.stable_layout(prepared.filter((F.col("split") == "train") & (F.col("segment") == "field")))
    a = train.fit(rows, "field", "forest", tune=False).transform(rows).select("ID", "prediction").collect()
    # a different upstream partitioning gives the same layout, hence the same forest
    rows2 = train.stable_layout(prepared.repartition(3).filter((F.col("split") == "train") & (F.col("segment") == "field")))
    b = train.fit(rows2, "field", "forest", tune=False).transform(rows2).select("ID", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_batch_scorer_csv_output(spark, models):
    _, m = models
    env = feed.publish(master(spark, SF_SMALL).limit(20), key="ID", columns=S.MESSAGE_COLUMNS)
    root = scratch_path(spark, "csv-out")
    listener.batch_scorer(m, ["forest"], f"{root}/out", f"{root}/rej", fmt="csv")(listener.decoded(env), 0)
    back = spark.read.option("header", True).csv(f"{root}/out")
    assert back.count() == 20 and "Prediction_euros" in back.columns and "model_type" in back.columns


def test_scoring_flags_against_the_training_band(spark, models):
    _, m = models
    df = master(spark, SF_SMALL)
    seg, band = train.training_band(df)
    s = score.score_table(m, df, ["forest"], band=band)
    flagged = {r.ID for r in s.filter("is_outlier").collect()}
    kept = {r.ID for r in train.prepare_training(df).collect()}
    in_seg = {r.ID for r in seg.collect()}
    # exactly the segment rows the training band trims are flagged, none dropped
    assert flagged == in_seg - kept
    assert s.count() == len(in_seg)


def test_features_null_and_zero_variance(spark):
    """A row with a null feature does not train; it comes out of scoring with a null
    prediction and the feature's name. A constant feature scales to 0 and does not break the fit."""
    rows = [(str(i), float(i % 7) + 1.0, 50.0, float(i), 10.0 + i, 1.0) for i in range(40)]
    rows.append(("null", None, 50.0, 1.0, 2.0, 1.0))
    cols = ["ID", "Age", "Overall rating", "Potential", "Wage", "Value_log"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" if c != "ID" else "ID string" for c in cols))
    for f in dict.fromkeys(S.FIELD_FEATURES + S.GOALKEEPER_FEATURES):
        if f not in df.columns:
            df = df.withColumn(f, F.lit(3.0))          # zero-variance features
    model = train.fit(df, "field", "linear", tune=False)
    out = {r.ID: r for r in train.predict({("field", "linear"): model}, df.withColumn("segment", F.lit("field")), ["linear"]).collect()}
    assert len(out) == 41 and out["null"].prediction is None and out["null"].missing_features == ["Age"]
    assert all(r.prediction is not None and r.missing_features == [] for i, r in out.items() if i != "null")
    scaler = model.stages[1]
    const_slots = [i for i, f in enumerate(S.FIELD_FEATURES) if f not in cols]
    assert all(scaler.std[i] == 0.0 for i in const_slots)


def test_importance_text_report(spark, models):
    from valorem.sources import csv_io
    _, m = models
    path = scratch_path(spark, "importance-report")
    csv_io.write_importance_report(train.importances(m, spark), path)
    lines = spark.read.text(f"{path}/model=forest/segment=field").collect()
    feats = [ln.value.split(": ")[0] for ln in lines]
    assert sorted(feats) == sorted(S.FIELD_FEATURES)
    vals = [float(ln.value.split(": ")[1]) for ln in lines]
    assert vals == sorted(vals, reverse=True)


def test_unbounded_stream_with_processing_time_trigger(spark, models):
    """The listener as an unbounded query: files arriving while it runs are scored."""
    _, m = models
    df = master(spark, SF_SMALL)
    env = feed.publish(df, key="ID", columns=S.MESSAGE_COLUMNS)
    root = scratch_path(spark, "unbounded")
    feed.write_envelope(env.limit(30), f"{root}/topic/a")
    q = listener.start(spark.readStream.schema(S.ENVELOPE_SCHEMA).option("recursiveFileLookup", True)
                       .json(f"{root}/topic"), m, ["forest"], f"{root}/out", f"{root}/rej", f"{root}/ckpt",
                       interval="1 second")
    try:
        q.processAllAvailable()
        feed.write_envelope(env.subtract(env.limit(30)).limit(20), f"{root}/topic/b")
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{root}/out").count() == 50
