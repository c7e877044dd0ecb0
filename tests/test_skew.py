"""One key holding a third of all rows: results stay exact and the work
stays spread."""

from pyspark.sql import functions as F

from valorem.operators import report, upsert

N = 30_000


def _hot(spark):
    # a third of the rows share user 7, the rest are spread over 1,000 users
    return spark.range(N).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 100).alias("user_id"),
        (F.col("id") % 97).cast("double").alias("value"))


def test_keep_last_and_top_distinct_with_a_hot_key(spark):
    df = _hot(spark).select(F.col("user_id").cast("string").alias("ID"), F.col("event_id").alias("seq"),
                            F.col("value").alias("Value"))
    merged = upsert.keep_last(df.limit(0), df, "ID", seq="seq")
    got = {r.ID: r.Value for r in merged.collect()}
    expect = {r.ID: r.Value for r in df.groupBy("ID").agg(F.max_by("Value", "seq").alias("Value")).collect()}
    assert got == expect
    top = report.top_distinct(df.withColumn("Name", F.col("ID")), "Name", "Value", 5, ["Name", "Value"]).collect()
    assert len(top) == 5 and len({r.Name for r in top}) == 5


def test_salted_prediction_join_spreads_a_hot_name(spark):
    base = spark.range(N).select(F.col("id").cast("string").alias("ID"),
                                 F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("Name"),
                                 F.col("id").cast("double").alias("Value"))
    preds = spark.createDataFrame([("hot", 1.0, "a"), ("n1", 2.0, "a"), ("n4", 3.0, "a")],
                                  "Name string, Prediction_euros double, order string")
    plain = report.attach_predictions(base, [preds])
    salted = report.attach_predictions(base, [preds], salt=16)
    assert sorted(salted.collect()) == sorted(plain.collect())
    # the hot name's rows are spread over every salt value
    spread = base.filter(F.col("Name") == "hot").select(F.pmod(F.xxhash64("ID"), F.lit(16)).alias("s")).distinct().count()
    assert spread == 16


def test_pruned_top_distinct_equals_unpruned(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        name = "hot" if i % 3 == 0 else f"n{rnd.randint(0, 400)}"
        v = None if i % 97 == 0 else float(rnd.randint(0, 2000))
        rows.append((str(i), name, float(i % 50), v))
    df = spark.createDataFrame(rows, "ID string, Name string, Age double, Value double")
    for k in (1, 5, 10, 100, 500):
        a = report.top_distinct(df, "Name", "Value", k, ["Name", "Age", "Value"], prune=True).collect()
        b = report.top_distinct(df, "Name", "Value", k, ["Name", "Age", "Value"], prune=False).collect()
        assert a == b, k
