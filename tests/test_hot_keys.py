"""Hot keys are found by share, only their rows are copied, and the join's rows are those of a plain join."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from valorem.operators import report, skew

PARTITIONS = 211


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows under one name, a sixth without any, the rest under 5,000 names."""
    name = F.expr("case when id % 6 < 2 then 'crowd' when id % 6 = 2 then null else concat('n', id % 5000) end")
    return spark.range(60_000).select(F.col("id").alias("ID"), name.alias("Name"), (F.col("id") % 97).alias("salts")).repartition(7).cache()


def test_shares(spark, crowd):
    hot = {r.hot_key: r.salts for r in skew.hot_keys(crowd, "Name", PARTITIONS).collect()}
    assert abs(hot.pop("crowd") - PARTITIONS / 3 / 0.25) < 10 and not hot
    assert skew.hot_keys(crowd.filter("false"), "Name", PARTITIONS).collect() == []
    assert skew.hot_keys(crowd.filter("Name is null"), "Name", PARTITIONS).collect() == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_are_those_of_a_plain_join(spark, crowd, how):
    right = spark.createDataFrame([("crowd", 1.0), ("crowd", 2.0), ("n7", 3.0), ("other", 4.0), (None, 5.0)], "Name string, p double")
    left = crowd.withColumnRenamed("salts", "_Salt")
    hot = skew.hot_keys(left, "Name", PARTITIONS)
    got = skew.spread_join(left, right, "Name", hot, "ID", how)
    want = left.join(right, "Name", how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        skew.spread_join(left, right, "Name", hot, "ID", "outer")


def test_no_partition_holds_the_crowd_and_cold_rows_are_not_copied(spark, crowd):
    names = crowd.select("Name").distinct().filter("Name is not null").withColumn("p", F.lit(1.0))
    left = crowd.drop("salts")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(PARTITIONS)}
    before = {k: spark.conf.get(k) for k in settings}
    hot = skew.hot_keys(left, "Name", PARTITIONS)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = skew.spread_join(left, names, "Name", hot, "ID")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60_000 and max(sizes) < 60_000 / 20
    copies = names.join(F.broadcast(hot), names.Name == hot.hot_key, "left").select(F.sum(F.coalesce("salts", F.lit(1)))).first()[0]
    assert copies < names.count() + 300


def test_predictions_of_a_crowd(spark, crowd):
    left = crowd.selectExpr("ID", "Name", "1.5D as Value")
    sets = [spark.createDataFrame([("crowd", 9.0, 1), ("crowd", 8.0, 2), ("n9", 7.0, 1)], "Name string, Prediction_euros double, order int")]
    plain = report.attach_predictions(left, sets)
    spread = report.attach_predictions(left, sets, spread=PARTITIONS)
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.select(*spread.columns).collect()))
