"""Partitions of the training frame follow from its rows, not from the session."""

from pyspark.sql import functions as F

from valorem.plans import train


def test_layout_grows_with_the_rows(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("string").alias("ID"), (F.col("id") % 7).alias("x"))
    assert train.stable_layout(df).rdd.getNumPartitions() == train.LAYOUT_PARTITIONS
    monkeypatch.setattr(train, "LAYOUT_ROWS", 90)
    wide = train.stable_layout(df)
    assert wide.rdd.getNumPartitions() == 12
    again = train.stable_layout(df.repartition(5))
    assert [r.ID for r in again.collect()] == [r.ID for r in wide.collect()]
    assert train.stable_layout(df, 3).rdd.getNumPartitions() == 3
    # a repeated ID doesn't pile up
    same = spark.range(2000).select(F.lit("7").alias("ID"), F.col("id").alias("x"))
    sizes = [n for (n,) in train.stable_layout(same).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 400


def test_fewer_fits_at_once_over_more_rows():
    """All fits used to run at once whatever the rows, 32 of them."""
    assert train.fits_at_once(0, 8, 4) == (8, 4) and train.fits_at_once(100_000, 8, 4) == (8, 4)
    for rows in (1, 10_000, 600_000, 2_700_000, 5_000_000, 10**9):
        jobs, inner = train.fits_at_once(rows, 8, 4)
        assert jobs >= 1 and inner >= 1 and (jobs * inner == 1 or jobs * inner * rows <= train.ROWS_AT_ONCE)
    assert train.fits_at_once(2_700_000, 8, 4) == (1, 2)
