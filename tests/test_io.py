"""Sinks and file sources: inferred read over a directory, ignore / append /
replace writes, single-file export, header-keeping copy, schema listing."""

import glob
import os

from valorem import schema as S
from valorem.sources import csv_io
from valorem.sources.tables import master

from conftest import SF_SMALL


def test_sinks_and_copies(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "k int, s string, v double")
    d = str(tmp_path)
    csv_io.write_csv(df, f"{d}/one", single_file=True)
    assert len(glob.glob(f"{d}/one/part-*.csv")) == 1
    back = csv_io.read_inferred(spark, f"{d}/one")          # reads every part of the directory
    assert sorted(back.collect()) == sorted(df.collect()) and back.dtypes == df.dtypes
    csv_io.copy_csv(spark, f"{d}/one", f"{d}/copy")
    first = open(glob.glob(f"{d}/copy/part-*.csv")[0]).readline().strip()
    assert first == "k,s,v"                                  # header kept on copy
    csv_io.write_if_absent(df, f"{d}/t")
    csv_io.write_if_absent(df.limit(1), f"{d}/t")            # ignored: target exists
    assert spark.read.parquet(f"{d}/t").count() == 2
    csv_io.append(df, f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 4
    newer = csv_io.replace(spark.read.parquet(f"{d}/t").limit(3), f"{d}/t")
    assert newer != f"{d}/t" and spark.read.parquet(newer).count() == 3 and os.path.exists(f"{d}/t")


def test_master_schema_listing(spark):
    m = master(spark, SF_SMALL)
    assert [(f.name, f.dataType) for f in m.schema.fields] == [(f.name, f.dataType) for f in S.MASTER_SCHEMA.fields]
    assert [f.name for f in m.schema.fields] == S.MASTER_COLUMNS


def test_a_message_is_parsed_once(spark):
    """Filters on a message's fields repeated its parsing, 18 times in feed_score."""
    from pyspark.sql import functions as F
    from valorem.sources import feed
    rows = spark.createDataFrame([("1", '{"Name":"a","ID":"1","Value":2.0,"Wage":1.0}'), ("2", "junk"), ("3", None)], "key string, value string")
    got = feed.decode(rows, keep=["key"])
    assert [(r.key, r.Name, r.Value) for r in got.orderBy("key").collect()] == [("1", "a", 2.0), ("2", None, None), ("3", None, None)]
    kept = got.filter((F.col("Value") > 1) & (F.col("Wage") > 0) & F.col("Name").isNotNull())
    assert kept.count() == 1
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
