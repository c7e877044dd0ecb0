"""CSV files between several tasks: quoted line breaks over the borders of blocks, doubled quotes, own headers."""

import random

import pytest
from pyspark.sql import types as T

from valorem.sources import csv_io

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("v", T.DoubleType())])


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def field(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text


def written(path, rows, header="k,t,v", end="\n"):
    path.write_bytes((header + end + "".join(f"{k},{field(t)},{v}{end}" for k, t, v in rows)).encode())
    return rows


def texts(n, seed):
    rng = random.Random(seed)
    pieces = ["plain", "two words", 'say "so"', "line\nbreak", "\n\n", 'end"\n"', "é中", "a,b", "\r\nwin", '""']
    rows = [(i, "x" + "".join(rng.choices(pieces, k=rng.randint(1, 4))) + "x", i / 4) for i in range(n)]
    rows[n // 2] = (n // 2, "long\n" * 3000, 1.5)  # a record over several blocks
    return rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_read_equals_the_written_rows(spark, tmp_path, small_blocks, end):
    rows = written(tmp_path / "a.csv", texts(2000, 1), end=end)
    assert csv_io._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
    assert sorted(map(tuple, csv_io.read_by_name(spark, str(tmp_path), SCHEMA).collect())) == sorted(rows)


def test_split_read_equals_the_single_task_reader(spark, tmp_path, small_blocks):
    written(tmp_path / "a.csv", texts(1500, 2))
    whole = spark.read.options(**csv_io.CSV_OPTIONS).csv(str(tmp_path), header=True, schema=SCHEMA)
    assert whole.rdd.getNumPartitions() == 1
    assert sorted(csv_io.read_by_name(spark, str(tmp_path), SCHEMA).collect()) == sorted(whole.collect())


def test_files_with_other_headers_and_kinds(spark, tmp_path, small_blocks):
    a = written(tmp_path / "a.csv", texts(300, 3))
    b = [(i, f"t{i}", 0.5) for i in range(5000, 5400)]
    (tmp_path / "b file.csv").write_text("v,extra,k,t\n" + "".join(f"{v},z,{k},{t}\n" for k, t, v in b))
    (tmp_path / "c.csv").write_text('t,"odd\nname",k\n"one\ntwo",q,9000\n\nthree,"",x\n')
    got = {tuple(r) for r in csv_io.read_by_name(spark, str(tmp_path), SCHEMA).collect()}
    assert got == {*a, *b, (9000, "one\ntwo", None), (None, "three", None)}


def test_plain_lines_need_no_shuffle(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("k,t,v\n" + "".join(f'{i},"a ""b""",{i}\n' for i in range(3000)))
    df = csv_io.read_by_name(spark, str(tmp_path), SCHEMA)
    assert df.rdd.getNumPartitions() > 5
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 3000 and df.first()["t"] == 'a "b"'


def test_only_a_header_is_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,t,v\n")
    with pytest.raises(ValueError):
        csv_io.read_by_name(spark, str(tmp_path), SCHEMA)
    assert csv_io.read_by_name(spark, str(tmp_path), SCHEMA, require_rows=False).count() == 0
