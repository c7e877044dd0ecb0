"""CSV master files and report sinks.

Reading applies the fixed schema *by header name*: every column is read as
text, then selected by name and ``try_cast`` to its type, so a file written
in another column order (the scraper's) loads correctly and a bad number is a
null instead of a failed job. Unknown extra columns are ignored; a missing
expected column becomes null.

Files are split between tasks. A line whose quote marks are of even number, in
a file that has only such lines, is a record: Spark's reader takes these files
line by line. Where some line has an odd number, a field holds a line break;
then the sum of the marks before each block, and before each line of a block,
says whether the line begins a record (``split_records``).
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from valorem import schema as S

#: Fixed on both sides: quotes are doubled, a quoted field may hold line breaks, and an empty text
#: (written as "") differs from a null (written as nothing). Blanks at either end of a field stay.
CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": True, "emptyValue": '""', "nullValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_by_name(spark: SparkSession, path: str, schema: T.StructType = S.MASTER_SCHEMA,
                 require_rows: bool = True) -> DataFrame:
    """Every file is read by its own header, so files of a folder may order their columns differently."""
    try:
        lines = _lines(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    # One line per file: its first line, and whether a field holds a line break.
    kinds = (lines.groupBy("_file").agg(F.min_by("value", "_at").alias("header"), F.max("odd").alias("odd"))
             .groupBy("header", "odd").agg(F.collect_list("_file").alias("files")).collect())
    plain = [_read_plain(spark, row.files, schema) for row in kinds if not row.odd]
    broken = [f for row in kinds if row.odd for f in row.files]
    parts = plain + (_read_records(split_records(spark, broken), schema) if broken else [])
    df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    if require_rows and df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """value, _file, _block (where the task's part of the file begins), _at (order of the lines in a file's
    part), odd (1: an odd number of quote marks)."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    # An input path with spaces or other marks is encoded in _metadata.
    return raw.select("value", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"),
                      ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd"))


def split_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """_file, _block, _at, record: the records of CSV files whose quoted fields may hold line breaks.

    Quotes are doubled inside a field, so a line begins a record when the
    number of marks before it is even. It is summed over the blocks of a file
    (one row per block) and then over the lines of each block, which is what
    one task reads; a record that goes on in the next blocks is put together
    from its lines. Lines end with LF or CRLF, and those inside a field are
    kept. Empty records are left out. _block and _at are those of the first line.
    """
    lines = _lines(spark, paths)
    of_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    of_block = Window.partitionBy("_file", "_block").orderBy("_at")
    blocks = (lines.groupBy("_file", "_block").agg(F.sum("odd").alias("odd"))
              .select("_file", "_block", F.coalesce(F.sum("odd").over(of_file), F.lit(0)).alias("before")))
    inside = F.col("before") + F.sum("odd").over(of_block) - F.col("odd")
    begun = (lines.join(blocks, ["_file", "_block"])
             .withColumn("own", F.when(inside % 2 == 0, F.struct("_block", "_at")))
             .withColumn("first", F.max("own").over(of_block)))
    # Lines before a block's first record go on with the last one that began in an earlier block.
    earlier = (begun.groupBy("_file", "_block").agg(F.max("own").alias("last"))
               .select("_file", "_block", F.max("last").over(of_file).alias("earlier")))
    whole = (begun.join(earlier, ["_file", "_block"]).withColumn("first", F.coalesce("first", "earlier"))
             .groupBy("_file", "first").agg(F.array_sort(F.collect_list(F.struct("_block", "_at", "value"))).alias("all")))
    record = F.regexp_replace(F.array_join(F.transform("all", lambda line: line["value"]), "\n"), "\r$", "")
    return whole.select("_file", "first.*", record.alias("record")).filter(F.col("record") != "")


def _read_records(records: DataFrame, schema: T.StructType) -> list[DataFrame]:
    """One frame for each header of the files; a file's first record is its header."""
    heads = records.groupBy("_file").agg(F.min_by("record", F.struct("_block", "_at")).alias("header"),
                                         F.min(F.struct("_block", "_at")).alias("_head"))
    rows = records.join(heads, "_file").filter(F.struct("_block", "_at") != F.col("_head"))
    parts = []
    for (header,) in heads.select("header").distinct().collect():
        names = next(csv.reader(header.lstrip("\ufeff").splitlines(True)))
        at = {name: f"_c{i}" for i, name in reversed(list(enumerate(names)))}
        row = F.from_csv("record", ", ".join(f"_c{i} string" for i in range(len(names))),
                         {k: str(v) for k, v in CSV_OPTIONS.items() if k != "multiLine"})
        own = rows.filter(F.col("header") == header).select(row.alias("row"))
        parts.append(own.select(*[(F.col(f"row.{at[f.name]}") if f.name in at else F.lit(None).cast("string"))
                                  .try_cast(f.dataType).alias(f.name) for f in schema.fields]))
    return parts


def _read_plain(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Files of one header, every line a record."""
    raw = spark.read.options(**CSV_OPTIONS | {"multiLine": False}).option("header", True).option("inferSchema", False).csv(files)
    cols = []
    for f in schema.fields:
        src = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string")
        cols.append(src.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (report inputs, copies)."""
    return spark.read.options(**CSV_OPTIONS).csv(path, header=True, inferSchema=True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with header. ``single_file`` merges to one part — only for small report exports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_OPTIONS).option("header", True).csv(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write only when nothing exists at ``path`` yet."""
    df.write.mode("ignore").format(fmt).save(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def copy_csv(spark: SparkSession, src: str, dst: str) -> None:
    """Re-read a CSV and copy it, keeping the header."""
    write_csv(read_inferred(spark, src), dst)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Full rewrite of a versioned table that may be the input of ``df``.

    A table at ``path`` has its rows in ``version-N`` folders and the numbers
    of the complete ones in ``versions``; the highest is its content. The
    number is added after the rows are written, so readers see the old rows
    until the new ones are all there. Returns the version's path.
    """
    root, spark = path.rstrip("/"), df.sparkSession
    number = max(_versions(spark, root), default=0) + 1
    target = f"{root}/version-{number}"
    df.write.mode("overwrite").format(fmt).save(target)
    spark.range(number, number + 1, 1, 1).select(F.col("id").alias("version")).write.mode("append").parquet(f"{root}/versions")
    return target


def _versions(spark: SparkSession, root: str) -> list[int]:
    try:
        return [r[0] for r in spark.read.parquet(f"{root}/versions").agg(F.max("version")).collect() if r[0] is not None]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def current(spark: SparkSession, path: str) -> str | None:
    """Path of the current version of a table written by ``replace``; None when there is none."""
    numbers = _versions(spark, path.rstrip("/"))
    return f"{path.rstrip('/')}/version-{max(numbers)}" if numbers else None


def write_importance_report(importances: DataFrame, path: str) -> None:
    """Plain-text ``feature: importance`` lines in rank order, one folder per
    (model, segment) — the text form of ``train.importances``."""
    lines = importances.select("model", "segment", "rank",
                               F.concat_ws(": ", F.col("feature"), F.col("importance").cast("string")).alias("value"))
    (lines.repartition("model", "segment").sortWithinPartitions("rank").drop("rank")
          .write.mode("overwrite").partitionBy("model", "segment").text(path))
