"""A keyed master table in hash buckets; a merge rewrites only the buckets that its batch touches.

Below the table's folder:

* ``data/<batch>/_bucket=K/`` rows of bucket K as one merge left them, never changed afterwards
* ``stats/<batch>/``          n, lo, hi, total, mean and m2 of each statistics column in those buckets
* ``versions/00000001``       the version's buckets and the batch that holds each; the highest number is the content

A version is published by creating its file under a name that must be new, so
of two writers that started from the same version one fails
(``ConcurrentMerge``) and nothing is overwritten; its rows stay unread.

The merge reads the touched buckets alone. The keys of a batch of up to
``SEND_KEYS`` rows are broadcast, so master rows are not shuffled: each task
writes what it read. A larger batch is joined by shuffle. The driver holds one
line per bucket and no rows.

Statistics are mergeable and need no retraction: a rewritten bucket's are
computed from its new rows (an overwritten extreme is gone with them), the
others' are kept, and a version's are those of its buckets put together.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a batch up to which its keys are broadcast.
SEND_KEYS = 200_000
BUCKET = "_bucket"
STATS_SCHEMA = "_bucket int, batch string, column string, n long, lo double, hi double, total double, mean double, m2 double"


class ConcurrentMerge(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Version:
    path: str
    number: int
    key: str
    buckets: int
    stats_columns: list[str]
    schema: T.StructType
    #: bucket -> batch that holds its rows
    holds: dict[int, str]

    def folders(self, only: set[int] | None = None) -> list[str]:
        return [f"{self.path}/data/{batch}/{BUCKET}={k}" for k, batch in sorted(self.holds.items()) if only is None or k in only]


# --- versions ------------------------------------------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    jvm, fs = _file_system(spark, path)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The highest version, or the one of that number; None when the table has none."""
    path = path.rstrip("/")
    number = max(_numbers(spark, path), default=None) if number is None else number
    if number is None:
        return None
    rows = [json.loads(r.value) for r in spark.read.text(f"{path}/versions/{number:08d}").collect()]
    table = next(r for r in rows if "key" in r)
    return Version(path, number, table["key"], table["buckets"], table["stats_columns"],
                   T.StructType.fromJson(table["schema"]), {r["bucket"]: r["batch"] for r in rows if "bucket" in r})


def _publish(spark: SparkSession, version: Version) -> None:
    lines = [{"key": version.key, "buckets": version.buckets, "stats_columns": version.stats_columns, "schema": version.schema.jsonValue()}]
    lines += [{"bucket": k, "batch": batch} for k, batch in sorted(version.holds.items())]
    jvm, fs = _file_system(spark, version.path)
    path = jvm.org.apache.hadoop.fs.Path
    written = path(f"{version.path}/versions/_{uuid.uuid4().hex}")
    target = path(f"{version.path}/versions/{version.number:08d}")
    out = fs.create(written, False)
    out.write(bytearray("\n".join(map(json.dumps, lines)), "utf-8"))
    out.close()
    if fs.getUri().getScheme() == "file":
        # A local rename replaces its target; a link never does.
        try:
            os.link(*[p.toUri().getPath() for p in (written, target)])
            taken = False
        except FileExistsError:
            taken = True
        fs.delete(written, False)
    else:
        taken = fs.exists(target) or not fs.rename(written, target)
    if taken:
        raise ConcurrentMerge(f"version {version.number} of {version.path} is another writer's")


# --- writing -------------------------------------------------------------------------------------------------

def _with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, path: str, batch: str, columns: list[str]) -> None:
    """``rows`` (with their bucket) as files of ``batch``, and the statistics of its buckets."""
    spark = rows.sparkSession
    folder = f"{path}/data/{batch}"
    rows.write.partitionBy(BUCKET).parquet(folder)
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != BUCKET], T.StructField(BUCKET, T.IntegerType())])
    written = spark.read.schema(schema).parquet(folder)

    def of(c: str):
        x = F.col(f"`{c}`").cast("double")
        return F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                        F.sum(x).alias("total"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"))

    if columns:
        stats = (written.groupBy(BUCKET).agg(F.array(*[of(c) for c in columns]).alias("all"))
                 .select(BUCKET, F.lit(batch).alias("batch"), F.inline("all")))
    else:
        stats = spark.createDataFrame([], STATS_SCHEMA)
    stats.write.parquet(f"{path}/stats/{batch}")


def _latest(batch: DataFrame, key: str, seq: str | None) -> DataFrame:
    """One row per key: the highest ``seq``; without one, or among equals, the row's content decides."""
    columns = [c for c in batch.columns if c != seq]
    rank = F.struct(*([F.col(f"`{seq}`")] if seq else []), F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    return batch.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max_by(row, rank).alias("_row")).select("_row.*")


def create(df: DataFrame, path: str, key: str, buckets: int, stats_columns: list[str] = (), seq: str | None = None) -> Version:
    """Version 1 of a table from the rows of ``df`` (one per key stays). A table that is there is a ``ConcurrentMerge``."""
    spark, path = df.sparkSession, path.rstrip("/")
    schema = T.StructType([f for f in df.schema.fields if f.name != seq])
    if BUCKET in (f.name.lower() for f in schema.fields):
        raise ValueError(f"{BUCKET} is the name of the table's own column")
    if _numbers(spark, path):
        raise ConcurrentMerge(f"{path} has versions already")
    batch = uuid.uuid4().hex[:12]
    _write(_with_bucket(_latest(df, key, seq), key, buckets).repartition(BUCKET), path, batch, list(stats_columns))
    held = [r[0] for r in spark.read.schema(STATS_SCHEMA).parquet(f"{path}/stats/{batch}").select(BUCKET).distinct().collect()] \
        if stats_columns else _buckets_of(spark, f"{path}/data/{batch}")
    version = Version(path, 1, key, buckets, list(stats_columns), schema, {k: batch for k in held})
    _publish(spark, version)
    return version


def _buckets_of(spark: SparkSession, folder: str) -> list[int]:
    jvm, fs = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder))]
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]


def merged_rows(spark: SparkSession, base: Version, fresh: DataFrame, touched: set[int], send_keys: int = SEND_KEYS) -> DataFrame:
    """The touched buckets after the merge: their rows whose key ``fresh`` lacks, and ``fresh`` (one row per key, with bucket)."""
    keys = fresh.select(F.col(f"`{base.key}`").alias("_new_key"))
    if keys.limit(send_keys + 1).count() <= send_keys:
        keys = F.broadcast(keys)
    old = _with_bucket(_read(spark, base, touched), base.key, base.buckets)
    kept = old.join(keys, old[f"`{base.key}`"].eqNullSafe(keys["_new_key"]), "left_anti")
    return kept.unionByName(fresh.repartition(BUCKET))


def merge(batch: DataFrame, path: str, seq: str | None = None, base: Version | None = None, compact: bool = False,
          send_keys: int = SEND_KEYS) -> Version:
    """The next version: rows of ``batch`` replace those of their key; among the batch's own the highest ``seq`` wins.

    Columns that the batch lacks are null in its rows; columns that the table
    lacks are an error. ``compact`` gathers each touched bucket in one file (a
    shuffle of the touched buckets), which keeps the files few after many small batches.
    """
    spark = batch.sparkSession
    base = base or current(spark, path)
    if base is None:
        raise FileNotFoundError(path)
    unknown = [c for c in batch.columns if c != seq and c not in base.schema.names]
    if unknown or base.key not in batch.columns:
        raise ValueError(f"columns {unknown} are not the table's" if unknown else f"no key {base.key}")
    aligned = batch.select(*[(F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in base.schema],
                           *([F.col(f"`{seq}`")] if seq else []))
    name = uuid.uuid4().hex[:12]
    # Written once: which buckets it touches, its size and the merge read the same rows.
    incoming = f"{base.path}/incoming/{name}"
    _with_bucket(_latest(aligned, base.key, seq), base.key, base.buckets).write.parquet(incoming)
    fresh = spark.read.schema(T.StructType([*base.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(incoming)
    touched = {r[0] for r in fresh.select(BUCKET).distinct().collect()}
    holds = dict(base.holds)
    if touched:
        rows = merged_rows(spark, base, fresh, touched, send_keys)
        _write(rows.repartition(BUCKET) if compact else rows, base.path, name, base.stats_columns)
        holds |= {k: name for k in touched}
    version = Version(base.path, base.number + 1, base.key, base.buckets, base.stats_columns, base.schema, holds)
    _publish(spark, version)
    return version


# --- reading -------------------------------------------------------------------------------------------------

def _read(spark: SparkSession, version: Version, only: set[int] | None = None) -> DataFrame:
    folders = version.folders(only)
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).option("recursiveFileLookup", True).parquet(*folders)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Rows of the current version, or of an earlier one by its number."""
    version = current(spark, path, number)
    if version is None:
        raise FileNotFoundError(path)
    return _read(spark, version)


def stats(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """column, n, lo, hi, total, mean, stddev (of the sample) of a version, from its buckets' statistics: no row is read."""
    version = current(spark, path, number)
    if version is None:
        raise FileNotFoundError(path)
    live = spark.createDataFrame(list(version.holds.items()), f"{BUCKET} int, batch string")
    folders = [f"{version.path}/stats/{batch}" for batch in sorted(set(version.holds.values()))]
    rows = spark.read.schema(STATS_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], STATS_SCHEMA)
    rows = rows.join(F.broadcast(live), [BUCKET, "batch"])  # as many rows as buckets
    whole = rows.groupBy("column").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"))
    whole = whole.withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n")))
    spread = (rows.select("column", F.col("n").alias("k"), F.col("mean").alias("own"), "m2").join(whole, "column")
              .groupBy("column").agg(F.sum(F.expr("m2 + k * (own - mean) * (own - mean)")).alias("m2")))
    return whole.join(spread, "column").select(
        "column", "n", "lo", "hi", "total", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"))


def rescale_bounds(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The table's bounds as ``profile.rescale_1_99`` takes them (``stats=``): a batch is scaled without a pass over the master."""
    of = stats(spark, path)
    return of.agg(*[F.max(F.when(F.col("column") == c, F.col(x))).alias(f"{x}{i}") for i, c in enumerate(columns) for x in ("lo", "hi")])
