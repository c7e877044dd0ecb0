"""Helpers shared by the operators: reading, writing intermediate tables, text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that drops the files of a statement's shuffles when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs only the tasks it ran, and the
    stages after it read the files instead of the texts. ``drop_shuffles``:
    what the write shuffled leaves the disk with its end; for frames that
    nothing reads again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not drop_shuffles:
        df.write.parquet(path)
    else:
        before = spark.conf.get(SHUFFLE_CLEANUP, None)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few longs each (3.2 MB or so) that a task writes, where a table has as many.
TASK_ROWS = 100_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` narrow rows at most, in no more partitions than they call for.

    For tables of keys that may be far smaller than what they came from: dealt
    over all shuffle partitions, each would write a file of a few rows, and
    without Hadoop's native library a local file system begins processes of its
    own for every file (chmod). The rows are dealt anew, as joins brought
    together by coalesce would hold their memory in one task; a table that
    fills the shuffle's partitions stays as it is.
    """
    parts = max(1, -(-rows // TASK_ROWS))
    return df.repartition(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def small_batches(batches, rows: int = 1000):
    """Arrow batches of fewer rows: as Python objects, texts take several times the room."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty string.

    ``lower`` is right (and much faster) where a text has no byte above 0x7F;
    other texts take ``translate``, which leaves É and the like alone.
    """
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, UPPER, UPPER.lower()))


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id written in decimal: the fold of a document."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))


def text_pieces(text: bytes, size: int = 1 << 20):
    """A text in pieces of about ``size`` bytes, cut at ASCII white space so that no word is split."""
    start, end = 0, size
    while end < len(text):
        space = SPACE.search(text, end)
        if space is None:
            break
        yield text[start:space.start()]
        start, end = space.start(), space.start() + size
    yield text[start:]


#: Rows (two longs each, 3.2 MB) up to which a list of document keys is broadcast; a longer list is joined by shuffle.
SEND_KEYS = 200_000


def with_body(docs: DataFrame) -> DataFrame:
    """``body``: a hash of the text that, with doc_id, names a row; rows equal in both are one document."""
    return docs.withColumn("body", F.xxhash64("text"))


def without(docs: DataFrame, gone: DataFrame, send: int = SEND_KEYS) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, body) is not in ``gone``, which must be a stored table."""
    own = docs.withColumn("_body", F.xxhash64("text"))
    keys = gone.select(F.col("doc_id").alias("_gone_id"), F.col("body").alias("_gone_body")).distinct()
    if keys.limit(send + 1).count() <= send:
        keys = F.broadcast(keys)
    same = own.doc_id.cast("long").eqNullSafe(keys._gone_id) & (own._body == keys._gone_body)
    return own.join(keys, same, "left_anti").select(*docs.columns)
