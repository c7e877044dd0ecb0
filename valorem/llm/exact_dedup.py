"""Exact deduplication through an extendible-hash index on shared files.

The key of a text is its XXH64. Buckets are ranges of the key space named by
a directory: while a bucket holds more distinct keys than ``capacity`` the
directory doubles and the bucket splits in two (one more leading key bit).
Every bucket has an owner: texts meet there by (bucket, key) and are compared
byte for byte, so two texts with one key become two links of that key's
collision chain. The index, one row per distinct text, is written to the
shared folder in key ranges; documents then look their link up by key.

Only DataFrame functions are used. Equal texts collapse before the shuffle
(partial aggregation), so a text held by a third of the rows travels once per
task, and the lookup join carries ids and keys only, which Spark splits when a
key is skewed.

Defined results: null text is the empty text. Rows that repeat one doc_id with
one text are the same document: they are kept or dropped together. A group
whose ids are all null has a null ``keep_id`` and is kept. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valorem.llm.common import ascii_lower, stored, table

#: Distinct keys that a bucket holds before it splits.
CAPACITY = 4096
#: Doublings at most: 65,536 slots, so the directory is at most about 1 MB and can be broadcast.
MAX_DEPTH = 16


def keyed(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """doc_id, normalised text and its key. ``key_bits`` below 64 weakens the key (tests of collision chains)."""
    key = F.xxhash64("norm")
    if key_bits < 64:
        key = F.shiftleft(key, 64 - key_bits)
    return docs.select("doc_id", ascii_lower(F.col("text")).alias("norm")).withColumn("key", key)


def slot(depth: int):
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth)


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """slot (of ``max_depth`` bits), local_depth, bucket (first slot of the bucket's range).

    A bucket of depth d is overfull when its range holds more than
    ``capacity`` distinct keys, and all the ranges around it are then overfull
    too. One split per overfull range on the path of a slot therefore gives
    the depth at which repeated doubling stops.
    """
    filled = keys.select("key").distinct().groupBy(slot(max_depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    paths = filled.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth - 1))).alias("depth")).withColumn(
        "range", F.expr(f"shiftrightunsigned(slot, {max_depth} - depth)"))
    overfull = (paths.groupBy("depth", "range").agg(F.sum("n").alias("held"))
                .filter(F.col("held") > capacity).select("depth", "range"))
    splits = paths.join(overfull, ["depth", "range"]).groupBy("slot").agg(F.count(F.lit(1)).alias("local_depth"))
    return (filled.select("slot").join(splits, "slot", "left")
            .select("slot", F.coalesce("local_depth", F.lit(0)).cast("int").alias("local_depth"))
            .withColumn("bucket", F.expr(
                f"shiftleft(shiftrightunsigned(slot, {max_depth} - local_depth), {max_depth} - local_depth)")))


def build_index(texts: DataFrame, slots: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per distinct text: bucket, key, place in the key's chain, keep_id, group_size, sha256.

    Grouping by the text itself is the comparison of bytes; the ranges of the
    written files follow the buckets.
    """
    links = (texts.withColumn("slot", slot(max_depth))
             .join(F.broadcast(slots.select("slot", "bucket")), "slot")
             .groupBy("bucket", "key", "norm")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .select("bucket", "key", "keep_id", "group_size", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256")))
    chain = Window.partitionBy("bucket", "key")
    return (links.repartitionByRange("bucket", "key")
            .withColumn("link", F.row_number().over(chain.orderBy("keep_id", "text_sha256")))
            .withColumn("chain_length", F.count(F.lit(1)).over(chain)))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    texts = keyed(docs, key_bits)
    entries = stored(texts.select("doc_id", "key"), "dedup-entries")
    slots = stored(directory(entries, capacity, max_depth), "dedup-directory")
    index = stored(build_index(texts, slots, max_depth), "dedup-index")
    alone = index.filter("chain_length = 1").select("key", "keep_id", "group_size", "text_sha256")
    found = entries.join(alone, "key").select("doc_id", "keep_id", "group_size", "text_sha256")
    chained = index.filter("chain_length > 1")
    if not chained.isEmpty():
        # Different texts met under one key: their documents are told apart by the text, not by the key.
        bodies = (texts.join(chained.select("key").distinct(), "key", "left_semi")
                  .groupBy("key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        told = (texts.join(bodies, ["key", "norm"])
                .select("doc_id", "keep_id", "group_size", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256")))
        found = found.unionByName(told)
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
