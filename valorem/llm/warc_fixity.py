"""Fixity audit of WARC replicas with Merkle trees.

A page becomes a WARC record; only its length and SHA-256 go on from there.
Records are packed into archives (``BLOCK_IDS`` page ids each; a block with
more than ``ARCHIVE_RECORDS`` records is split) and get offsets. The hashes of
records whose offsets lie in one range of ``RANGE`` bytes, in order, make a
leaf; ``FANOUT`` neighbouring nodes make a node of the next level, up to the
archive and over neighbouring archives up to the roots. Two replicas are
compared from the roots down: at each level only children of nodes that
differ are looked at. The records in the ranges that differ at last are
compared with one another.

Every node gathers a bounded number of children: records of one range, FANOUT
nodes, or the parts of one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valorem.llm.common import stored, table

BLOCK_IDS = 256
ARCHIVE_RECORDS = 4096
PART_BITS = 20
RANGE = 1 << 16
FANOUT_BITS = 8
#: Levels within an archive above the ranges: 16 MB, 4 GB.
RANGE_LEVELS = 2


def record(url, html):
    """The bytes of a page's record (as text: header, page, two line ends)."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def packed(pages: DataFrame) -> DataFrame:
    """page_id, archive, offset, length, digest, copies: the records of (page_id, url, html).

    Rows alike in all three are one record with its number of copies. Null
    url and html are empty; null ids share a block of their own.
    """
    own = (pages.select(F.col("page_id").cast("long"), record(F.col("url"), F.col("html")).alias("r"))
           .select("page_id", F.octet_length("r").cast("long").alias("length"), F.sha2(F.encode("r", "UTF-8"), 256).alias("digest"))
           .groupBy("page_id", "length", "digest").agg(F.count(F.lit(1)).alias("copies")))
    block = F.coalesce(F.floor(F.col("page_id") / BLOCK_IDS), F.lit(-1))
    parts = own.groupBy(block.alias("_block")).agg(F.ceil(F.count(F.lit(1)) / ARCHIVE_RECORDS).alias("_parts"))
    if parts.filter(F.col("_parts") > 1).isEmpty():
        part = F.lit(0).cast("long")
        placed = own.withColumn("_block", block)
    else:
        part = F.pmod(F.xxhash64("digest"), F.col("_parts"))
        placed = own.withColumn("_block", block).join(parts, "_block")
    placed = placed.withColumn("archive", F.shiftleft(F.col("_block"), PART_BITS) + part)
    before = Window.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("page_id", "archive", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "digest", "copies")


def _hash(place: str, value: str) -> F.Column:
    """Of the children's (place, value) in order."""
    return F.sha2(F.encode(F.expr(
        f"array_join(transform(array_sort(collect_list(struct({place} AS place, {value} AS value))), x -> concat(x.place, ':', x.value)), ';')"), "UTF-8"), 256)


def _up(level: int) -> tuple[list[F.Column], list[str]]:
    """(columns that name the parent of a node of this level, the parent's key)."""
    if level < RANGE_LEVELS:
        return [F.col("archive"), F.shiftright("place", FANOUT_BITS)], ["archive", "place"]
    bits = PART_BITS if level == RANGE_LEVELS else FANOUT_BITS
    return [F.shiftright("archive", bits), F.lit(0).cast("long")], ["archive", "place"]


def tree(records: DataFrame, levels: int) -> list[DataFrame]:
    """Levels from the leaves up, each (replica, archive, place, hash).

    Up to RANGE_LEVELS place is a range's number in its archive; above that,
    archive is a prefix of archive numbers and place is 0.
    """
    out = [stored(records.groupBy("replica", "archive", F.floor(F.col("offset") / RANGE).alias("place"))
                  .agg(_hash("offset", "concat(digest, '*', copies)").alias("hash")), "fixity-level-0")]
    for level in range(levels):
        (archive, place), _ = _up(level)
        out.append(stored(out[-1].select("replica", archive.alias("above"), place.alias("beside"), "archive", "place", "hash")
                          .groupBy("replica", F.col("above").alias("archive_"), F.col("beside").alias("place_"))
                          .agg(_hash("archive", "concat(place, '=', hash)" if level >= RANGE_LEVELS else "concat(lpad(place, 20, '0'), '=', hash)").alias("hash"))
                          .select("replica", F.col("archive_").alias("archive"), F.col("place_").alias("place"), "hash"), f"fixity-level-{level + 1}"))
    return out


def differing_ranges(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(archive, place) of the leaf ranges in which the replicas differ; (level, compared, differ): nodes on the way down."""
    low, high = records.agg(F.min("archive"), F.max("archive")).first()
    blocks = max(1, ((high or 0) >> PART_BITS) - ((low or 0) >> PART_BITS))
    levels = tree(records, RANGE_LEVELS + 1 + -(-blocks.bit_length() // FANOUT_BITS))
    differ, seen = None, None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        if differ is not None:  # only children of nodes that differ
            (archive, place), _ = _up(level)
            above = differ.select(F.col("archive").alias("above"), F.col("place").alias("beside"))
            nodes = nodes.withColumn("above", archive).withColumn("beside", place).join(above, ["above", "beside"], "left_semi")
        met = stored(nodes.groupBy("archive", "place").agg(
            F.count(F.lit(1)).alias("replicas"), F.min("hash").alias("one"), F.max("hash").alias("two"))
            .select("archive", "place", ((F.col("replicas") == 2) & (F.col("one") == F.col("two"))).alias("same")), f"fixity-compared-{level}")
        count = met.agg(F.lit(level).alias("level"), F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("same")).alias("differ"))
        seen = count if seen is None else seen.unionByName(count)
        differ = met.filter(~F.col("same")).select("archive", "place")
    return differ, seen


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """page_id, archive, offset, length, digest, status for every record of the original, and of the replica's extra and added ones.

    status: ok; changed (the replica has the page, but not this record in as
    many copies); missing (it hasn't the page); extra (only the replica has
    the page; offset and digest are the replica's); added (only the replica
    has this record of a known page, and the page has more such records than
    it lost; which of them stand for lost ones can't be told, so all are
    given). An empty table makes all records missing or extra; two empty
    tables give no rows.
    """
    both = stored(packed(original).withColumn("replica", F.lit(0)).unionByName(packed(replica).withColumn("replica", F.lit(1))), "fixity-records")
    differ, _ = differing_ranges(both)
    a, b = both.filter("replica = 0").drop("replica"), both.filter("replica = 1").drop("replica")
    columns = ["page_id", "archive", "offset", "length", "digest"]
    suspect = a.withColumn("place", F.floor(F.col("offset") / RANGE)).join(differ, ["archive", "place"], "left_semi").select("page_id", "digest", "copies")
    other = b.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.col("copies").alias("_copies"))
    # A record may lie in another range of the replica when one before it changed in length, so it is looked up by its hash.
    bad = suspect.join(other, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")) & (F.col("copies") == F.col("_copies")), "left_anti")
    there = other.select("_page", F.lit(True).alias("_there")).distinct()
    found = (bad.join(there, F.col("page_id").eqNullSafe(F.col("_page")), "left")
             .select(F.col("page_id").alias("_bad"), F.col("digest").alias("_bad_digest"), F.when(F.col("_there"), "changed").otherwise("missing").alias("status")))
    known = (a.join(found, F.col("page_id").eqNullSafe(F.col("_bad")) & (F.col("digest") == F.col("_bad_digest")), "left")
             .select(*columns, F.coalesce("status", F.lit("ok")).alias("status")))
    more = b.withColumn("place", F.floor(F.col("offset") / RANGE)).join(differ, ["archive", "place"], "left_semi")
    own = a.select(F.col("page_id").alias("_page")).distinct()
    extra = more.join(own, F.col("page_id").eqNullSafe(F.col("_page")), "left_anti").select(*columns, F.lit("extra").alias("status"))
    return known.unionByName(extra).unionByName(_added(a, b, suspect, more).select(*columns, F.lit("added").alias("status")))


def _added(a: DataFrame, b: DataFrame, suspect: DataFrame, more: DataFrame) -> DataFrame:
    """Suspect records that only the replica has, of the original's pages that lost fewer records than they gained."""
    def without(records: DataFrame, others: DataFrame) -> DataFrame:
        others = others.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"))
        return records.join(others, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left_anti")

    def per_page(records: DataFrame, name: str) -> DataFrame:
        return records.groupBy(F.col("page_id").alias("_page")).agg(F.count(F.lit(1)).alias(name))

    gained = without(more, a)
    pages = a.select(F.col("page_id").alias("_own")).distinct()
    lost = per_page(without(suspect, b), "lost").withColumnRenamed("_page", "_lost_page")
    grown = (per_page(gained, "gained").join(pages, F.col("_page").eqNullSafe(F.col("_own")), "left_semi")
             .join(lost, F.col("_page").eqNullSafe(F.col("_lost_page")), "left")
             .filter(F.col("gained") > F.coalesce("lost", F.lit(0))).select("_page"))
    return gained.join(grown, F.col("page_id").eqNullSafe(F.col("_page")), "left_semi")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with faults, chosen by the first byte of md5(page_id): a changed byte, a changed url, a lost page, a page too many, a second record of a page (four of 256 each)."""
    chance = F.substring(F.md5(F.encode(F.coalesce(F.col("page_id").cast("string"), F.lit("")), "UTF-8")), 1, 2)
    whole = pages.select("page_id", "url", "html").withColumn("chance", chance)
    kept = (whole.filter(~F.col("chance").between("08", "0b"))
            .withColumn("html", F.when(F.col("chance") < "04", F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
            .withColumn("url", F.when(F.col("chance").between("04", "07"), F.concat("url", F.lit("#moved"))).otherwise(F.col("url"))))
    more = whole.filter(F.col("chance").between("0c", "0f")).withColumn("page_id", F.col("page_id") + F.lit(1_000_000_000_000))
    again = whole.filter(F.col("chance").between("10", "13")).withColumn("url", F.concat(F.coalesce("url", F.lit("")), F.lit("#again")))
    return kept.unionByName(more).unionByName(again).drop("chance")


def op6_warc_fixity(spark, sf_dir):
    """Audits a replica of ``pages`` with known faults against the original."""
    pages = table(spark, sf_dir, "pages")
    return audit(pages, damaged(pages))


SQL = r"""
WITH p AS (SELECT page_id, url, html, substr(md5(page_id::VARCHAR), 1, 2) AS chance FROM pages),
x AS (
  SELECT 0 AS replica, page_id, url, html FROM p
  UNION ALL
  SELECT 1, page_id, CASE WHEN chance BETWEEN '04' AND '07' THEN url || '#moved' ELSE url END,
         CASE WHEN chance < '04' THEN '#' || substr(html, 2) ELSE html END FROM p WHERE chance NOT BETWEEN '08' AND '0b'
  UNION ALL
  SELECT 1, page_id + 1000000000000, url, html FROM p WHERE chance BETWEEN '0c' AND '0f'
  UNION ALL
  SELECT 1, page_id, coalesce(url, '') || '#again', html FROM p WHERE chance BETWEEN '10' AND '13'),
t AS (
  SELECT replica, page_id, 'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl
         || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(coalesce(html, '')) || nl || nl || coalesce(html, '') || nl || nl AS rec
  FROM x, (SELECT chr(13) || chr(10) AS nl)),
r AS (
  SELECT replica, page_id, (page_id // 256) * 1048576 AS archive, strlen(rec) AS length, sha256(rec) AS digest, count(*) AS copies
  FROM t GROUP BY ALL),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY replica, archive ORDER BY page_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
  FROM r),
alone AS (
  SELECT *, count(*) FILTER (WHERE replica = 1) OVER (PARTITION BY page_id) AS gained, count(*) FILTER (WHERE replica = 0) OVER (PARTITION BY page_id) AS lost
  FROM o WHERE NOT EXISTS (SELECT 1 FROM o b WHERE b.replica <> o.replica AND b.page_id = o.page_id AND b.digest = o.digest))
SELECT page_id, archive::BIGINT AS archive, "offset"::BIGINT AS "offset", length::BIGINT AS length, digest,
       CASE WHEN EXISTS (SELECT 1 FROM o b WHERE b.replica = 1 AND b.page_id = o.page_id AND b.digest = o.digest AND b.copies = o.copies) THEN 'ok'
            WHEN EXISTS (SELECT 1 FROM o b WHERE b.replica = 1 AND b.page_id = o.page_id) THEN 'changed' ELSE 'missing' END AS status
FROM o WHERE replica = 0
UNION ALL
SELECT page_id, archive::BIGINT, "offset"::BIGINT, length::BIGINT, digest, 'extra'
FROM o WHERE replica = 1 AND NOT EXISTS (SELECT 1 FROM o a WHERE a.replica = 0 AND a.page_id = o.page_id)
UNION ALL
SELECT page_id, archive::BIGINT, "offset"::BIGINT, length::BIGINT, digest, 'added'
FROM alone WHERE replica = 1 AND gained > lost AND EXISTS (SELECT 1 FROM o a WHERE a.replica = 0 AND a.page_id = alone.page_id)
"""
