"""Benchmark decontamination by winnowing.

Words are hashed, runs of ``GRAM`` words give a hash, and of each ``WINDOW``
neighbouring hashes the least (the rightmost of equals) is kept. Two texts
that share GRAM + WINDOW - 1 words in a row (10 here, the length of a
benchmark window) keep the same hash of that span, so joining the kept hashes
finds every shared window. A hit carries the words around it; comparing them
extends it to the whole shared run and drops hash collisions.

Benchmark items shorter than a window are one window each: texts are also
hashed at those lengths (at most nine), every run of words being kept.

Documents are read once. A bitmap of the benchmark's hashes, built only when
they are at most ``BITMAP_ROWS``, lets a document drop hashes that no item
has before the join; beyond that bound all kept hashes are joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import small_batches, stored, table, text_pieces, without
from valorem.llm.hashing import Rolling, mix

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1
#: Distinct benchmark hashes up to which the bitmap (2 MB, whatever their number) is sent to the tasks.
BITMAP_ROWS = 1 << 20
BITMAP_BITS = 24
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """Words of some segments of text: where they are, whose they are and their hashes."""

    def __init__(self, segments: list[bytes]):
        self.data = b"\n".join(segments) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        mask = _IS_WORD[raw]
        edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if mask[0]:
            edges = np.concatenate(([0], edges))
        self.start, self.end = edges[0::2], edges[1::2]
        lengths = np.array([len(s) + 1 for s in segments])
        self.segment_start = np.cumsum(lengths) - lengths
        self.first = np.searchsorted(self.start, self.segment_start)
        self.count = np.diff(np.append(self.first, len(self.start)))
        self.segment = np.repeat(np.arange(len(segments)), self.count)
        self.hash = Rolling(_LOWER[raw]).spans(self.start, self.end)

    def grams(self, size: int) -> np.ndarray:
        """Hash of each run of ``size`` words; a run over the end of a segment has a hash too."""
        n = max(0, len(self.hash) - size + 1)
        out = np.full(n, np.uint64(size))
        for i in range(size):
            out = out * _STEP + self.hash[i:n + i]
        return mix(out)

    def whole(self, at: np.ndarray, size: int) -> np.ndarray:
        """Those of the word numbers ``at`` from which ``size`` words lie in one segment."""
        at = at[at + size <= len(self.hash)]
        return at[self.segment[at] == self.segment[at + size - 1]]

    def text(self, start: int, end: int) -> str:
        """Words start..end-1, lower-cased and joined by a space."""
        return b" ".join(WORD.findall(self.data[self.start[start]:self.end[end - 1]])).lower().decode()


def winnowed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and hashes of the kept grams of every full window."""
    grams = words.grams(GRAM)
    at = words.whole(np.arange(max(0, len(grams) - WINDOW + 1)), SPAN)
    best, offset = grams[at], np.zeros(len(at), np.int64)
    for j in range(1, WINDOW):
        other = grams[at + j]
        take = other <= best
        best[take], offset[take] = other[take], j
    kept = np.unique(at + offset)
    return kept, grams[kept]


def _segments(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(number of its first word, segment): a long text in pieces that share SPAN - 1 words."""
    n, tail = 0, b""
    for piece in text_pieces(text, BLOCK):
        yield n, tail + piece
        if len(piece) >= BLOCK:
            own = tail + piece
            found = [m.start() for m in WORD.finditer(own)]
            keep = min(SPAN - 1, len(found))
            tail = own[found[len(found) - keep]:] + b" " if keep else b""
            n += len(found) - keep


def _hits(segments: list[bytes], short: list[int], bitmap: np.ndarray | None):
    """Per segment its word count; then per kept hash: segment, hash, first word of the hit, words before it, context."""
    words = Words(segments)
    parts = [(winnowed(words), GRAM, WINDOW - 1)]
    for size in short:
        grams = words.grams(size)
        at = words.whole(np.arange(len(grams)), size)
        parts.append(((at, grams[at]), size, 0))
    rows = []
    for (at, hashes), size, around in parts:
        if bitmap is not None:
            bit = hashes & np.uint64((1 << BITMAP_BITS) - 1)
            seen = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, hashes = at[seen], hashes[seen]
        for i, h in zip(at.tolist(), hashes.view(np.int64).tolist()):
            s = int(words.segment[i])
            low, high = int(words.first[s]), int(words.first[s] + words.count[s])
            left = min(around, i - low)
            rows.append((s, h, i - low, left, size, words.text(i - left, min(high, i + size + around))))
    return words.count, rows


HIT = "struct<h: long, pos: int, left: int, size: int, context: string>"
_HIT_TYPE = pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("left", pa.int32()), ("size", pa.int32()), ("context", pa.string())])


def _scan(short: list[int] | None, bitmap: np.ndarray | None):
    """(id, body, text) -> (id, body, n_words, hits). ``short`` None: a text of under SPAN words is hashed whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n_words = np.zeros(batch.num_rows, np.int32)
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            segments, owners = [], []

            def settle() -> None:
                if not segments:
                    return
                groups = [(short, list(range(len(segments))))]
                if short is None:
                    sizes = [len(WORD.findall(s)) for s in segments]
                    groups = [([size] if size < SPAN else [], [i for i, x in enumerate(sizes) if x == size or x >= SPAN <= size])
                              for size in sorted({min(x, SPAN) for x in sizes} - {0})]
                for lengths, own in groups:
                    counts, rows = _hits([segments[i] for i in own], lengths, bitmap)
                    for i, c in zip(own, counts):
                        n_words[owners[i][0]] = max(n_words[owners[i][0]], owners[i][1] + c)
                    for s, h, pos, left, size, context in rows:
                        row, n = owners[own[s]]
                        hits[row].append({"h": h, "pos": n + pos, "left": left, "size": size, "context": context})
                segments.clear()
                owners.clear()

            held = 0
            for i, text in enumerate(batch.column(2)):
                for n, segment in _segments((text.as_buffer().to_pybytes() if text.is_valid else b"")):
                    segments.append(segment)
                    owners.append((i, n))
                    held += len(segment)
                    if held >= BLOCK:
                        settle()
                        held = 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n_words), pa.array(hits, pa.list_(_HIT_TYPE))], ["id", "body", "n_words", "hits"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined hits -> id, cid, from_word, to_word of the shared run around each, where it is a window or more."""
    for batch in batches:
        ids, cids, starts, ends = [], [], [], []
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            own, cid, pos, left, size, context, other_left, other = row
            a, b = context.split(" "), other.split(" ")
            if a[left:left + size] != b[other_left:other_left + size]:
                continue
            low = 0
            while low < min(left, other_left) and a[left - low - 1] == b[other_left - low - 1]:
                low += 1
            high = size
            while left + high < len(a) and other_left + high < len(b) and a[left + high] == b[other_left + high]:
                high += 1
            if low + high >= (SPAN if size == GRAM and len(b) >= SPAN else size):
                ids.append(own)
                cids.append(cid)
                starts.append(pos - low)
                ends.append(pos + high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(cids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            ["id", "cid", "from_word", "to_word"])


def scan(docs: DataFrame, id_column: str, short: list[int] | None, bitmap: np.ndarray | None = None) -> DataFrame:
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64("text").alias("body"), F.encode("text", "UTF-8").alias("text"))
    return own.mapInArrow(_scan(short, bitmap), f"id long, body long, n_words int, hits array<{HIT}>")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, body (hash of the text): one row per input row.

    Null and empty texts have no words. Benchmark rows without words or
    without an id are no items; rows that repeat an id are one item with the
    windows of all of them. Input rows that share a doc_id are separate rows.
    An empty benchmark leaves every document clean.
    """
    items = stored(scan(benchmark, "item_id", None).filter("id is not null")
                   .select("id", F.explode("hits").alias("x")).select("id", "x.*"), "benchmark-hits")
    items = items.withColumn("cid", F.xxhash64("h", "left", "size", "context"))
    short = sorted(r.size for r in items.filter(f"size <> {GRAM} or size(split(context, ' ')) < {SPAN}")
                   .select("size").distinct().collect())  # at most nine lengths
    bits = items.select("h").distinct().limit(BITMAP_ROWS + 1).toArrow().column(0).to_numpy().view(np.uint64)
    bitmap = None
    if len(bits) <= BITMAP_ROWS:
        bits = bits & np.uint64((1 << BITMAP_BITS) - 1)
        bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        np.bitwise_or.at(bitmap, bits >> np.uint64(3), np.left_shift(1, bits & np.uint64(7)).astype(np.uint8))

    # A number of its own tells rows that share a doc_id apart; writing the table fixes it.
    seen = stored(scan(docs, "doc_id", short, bitmap).withColumn("row", F.monotonically_increasing_id()), "document-hits")
    with_hits = seen.filter("size(hits) > 0")
    hits = with_hits.select(F.col("row").alias("id"), F.explode("hits").alias("x")).select("id", "x.*")
    contexts = items.select("h", "cid", F.col("left").alias("other_left"), F.col("context").alias("other")).distinct()
    runs = stored(hits.join(contexts, "h")
                  .select("id", "cid", "pos", "left", "size", "context", "other_left", "other")
                  .mapInArrow(_runs, "id long, cid long, from_word int, to_word int"), "shared-runs")
    covered = (runs.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("from_word", "to_word"))).alias("spans"))
               .select("id", F.expr("""
                   aggregate(spans, named_struct('n', 0L, 'upto', 0), (acc, s) -> named_struct(
                     'n', acc.n + greatest(0, s.to_word - greatest(acc.upto, s.from_word)),
                     'upto', greatest(acc.upto, s.to_word)), acc -> acc.n)""").alias("n_hit")))
    found = (runs.select("id", "cid").distinct().join(items.select("cid", F.col("id").cast("string").alias("item")).distinct(), "cid")
             .groupBy("id").agg(F.array_sort(F.collect_set("item")).alias("items")))
    hit = covered.join(found, "id")
    none = F.array().cast("array<string>")
    return (seen.select(F.col("id").alias("doc_id"), "body", F.col("n_words").cast("long").alias("n_words"), F.col("row").alias("id"))
            .join(hit, "id", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.sha2(F.encode(F.array_join(F.coalesce("items", none), ","), "UTF-8"), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "body"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    found = contamination(docs, benchmark).filter("contaminated").select("doc_id", "body")
    return without(docs, stored(found, "contaminated"))


def op8_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("body")


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT id, i, n, item_id FROM dw JOIN bw USING (n, win)),
cover AS (
  SELECT id, count(DISTINCT pos) AS n_hit
  FROM (SELECT id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT id, i, n FROM hit)) GROUP BY id),
its AS (SELECT id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hit GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (id) LEFT JOIN its USING (id)
"""
