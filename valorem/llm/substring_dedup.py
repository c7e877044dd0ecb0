"""Substring dedup by relative Lempel-Ziv parsing.

A window is SPAN consecutive words of a document. Each word of a window that
also starts in a document of smaller doc_id is a duplicate.

Reference blocks. Of each window's GRAM-word hashes the least (the rightmost
of equals) is its anchor, so equal windows have equal anchors at equal places.
Neighbouring windows of one anchor make a block (SPAN to 2 * SPAN - GRAM
words, about 20 windows). Blocks are indexed by (hash of the anchor's gram,
hash of the block's words) with the least doc_id that holds them: an
aggregate that combines before its shuffle, so a passage of very many
documents costs one row a task.

Factors. A document is parsed from left to right into blocks found whole in a
document of smaller id. At the ends of such factors a block differs from every
earlier one, but single windows of it may not: where an anchor has several
different blocks, each different block (once, at its least document) gives the
hashes of its windows, and the least doc_id of each is looked up. The windows
of CORE neighbouring places before an anchor have a core of SPAN - CORE + 1
words in common; only those whose core occurs in several documents are
looked up. Every window that occurs twice has its anchor, and so its blocks
and its core, in common: none is missed. Neighbouring finds from one document
are joined to one factor.

Words are compared by 64-bit hashes, blocks and windows by that of the
anchor's gram and one of their own.

Documents are read once for the blocks; the texts of documents that hold
different blocks of one anchor, and of those with factors, are read once more.
No join has a hint: adaptive execution broadcasts what is small.

Nulls are texts without words. A row without doc_id is neither cut nor a
source. Rows that repeat a doc_id are documents of their own (of no smaller
id than each other); equal rows each give a row. Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.llm.common import small_batches, stored, table, text_pieces
from valorem.llm.hashing import Rolling

SPAN = 50
GRAM = 10
CORE = 8
#: Bytes of text that are hashed at once. Of a longer text only words' hashes are held.
BLOCK = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[9:14] = _IS_SPACE[32] = True


class Words:
    """Words of some texts: their number and where they begin by text, and their hashes."""

    def __init__(self, texts: list[bytes]):
        starts, hashes, offset = [], [], 0
        for piece in text_pieces(b" ".join(texts) + b" ", BLOCK):
            data = np.frombuffer(piece + b" ", np.uint8)
            inside = ~_IS_SPACE[data]
            edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            if inside[0]:
                edges = np.concatenate(([0], edges))
            starts.append(edges[0::2] + offset)
            hashes.append(Rolling(data.astype(np.uint64)).spans(edges[0::2], edges[1::2]))
            offset += len(piece)
        start = np.concatenate(starts)
        size = np.array([len(t) + 1 for t in texts])
        self.first = np.searchsorted(start, np.cumsum(size) - size)
        self.count = np.diff(np.append(self.first, len(start)))
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.spans = Rolling(np.concatenate(hashes))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.spans.spans(start, end)

    def windows(self, span: int) -> np.ndarray:
        """Word numbers at which a window of ``span`` words of one text begins."""
        at = np.arange(max(0, len(self.text) - span + 1))
        return at[self.text[at] == self.text[at + span - 1]]


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (rightmost of equals) of each ``width`` neighbouring values."""
    place = np.arange(len(values))

    def pick(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] <= values[a], b, a)

    size = 1
    while size * 2 <= width:
        place = pick(place[:len(place) - size], place[size:])
        size *= 2
    rest = width - size
    return pick(place[:len(place) - rest], place[rest:]) if rest else place


def blocks_of(words: Words, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Blocks as (text, hash of the anchor's gram, hash of the block, first and last window, anchor), places by the text's words."""
    at = words.windows(span)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none, none, none
    every = np.arange(len(words.text) - gram + 1)
    grams = words.hashes(every, every + gram)
    anchor = least_of(grams, span - gram + 1)[at]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])))
    head = np.flatnonzero(new)
    first, last = at[head], at[np.append(head[1:], len(at)) - 1]
    # a block is the same one only with its anchor in the same place
    content = words.hashes(first, last + span) + (anchor[head] - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    text = words.text[first]
    of = words.first[text]
    return text, grams[anchor[head]].view(np.int64), content.view(np.int64), first - of, last - of, anchor[head] - of


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about BLOCK bytes of text (column 0)."""
    for batch in small_batches(batches):
        sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy()
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > BLOCK:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


_BLOCK = pa.struct([("h", pa.int64()), ("b", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int32())])


def _blocks_scan(span: int, gram: int):
    """(text, id, body) -> id, body, n_words, words_sha256, blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            texts = [t or b"" for t in batch.column(0).to_pylist()]
            words = Words(texts)
            text, h, b, *places = blocks_of(words, span, gram)
            size = np.bincount(text, minlength=len(texts))
            offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
            rows = pa.StructArray.from_arrays([pa.array(h), pa.array(b), *(pa.array(p.astype(np.int32)) for p in places)], fields=list(_BLOCK))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(words.count),
                 pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]), pa.ListArray.from_arrays(offsets, rows)],
                ["doc_id", "body", "n_words", "words_sha256", "blocks"])

    return run


def _windows_scan(span: int, core: int):
    """(text, id, wanted blocks) -> h, b, id, hash of the core, place of the first window in its block, hashes of the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            words = Words([t or b"" for t in batch.column(0).to_pylist()])
            wanted = batch.column(2)
            of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(wanted).to_numpy())
            items = wanted.flatten()
            h, b = items.field(0).to_numpy(), items.field(1).to_numpy()
            first, last, anchor = (items.field(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
            size = last - first + 1
            block = np.repeat(np.arange(len(of)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = first[block] + place
            # windows of one group begin in the same CORE places before the anchor
            group = (anchor[block] - at) // core
            new = np.concatenate(([True], (block[1:] != block[:-1]) | (group[1:] != group[:-1]))) if len(at) else np.empty(0, bool)
            head = np.flatnonzero(new)
            own = block[head]
            low = words.first[of[own]] + anchor[own] - group[head] * core
            cores = words.hashes(low, low - core + 1 + span) + group[head].astype(np.uint64)
            at = at + words.first[of[block]]
            offsets = pa.array(np.append(head, len(at)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[own]), pa.array(b[own]), pa.array(batch.column(1).to_numpy()[of[own]]), pa.array(cores.view(np.int64)),
                 pa.array(place[head].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(words.hashes(at, at + span).view(np.int64)))],
                ["h", "b", "doc_id", "core", "place", "windows"])

    return run


_FACTOR = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source", pa.int64())])
FACTORS = "array<struct<start: long, length: long, source: long>>"


def _join_finds(span: int):
    """(id, body, finds (first window, last window, source)) -> id, body, factors: neighbouring finds of one source as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for finds in batch.column(2).to_pylist():
                own: list[list[int]] = []
                for f in sorted(finds, key=lambda f: (f["first"], f["last"])):
                    if own and own[-1][2] == f["source"] and f["first"] <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], f["last"] + span)
                    else:
                        own.append([f["first"], f["last"] + span, f["source"]])
                out.append([{"start": s, "length": e - s, "source": o} for s, e, o in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(_FACTOR))],
                                             ["doc_id", "body", "factors"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("body"))


def parsed(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(doc_id, body, n_words, words_sha256 of every row; doc_id, body, factors of each document with a factor).

    body is a hash of the text: with doc_id it names a document. factors are
    (first word, length, doc_id of the source), by first word; they may overlap.
    """
    own = _texts(docs)
    scanned = stored(own.mapInArrow(_blocks_scan(span, gram), "doc_id long, body long, n_words long, words_sha256 string, "
                                    "blocks array<struct<h: long, b: long, first: int, last: int, anchor: int>>"), "substring-blocks")
    every = scanned.filter("doc_id is not null").select("doc_id", "body", F.explode("blocks").alias("k")).select("doc_id", "body", "k.*")
    # most anchors' grams occur in one document only, and their blocks can go at once
    often = every.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("h")
    blocks = stored(every.join(often, "h", "left_semi"), "substring-often")
    # the index: each different block with its least document, one place there, and whether others hold it
    index = stored(blocks.groupBy("h", "b").agg(F.min(F.struct("doc_id", "body", "first", "last", "anchor")).alias("at"), F.max("doc_id").alias("most"))
                   .select("h", "b", "at.*", (F.col("most") > F.col("at.doc_id")).alias("shared")), "substring-index")
    several = index.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    wanted = stored(index.join(several, "h", "left_semi").groupBy("doc_id", "body")
                    .agg(F.collect_list(F.struct("h", "b", "first", "last", "anchor")).alias("wanted")), "substring-ends")
    grouped = stored(own.join(wanted, ["doc_id", "body"]).select("text", "doc_id", "wanted")
                     .mapInArrow(_windows_scan(span, min(CORE, span - gram + 1)),
                                 "h long, b long, doc_id long, core long, place int, windows array<long>"), "substring-windows")
    cores = stored(grouped.groupBy("h", "core").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
                   .select("h", "core"), "substring-cores")
    windows = stored(grouped.join(cores, ["h", "core"], "left_semi").select("h", "b", "doc_id", "place", F.posexplode("windows").alias("i", "w"))
                     .select("h", "b", "doc_id", (F.col("place") + F.col("i")).alias("place"), "w"), "substring-pairs")
    least = windows.groupBy("h", "w").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("most")).filter("source < most").drop("most")
    part = (windows.join(least, ["h", "w"]).filter("source < doc_id")
            .groupBy("h", "b").agg(F.collect_set(F.struct("place", "source")).alias("part")))  # (equal rows of documents give equal rows)
    # a block in a later document is found whole; in its least document, by those of its windows that occur earlier
    found = stored(index.join(part, ["h", "b"], "left").filter("shared or part is not null")
                   .select("h", "b", F.col("doc_id").alias("source"), "part"), "substring-found")
    finds = (blocks.drop("anchor").join(found, ["h", "b"])
             .withColumn("find", F.when(F.col("doc_id") > F.col("source"), F.array(F.struct("first", "last", "source")))
                         .otherwise(F.transform("part", lambda p: F.struct((F.col("first") + p.place).alias("first"),
                                                                           (F.col("first") + p.place).alias("last"), p.source.alias("source")))))
             .filter("size(find) > 0"))
    factors = (finds.groupBy("doc_id", "body").agg(F.flatten(F.collect_set("find")).alias("finds"))
               .mapInArrow(_join_finds(span), f"doc_id long, body long, factors {FACTORS}"))
    return scanned.drop("blocks"), stored(factors, "substring-factors")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, id, factors) -> id, n_words, n_removed, kept text."""
    for batch in small_batches(batches, 256):
        total, removed, left = [], [], []
        for text, factors in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            words = text.split()
            keep = np.ones(len(words), bool)
            for f in factors:
                keep[f["start"]:f["start"] + f["length"]] = False
            total.append(len(words))
            removed.append(int(len(words) - keep.sum()))
            left.append(b" ".join([words[i] for i in np.flatnonzero(keep).tolist()]))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def _cut_texts(docs: DataFrame, factors: DataFrame) -> DataFrame:
    return (_texts(docs).join(factors, ["doc_id", "body"]).select("text", "doc_id", "factors")
            .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string"))


def dedup_substrings(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words by one space) of the documents that lose words; the others stay as they are."""
    return _cut_texts(docs, parsed(docs, span, gram)[1])


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words, factors = parsed(docs)
    cut = _cut_texts(docs, factors).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    same = words.doc_id.eqNullSafe(factors.doc_id) & (words.body == factors.body)
    whole = words.join(factors, same, "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("words_sha256").alias("kept_sha256"))
    return whole.unionByName(cut)


#: Windows as texts instead of hashes; blocks and anchors do not occur in it.
SQL = """
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
  SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50
), windows AS (
  SELECT r, doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS k FROM starts
), least AS (
  SELECT k, min(doc_id) AS source FROM windows GROUP BY k HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM windows JOIN least USING (k) WHERE source < doc_id
), kept AS (
  SELECT e.r, e.doc_id, e.w, e.i, gone.i IS NULL AS stays
  FROM (SELECT r, doc_id, w[i] AS w, i FROM (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)) e
  LEFT JOIN gone ON gone.r = e.r AND gone.i = e.i
), told AS (
  SELECT r, count(*) FILTER (NOT stays) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (stays), '') AS kept FROM kept GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN told USING (r)
"""
