"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has 64 bits. It is cut into two halves: of the three bits that
two linked fingerprints may differ in, one half has one at most. Every half is
indexed once per position with that position left out (a wildcard), so two
halves that differ in one bit at most share a signature. Fingerprints meet by
equality of signatures and links are verified by counting bits.

Repeated fingerprints meet once. A signature that more than ``MOST``
distinct fingerprints share is not compared in one task: its members go on to
the next level, where the half that is not fixed yet is cut and indexed in the
same way (three differences again leave one at most to one of its halves).
After two such levels 11 bits are free, so no signature has more than 2,048
fingerprints and nothing is left out. A task writes a spanning forest of each
signature's links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import sized, small_batches, stored, table, text_pieces, with_body, without
from valorem.llm.components import components
from valorem.llm.hashing import whole_runs

WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of one signature that a task compares with one another.
MOST = 4096
#: Shingles that are counted at once.
BLOCK = 200_000

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)
_LANES = np.uint64(0x0101010101010101)


def _shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of each word shingle of a text, in blocks."""
    tail: list[bytes] = []
    n_seen = 0
    for piece in text_pieces(text.lower()):
        own = tail + piece.split()
        n = len(own) - words + 1
        if n > 0:
            n_seen += n
            yield np.fromiter(map(_hash, map(b" ".join, zip(*(own[i:] for i in range(words))))), np.uint64, n)
        tail = own[max(0, len(own) - words + 1):]
    if not n_seen and tail:
        yield np.array([_hash(b" ".join(tail))], np.uint64)


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set in each run of hashes that begins at ``starts``.

    Eight bits are counted side by side in the bytes of one word, over at most
    255 hashes at a time, so that no byte overflows.
    """
    ends = np.append(starts[1:], len(hashes))
    pieces = (ends - starts + 254) // 255
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(pieces)[:-1])) * 255, pieces) + np.arange(pieces.sum()) * 255
    runs = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    out = np.empty((len(starts), 64), np.int64)
    for i in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(i)) & _LANES, first)
        by_byte = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[:, i::8] = np.add.reduceat(by_byte, runs, axis=0)
    return out


def fingerprints(texts: list[bytes | None], words: int = WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints; 0 for a text without words."""
    counts = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    blocks: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if blocks:
            lengths = np.array([len(b) for b in blocks])
            own = _bit_counts(np.concatenate(blocks), np.concatenate(([0], np.cumsum(lengths)[:-1])))
            np.add.at(counts, owners, own)
            np.add.at(totals, owners, lengths)
            blocks.clear()
            owners.clear()

    held = 0
    for i, text in enumerate(texts):
        for block in _shingle_hashes(text or b"", words):
            blocks.append(block)
            owners.append(i)
            held += len(block)
            if held >= BLOCK:
                flush()
                held = 0
    flush()
    bits = counts * 2 > totals[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprint_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, body (hash of the text), fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fp = fingerprints(batch.column(2).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp.view(np.int64))], ["doc_id", "body", "fp"])

    own = with_body(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long"), "body", F.encode("text", "UTF-8").alias("text"))
    return own.mapInArrow(run, "doc_id long, body long, fp long")


def signatures(rows: DataFrame, width: int) -> DataFrame:
    """key, fp, rest: one row for each half of ``rest`` (2 x ``width`` bits) and position left out of it.

    The new ``rest`` is the other half. Keys are hashes of what is fixed so
    far; two things with one key are told apart when links are verified.
    """
    mask = (1 << width) - 1
    return (rows.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))))
            .withColumn("low", F.expr(f"rest & {mask}L"))
            .withColumn("high", F.expr(f"shiftrightunsigned(rest, {width}) & {mask}L"))
            .withColumn("half", F.expr(f"if(v < {width}, low, high)"))
            .select(F.expr(f"xxhash64(key, v, half & ~shiftleft(1L, v % {width}))").alias("key"), "fp",
                    F.expr(f"if(v < {width}, high, low)").alias("rest")))


def _forest(fps: np.ndarray, runs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all the fingerprints of a run that are linked to one another.

    ``runs`` is sorted. Every pair of a run is compared, one distance in the
    run at a time, but a pair whose ends are already connected gives no link.
    """
    label = np.arange(len(fps))
    out_a, out_b = [], []
    at = np.flatnonzero(runs[1:] == runs[:-1])
    step = 1
    while len(at):
        differ = np.bitwise_count(fps[at] ^ fps[at + step])
        near = at[(differ <= max_bits)]
        near = near[label[near] != label[near + step]]
        if len(near):
            out_a.append(fps[near])
            out_b.append(fps[near + step])
            a, b = near, near + step
            while len(a):  # the least label on both ends, until labels of linked members agree
                low = np.minimum(label[a], label[b])
                np.minimum.at(label, label[a], low)
                np.minimum.at(label, label[b], low)
                while not np.array_equal(label, label[label]):
                    label = label[label]
                a, b = a[label[a] != label[b]], b[label[a] != label[b]]
        step += 1
        at = at[at + step < len(fps)]
        at = at[runs[at] == runs[at + step]]
    none = np.empty(0, fps.dtype)
    return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])


def _compare(most: int | None, max_bits: int):
    """Rows sorted by key -> links (hot false: a, b) and members of too common keys (hot true: key, fp, rest)."""
    schema = pa.schema([("hot", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), ("rest", pa.int64())])

    def out(hot: bool, a, b, rest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), hot)), pa.array(a), pa.array(b), pa.array(rest)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for common, (key, fp, rest) in whole_runs(batches, 3, most):
            if common:
                yield out(True, key, fp, rest)
            else:
                a, b = _forest(fp.view(np.uint64), key, max_bits)
                if len(a):
                    yield out(False, a.view(np.int64), b.view(np.int64), np.zeros(len(a), np.int64))

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect all within ``max_bits`` (3 at most)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves and one wildcard find differences of three bits at most")
    rows = fps.select(F.lit(0).cast("long").alias("key"), "fp", F.col("fp").alias("rest"))
    links = None
    for width in (32, 16, 8):
        met = (signatures(rows, width).repartition("key").sortWithinPartitions("key")
               .mapInArrow(_compare(most if width > 8 else None, max_bits), "hot boolean, a long, b long, rest long"))
        met = stored(met, f"simhash-{width}")
        found = met.filter("not hot").select("a", "b")
        links = found if links is None else links.unionByName(found)
        rows = met.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("fp"), "rest")
        if rows.isEmpty():
            break
    return links


def grouped(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """doc_id, body, fp, root: rows with one root are a group of near-duplicates."""
    prints = stored(fingerprint_table(docs, words), "simhash-fingerprints")
    nodes = prints.select("fp").distinct()
    roots = components(near_links(nodes, max_bits, most)).withColumnRenamed("node", "fp")
    rows = prints.join(roots, "fp", "left").select("doc_id", "body", "fp", F.coalesce("root", "fp").alias("root"))
    return sized(rows, prints.count())


def simhash_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per input row.

    Null and empty texts have fingerprint zero and link like any other.
    Rows that repeat a doc_id are separate rows. A component whose ids are all
    null has a null component_id. An empty table gives no rows; other columns
    of the input are ignored.
    """
    rows = stored(grouped(docs, words, max_bits, most), "simhash-groups")
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(ids, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    return sized(out, rows.count())


def one_per_group(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` with one row of each group: the one of least doc_id (null ids last), then of least body."""
    rows = stored(grouped(docs, words, max_bits, most), "simhash-groups")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "body")
    kept = rows.groupBy("root").agg(F.min(first).alias("kept"))
    gone = rows.join(kept, "root").filter(~first.eqNullSafe(F.col("kept"))).select("doc_id", "body")
    left = without(docs, stored(sized(gone, rows.count()), "simhash-gone"))
    repeated = rows.groupBy("root", "doc_id", "body").count().filter("count > 1").join(kept, "root").filter(first.eqNullSafe(F.col("kept")))
    if repeated.isEmpty():
        return left
    # A row that stays occurs more than once, id and text alike: one of the rows is enough.
    return with_body(left).dropDuplicates(["doc_id", "body"]).select(*docs.columns)


def op4_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))
