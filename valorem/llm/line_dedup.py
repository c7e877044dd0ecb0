"""Line deduplication with a segment-partition edit join.

Lines are compared after lower-casing A-Z and trimming white space. A line of
``MIN_EQUAL`` bytes or more (any that isn't empty) goes when an equal line
precedes it (documents in the order of doc_id, lines in their order). One of
``MIN_NEAR`` bytes or more also goes when a line within ``EDITS`` byte edits
(insertions, deletions, replacements of UTF-8 bytes) first occurs before it;
two shorter lines resemble each other by chance.

The edit join cuts a line into EDITS + 1 segments; two lines within EDITS
edits share a segment unchanged. Segments are indexed under their line's
length, number and hash, and each line probes the indexes of its own length
and of the EDITS shorter ones with the few substrings whose shift the edits
allow. Index and probe rows meet by key in sorted partitions. A row carries a
64-bit sketch (parities of its bytes and byte pairs) that drops most pairs
without their texts. Rows that are left with a partner get their texts and meet
again under the same key, where an edit automaton whose states are bits along a
diagonal band verifies them.

Pairs never leave the task in which they meet: it gives each line its number of
links and whether a linked line occurs before it, so what is written grows with
the lines and not with the square of a group. A pair that shares several keys
counts under the least of them.

A key that more than ``MOST`` rows share is compared in cells: its index rows
and its probes are dealt into blocks of about ``BLOCK_ROWS``, and each pair of
blocks is a cell of its own. No task holds more than two blocks at once, and no
pair is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valorem.llm.common import small_batches, stored, table
from valorem.llm.hashing import Rolling, mix, whole_runs

EDITS = 2
MIN_EQUAL = 1
MIN_NEAR = 40
#: Rows of one key that are compared in one task.
MOST = 4000
#: Rows of a block of a more common key.
BLOCK_ROWS = 1000
#: Bytes of lines that are hashed at once.
BLOCK = 1 << 20
#: What a row is among those of its key: paired with all others, paired with probes only, or a probe.
INDEX, CROSS, PROBE = 0, 1, 2
#: Lines with candidates up to which their ids (8 bytes each) are sent to the tasks that read the texts again.
SEND_IDS = 1 << 20


def split_lines(text: str | None) -> list[bytes]:
    """The compared form of each line."""
    return [line.strip() for line in (text or "").encode().lower().split(b"\n")]


def line_key(line: bytes) -> tuple[int, int]:
    """128 bits that stand for a line, as two longs."""
    return tuple(np.frombuffer(hashlib.md5(line, usedforsecurity=False).digest(), np.int64).tolist())


# --- candidate pairs -----------------------------------------------------------------------------------------

_BYTE_BIT = np.uint64(1) << (mix(np.arange(256, dtype=np.uint64)) & np.uint64(31))
_PAIR_BIT = np.uint64(1) << (np.uint64(32) + (mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(999)) & np.uint64(31)))
_LOW = np.uint64(0xFFFFFFFF)


def sketches(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Parities of hashed bytes (low half) and byte pairs (high half) of each line. An edit flips 2 and 4 at most."""
    bits = _BYTE_BIT[raw]
    pairs = _PAIR_BIT[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
    pairs[start[1:] - 1] = 0  # a pair over the end of a line
    bits[:-1] |= pairs
    return np.bitwise_xor.reduceat(bits, start)


def segment_rows(lines: list[bytes], ids: np.ndarray, edits: int) -> np.ndarray:
    """3 x n longs: key, id with role (INDEX or PROBE) in the two lowest bits, sketch. Lines are longer than ``edits``."""
    raw = np.frombuffer(b"".join(lines), np.uint8)
    length = np.array([len(x) for x in lines])
    start = np.cumsum(length) - length
    sketch = sketches(raw, start).view(np.int64)
    hashes = Rolling(raw.astype(np.uint64))
    parts = edits + 1
    own = ids & ~np.int64(3)
    out = []

    def add(which: np.ndarray, at: np.ndarray, size: np.ndarray, indexed: np.ndarray, number: int, role: int) -> None:
        h = hashes.spans(start[which] + at[which], start[which] + at[which] + size[which])
        key = mix(h ^ mix((indexed[which] * parts + number).astype(np.uint64)))
        out.append(np.stack([key.view(np.int64), own[which] | role, sketch[which]]))

    for shorter in range(edits + 1):
        indexed = length - shorter
        for i in range(parts):
            # Segment i of a line of that length: the last ones are longer by one.
            size = indexed // parts + (i >= parts - indexed % parts)
            place = i * (indexed // parts) + np.maximum(0, i - (parts - indexed % parts))
            low = max(-i, shorter - (edits - i))
            high = min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                at = place + shift
                which = np.flatnonzero((at >= 0) & (at + size <= length) & (indexed >= parts))
                if shorter == 0 and shift == 0:
                    add(which, at, size, indexed, i, INDEX)  # the index row is also the unshifted probe of its own length
                elif len(which):
                    add(which, at, size, indexed, i, PROBE)
    return np.concatenate(out, axis=1)


def _emit_segments(edits: int, min_near: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(own: dict[bytes, int]):
            rows = segment_rows(list(own), np.array(list(own.values()), np.int64), edits)
            return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["key", "line", "sketch"])

        for batch in small_batches(batches):
            own: dict[bytes, int] = {}
            held = 0
            for text in batch.column(0).to_pylist():
                for line in split_lines(text):
                    if len(line) >= min_near and line not in own:
                        own[line] = line_key(line)[0]
                        held += len(line)
                        if held >= BLOCK:
                            yield settle(own)
                            own, held = {}, 0
            if own:
                yield settle(own)

    return run


def meetings(key: np.ndarray, line: np.ndarray, sketch: np.ndarray, edits: int):
    """Places of an index row and of another line's row of its key whose sketches allow ``edits``. A pair may come twice."""
    order = np.lexsort((line & 3, key))
    key, line, sketch = key[order], line[order], sketch[order].view(np.uint64)
    role, line = line & 3, line >> 2
    at = np.flatnonzero((key[1:] == key[:-1]) & (role[:-1] != PROBE))
    step = 1
    while len(at):
        differ = sketch[at] ^ sketch[at + step]
        near = at[(np.bitwise_count(differ & _LOW) <= 2 * edits) & (np.bitwise_count(differ >> np.uint64(32)) <= 4 * edits)]
        near = near[((role[near] == INDEX) | (role[near + step] == PROBE)) & (line[near] != line[near + step])]
        if len(near):
            yield order[near], order[near + step]
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]


def _with_partner(edits: int, most: int | None, cells: bool):
    """Rows (cell, key, line) that meet a possible partner; with ``most``, rows of more common keys as they come."""
    columns = 4 if cells else 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(common: bool, *columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), common)), *map(pa.array, columns)],
                                              ["common", "cell", "key", "line", "sketch"])

        for common, rows in whole_runs(batches, columns, most):
            cell, key, line, sketch = rows if cells else (rows[0], *rows)
            if common:
                yield out(True, cell, key, line, sketch)
                continue
            met = np.zeros(len(cell), bool)
            for x, y in meetings(cell, line, sketch, edits):
                met[x] = met[y] = True
            if met.any():
                left = np.unique(np.stack([cell[met], key[met], line[met]]), axis=1)
                yield out(False, *left, np.zeros(left.shape[1], np.int64))

    return run


_MET = "common boolean, cell long, key long, line long, sketch long"


def candidates(docs: DataFrame, edits: int = EDITS, min_near: int = MIN_NEAR, most: int = MOST,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """cell, key, line (id and role): the rows that meet a possible partner in their cell."""
    rows = docs.select("text").mapInArrow(_emit_segments(edits, min_near), "key long, line long, sketch long")
    met = stored(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_with_partner(edits, most, False), _MET), "line-candidates")
    found = met.filter("not common").select("cell", "key", "line")
    common = met.filter("common").select("key", "line", "sketch")
    if common.isEmpty():
        return found
    # An index row meets all that a probe of the same line meets.
    common = common.groupBy("key", F.expr("shiftright(line, 2)").alias("id")).agg(F.min("line").alias("line"), F.first("sketch").alias("sketch"))
    blocks = (common.groupBy("key").agg(
        F.ceil(F.count_if(F.expr(f"line & 3 = {INDEX}")) / block_rows).cast("int").alias("n"),
        F.ceil(F.count_if(F.expr(f"line & 3 = {PROBE}")) / block_rows).cast("int").alias("p")).filter("n > 0"))
    # Cells are numbered n * i + j for blocks i <= j of index rows and n * n + p * i + j for block j of the probes.
    own_cells = f"""transform(sequence(0, n - 1), j -> struct(
        cast(n as long) * least(j, own) + greatest(j, own) as number, case when j = own then {INDEX} when j < own then {PROBE} else {CROSS} end as role))"""
    index_cells = f"""concat({own_cells}, if(p = 0, array(), transform(sequence(0, p - 1), j -> struct(
        cast(n as long) * n + cast(p as long) * own + j as number, {CROSS} as role))))"""
    probe_cells = f"""transform(sequence(0, n - 1), i -> struct(
        cast(n as long) * n + cast(p as long) * i + own as number, {PROBE} as role))"""
    dealt = (common.join(blocks, "key")
             .withColumn("own", F.expr(f"cast(pmod(xxhash64(line), if(line & 3 = {INDEX}, n, p)) as int)"))
             .withColumn("at", F.explode(F.expr(f"if(line & 3 = {INDEX}, {index_cells}, {probe_cells})")))
             .select(F.xxhash64("key", "at.number").alias("cell"), "key", F.expr("(id * 4) | at.role").alias("line"), "sketch"))
    again = stored(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_with_partner(edits, None, True), _MET), "common-line-candidates")
    return found.unionByName(again.select("cell", "key", "line"))


# --- verification --------------------------------------------------------------------------------------------

def within_edits(a: bytes, b: bytes, edits: int) -> int | None:
    """The edit distance if it is ``edits`` at most, else None.

    Bit d of a level's word is the diagonal len(prefix of a) - len(prefix of
    b) = d - edits, reachable with that many edits. A byte of b moves all
    levels on at once.
    """
    n = min(len(a), len(b))
    first = next((i for i in range(0, n, 64) if a[i:i + 64] != b[i:i + 64]), n)
    while first < n and a[first] == b[first]:
        first += 1
    a, b = a[first:], b[first:]
    n = min(len(a), len(b))
    last = next((i for i in range(0, n, 64) if a[len(a) - min(n, i + 64):len(a) - i] != b[len(b) - min(n, i + 64):len(b) - i]), n)
    while last < n and a[len(a) - 1 - last] == b[len(b) - 1 - last]:
        last += 1
    a, b = a[:len(a) - last], b[:len(b) - last]
    if abs(len(a) - len(b)) > edits:
        return None
    band = (1 << (2 * edits + 1)) - 1
    levels, reach = [], 1 << edits
    for _ in range(edits + 1):
        levels.append(reach & band)
        reach |= reach << 1
    for j, byte in enumerate(b):
        equal = 0
        for d in range(2 * edits + 1):
            i = j + d - edits
            if 0 <= i < len(a) and a[i] == byte:
                equal |= 1 << d
        before, moved = 0, 0
        for e, level in enumerate(levels):
            # unchanged diagonal: equal bytes or a replacement; one less: a byte only of b; one more: a byte only of a
            now = (level & equal) | before | (before >> 1) | (moved << 1)
            levels[e] = moved = now & band
            before = level
        if not moved:
            return None
    goal = 1 << (len(a) - len(b) + edits)
    return next((e for e, level in enumerate(levels) if level & goal), None)


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``cell`` in tables of whole cells."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        first = int(np.searchsorted(cell != (held[0].column("cell")[-1].as_py() if held else cell[0]), True))
        last = int(np.argmax(cell == cell[-1]))
        if held and first == 0:  # the held cell has ended
            yield pa.Table.from_batches(held)
            held = []
        if last == 0 and (not held or first == batch.num_rows):  # one cell only
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _verify(edits: int):
    """Rows with texts, by cell -> h1, h2, links, near (a linked line occurs first before it): what each line has in these cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            number: dict[bytes, int] = {}
            own = np.array([number.setdefault(x, len(number)) for x in rows.column("text").to_pylist()])
            lines = list(number)
            keys, ids, sketch = segment_rows(lines, np.arange(len(lines)) * 4, edits)
            sketch_of = np.zeros(len(lines), np.int64)
            sketch_of[ids >> 2] = sketch
            indexed: list[set[int]] = [set() for _ in lines]
            probed: list[set[int]] = [set() for _ in lines]
            for key, x in zip(keys.tolist(), ids.tolist()):
                probed[x >> 2].add(key)
                if x & 3 == INDEX:
                    indexed[x >> 2].add(key)
            place: list = [None] * len(lines)
            of = [rows.column(c).to_pylist() for c in ("last", "doc_id", "body", "n")]
            for x, last, doc, body, n in zip(own.tolist(), *of):
                place[x] = (last, doc or 0, body, n)
            role = rows.column("line").to_numpy() & 3
            key = rows.column("key").to_numpy()
            pairs = [(np.minimum(own[x], own[y]), np.maximum(own[x], own[y]), key[x])
                     for x, y in meetings(rows.column("cell").to_numpy(), own * 4 | role, sketch_of[own], edits)]
            links, near = np.zeros(len(lines), np.int64), np.zeros(len(lines), bool)
            if pairs:
                for a, b, k in np.unique(np.stack([np.concatenate(x) for x in zip(*pairs)]), axis=1).T.tolist():
                    if min((indexed[a] & probed[b]) | (indexed[b] & probed[a])) == k and within_edits(lines[a], lines[b], edits) is not None:
                        links[a] += 1
                        links[b] += 1
                        near[b if place[a] < place[b] else a] = True
            at = np.flatnonzero(links)
            h = {x: (h1, h2) for x, h1, h2 in zip(own.tolist(), rows.column("h1").to_pylist(), rows.column("h2").to_pylist())}
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[x][i] for x in at.tolist()], pa.int64()) for i in (0, 1)] + [pa.array(links[at]), pa.array(near[at])],
                ["h1", "h2", "links", "near"])

    return run


def _texts_of(min_near: int, wanted: np.ndarray | None):
    """Lines as h1, h2, text; only those whose id is among ``wanted`` (sorted), if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            own: dict[tuple[int, int], bytes] = {}
            for text in batch.column(0).to_pylist():
                lines = [x for x in set(split_lines(text)) if len(x) >= min_near]
                keys = [line_key(x) for x in lines]
                if wanted is not None and keys:
                    half = np.array([k[0] for k in keys]) >> 2
                    at = np.minimum(np.searchsorted(wanted, half), max(0, len(wanted) - 1))
                    keep = wanted[at] == half if len(wanted) else np.zeros(len(half), bool)
                    own |= {keys[i]: lines[i] for i in np.flatnonzero(keep)}
                else:
                    own |= dict(zip(keys, lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in own], pa.int64()), pa.array([k[1] for k in own], pa.int64()), pa.array(list(own.values()), pa.binary())],
                ["h1", "h2", "text"])

    return run


def line_links(docs: DataFrame, firsts: DataFrame, edits: int = EDITS, min_near: int = MIN_NEAR, most: int = MOST,
               block_rows: int = BLOCK_ROWS, send_ids: int = SEND_IDS) -> DataFrame:
    """h1, h2, links, near: lines with another line within ``edits``, the number of those lines, whether one occurs first before it.

    ``firsts`` has each line's first place (h1, h2, first: struct of last, doc_id, body, n).
    """
    if min_near <= edits:
        raise ValueError("a line must be longer than the edits it may have")
    met = candidates(docs, edits, min_near, most, block_rows).withColumn("id", F.expr("shiftright(line, 2)"))
    ids = met.select("id").distinct()
    wanted = np.sort(ids.limit(send_ids + 1).toArrow().column(0).to_numpy())
    lines = docs.select("text").mapInArrow(
        _texts_of(min_near, wanted if len(wanted) <= send_ids else None), "h1 long, h2 long, text binary")
    lines = (lines.withColumn("id", F.expr("shiftright(h1, 2)")).join(ids, "id", "left_semi").distinct()
             .join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).select("id", "h1", "h2", "text", "first.*"))
    lines = stored(lines, "line-texts")
    found = (met.join(lines, "id").select("cell", "key", "line", "h1", "h2", "text", "last", "doc_id", "body", "n")
             .repartition("cell").sortWithinPartitions("cell").mapInArrow(_verify(edits), "h1 long, h2 long, links long, near boolean"))
    return stored(found.groupBy("h1", "h2").agg(F.sum("links").alias("links"), F.max("near").alias("near")), "line-links")


# --- decisions -----------------------------------------------------------------------------------------------

def _occurrences(min_equal: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[list] = [[], [], [], [], []]
            for doc, body, text in zip(*(c.to_pylist() for c in batch.columns)):
                for n, line in enumerate(split_lines(text)):
                    if len(line) >= min_equal:
                        for x, v in zip(out, (doc, body, n, *line_key(line))):
                            x.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int32() if i == 2 else pa.int64()) for i, x in enumerate(out)], ["doc_id", "body", "n", "h1", "h2"])

    return run


def line_decisions(docs: DataFrame, edits: int = EDITS, min_equal: int = MIN_EQUAL, min_near: int = MIN_NEAR, **limits) -> DataFrame:
    """doc_id, body (hash of the text), drop (numbers of the lines that go), n_equal, n_near, n_links: for documents with any.

    n_links counts the links of the document's lines to different lines. Rows
    that repeat a doc_id and its text share a decision. Null ids come last in
    the order.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("body"), "text")
    seen = stored(keyed.mapInArrow(_occurrences(min_equal), "doc_id long, body long, n int, h1 long, h2 long"), "line-occurrences")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "body", "n")
    lines = stored(seen.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")), "lines")
    near = line_links(docs, lines, edits, min_near, **limits)
    touched = (lines.join(near, ["h1", "h2"], "left").filter("copies > 1 or links is not null")
               .select("h1", "h2", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("near", F.lit(False)).alias("near")))
    marked = seen.join(touched, ["h1", "h2"]).withColumn("equal", ~place.eqNullSafe(F.col("first")))
    return (marked.groupBy("doc_id", "body").agg(
        F.array_sort(F.collect_set(F.when(F.col("equal") | F.col("near"), F.col("n")))).alias("drop"),
        F.count_distinct(F.when(F.col("equal"), F.col("n"))).alias("n_equal"),
        F.count_distinct(F.when(~F.col("equal") & F.col("near"), F.col("n"))).alias("n_near"),
        F.sum("links").alias("links_of_rows"), F.count(F.lit(1)).alias("lines_of_rows"),
        F.count_distinct("n").alias("lines")).select(
            "doc_id", "body", "drop", "n_equal", "n_near",
            # rows that repeat a document bring each of its lines as often as they are
            F.expr("links_of_rows div (lines_of_rows div lines)").alias("n_links")))


def _rewrite(at: int, counts: bool):
    """Texts (column ``at``) without the lines numbered in the last column; with ``counts``, the number of lines they had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, sizes = [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = [] if text is None else text.split("\n")
                sizes.append(len(lines))
                if drop:
                    gone = set(drop)
                    text = "\n".join(line for n, line in enumerate(lines) if n not in gone)
                texts.append(text)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            if counts:
                columns.append(pa.array(sizes, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    return run


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_equal: int = MIN_EQUAL, min_near: int = MIN_NEAR,
                counts: bool = True, **limits) -> DataFrame:
    """``docs`` with its texts without the lines that go, and n_lines, n_equal, n_near, n_links (replaced if they are there).

    One row per input row; a null text stays null and has no lines. The lines
    that stay are unchanged. Without ``counts``, the columns of ``docs`` and no
    others. Columns beside doc_id and text may have any name.
    """
    added = ["n_equal", "n_near", "n_links"] if counts else []
    names = [c for c in docs.columns if not counts or c.lower() not in ("n_lines", *added)]

    def free(name: str) -> str:
        while name in (c.lower() for c in docs.columns):
            name += "_"
        return name

    of_id, of_body, drop, body = free("_id"), free("_body"), free("_drop"), free("_key")
    own_names = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    decided = (line_decisions(docs, edits, min_equal, min_near, **limits)
               .select(F.col("doc_id").alias(of_id), F.col("body").alias(of_body), F.col("drop").alias(drop), *added))
    own = docs.select(*own_names).withColumn(body, F.xxhash64("text"))
    joined = (own.join(decided, F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (F.col(body) == F.col(of_body)), "left")
              .select(*own_names, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in added], drop))
    # By place while Arrow has them: it takes no dots in names.
    kept = [*names, *added, *(["n_lines"] if counts else [])]
    fields = [*joined.schema.fields[:-1], *([T.StructField("n_lines", T.LongType())] if counts else [])]
    numbered = [f"c{i}" for i in range(len(fields))]
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(numbered, fields)])
    rewritten = joined.toDF(*numbered[:len(names) + len(added)], "drop").mapInArrow(_rewrite(names.index("text"), counts), schema)
    return rewritten.toDF(*kept)


def op3_line_dedup(spark, sf_dir):
    """doc_id, n_lines, n_equal, n_near, n_links, kept_sha256 (of the text that is left; null text: null)."""
    return (dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_lines", "n_equal", "n_near", "n_links", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")))


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, n, ls[n] AS raw,
         trim(translate(ls[n], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \t\r\x0b\x0c') AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS n FROM d)),
u AS (SELECT line, strlen(line) AS size, min((doc_id, n)) AS first FROM l WHERE strlen(line) >= 1 GROUP BY line),
near AS (
  SELECT a.line, b.first AS other FROM u a JOIN u b
    ON a.size >= 40 AND b.size BETWEEN greatest(40, a.size - 2) AND a.size + 2 AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) <= 2),
w AS (
  SELECT u.line, u.first, count(other) AS links, coalesce(min(other) < u.first, false) AS near
  FROM u LEFT JOIN near ON near.line = u.line GROUP BY u.line, u.first),
m AS (
  SELECT l.doc_id, l.n, l.raw, coalesce((l.doc_id, l.n) <> w.first, false) AS eq, coalesce(w.near, false) AS nr, coalesce(w.links, 0) AS links
  FROM l LEFT JOIN w ON w.line = l.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (eq)::BIGINT AS n_equal, count(*) FILTER (nr AND NOT eq)::BIGINT AS n_near,
       sum(links)::BIGINT AS n_links,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY n) FILTER (NOT eq AND NOT nr), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
