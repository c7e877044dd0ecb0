"""Trie of conversation prefixes, totals by time-forward processing.

Turns become a table (conversation, depth, key), where the key of a prefix is
sum(t_i * BASE^i) modulo 2^127 - 1 over its turns, t_i being a digest of role
and text. Such sums can be added up in parts, so a conversation that holds a
large share of all turns is cut at the bounds of a range partitioning: each
part sums its own turns, and the sums of the parts before it are added after.

Nodes are an aggregate by key (least member, number of members), so a prefix
of very many conversations is one row a task. Nodes of one member are the
chain that ends its conversation and need no totals from others; only the
first of them, as a leaf, and the nodes of two or more members go on:

* within shards: a shard is the subtree of a node at the least depth at which
  it holds at most SHARD_NODES nodes. A task takes its nodes in reverse level
  order (sorted by Spark, which spills) and passes each node's totals to its
  parent through a priority queue that spills to disk;
* across shard roots: what they give is added up by parent (an aggregate),
  and the few nodes above them are processed in the same way.

A node's row is complete when its parent takes its message, so the parent's
id needs no join.

Turns are ordered by turn, role and text, nulls as the least turn and as empty
role or text; equal turns of a conversation are all kept. Rows without
conv_id belong to no conversation. An empty table has no node, not even the
root. Only conv_id, turn, role and text are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.llm.common import doc_crc, small_batches, stored, table

P = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, P)
#: Most turns that a conversation takes from another one.
HEAD = 5
#: Nodes of two or more members in a shard, above which its root goes to the nodes across shards.
SHARD_NODES = 10_000
#: Messages that a priority queue holds in memory.
QUEUE = 200_000
#: Conversation ids in a piece of a node's list of ends.
PIECE = 2_000
ROOT = bytes(16)


# ---------------------------------------------------------------- keys of prefixes

def _digest(role: str, text: str) -> int:
    role = role.encode()
    return int.from_bytes(hashlib.blake2b(len(role).to_bytes(8, "big") + role + text.encode(), digest_size=16).digest(), "big") % P


def _part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv, role, text) -> conv, part, place in the part, sum of t_i * BASE^i from the part's first turn, characters."""
    part = TaskContext.get().partitionId()
    conv, place, total, power = None, 0, 0, 1
    for batch in small_batches(batches, 5000):
        convs, places, sums, chars = batch.column(0).to_pylist(), [], [], []
        for c, role, text in zip(convs, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if c != conv:
                conv, place, total, power = c, 0, 0, 1
            total = (total + _digest(role, text) * power) % P
            places.append(place)
            sums.append(total.to_bytes(16, "big"))
            chars.append(len(text))
            place, power = place + 1, power * BASE % P
        n = len(convs)
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array([part] * n, pa.int32()), pa.array(places, pa.int64()),
                                          pa.array(sums, pa.binary()), pa.array(chars, pa.int64())], ["conv_id", "part", "place", "sum", "chars"])


def _carry(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, [(part, turns, sum)]) -> conv, part, turns before it, their sum, of each conversation in several parts."""
    for batch in small_batches(parts):
        out: list[list] = [[], [], [], []]
        for conv, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before, total = 0, 0
            for p in sorted(own, key=lambda p: p["part"]):
                for column, value in zip(out, (conv, p["part"], before, total.to_bytes(16, "big"))):
                    column.append(value)
                total = (total + pow(BASE, before, P) * int.from_bytes(p["sum"], "big")) % P
                before += p["turns"]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.binary())], ["conv_id", "part", "before", "carry"])


def _add_carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, place, sum, chars, turns before, their sum) -> conv, pos, key, chars."""
    for batch in small_batches(batches, 5000):
        place, total, before, carry = (batch.column(i).to_pylist() for i in (1, 2, 4, 5))
        pos = [p + (b or 0) for p, b in zip(place, before)]
        key = [s if b is None else ((int.from_bytes(c, "big") + pow(BASE, b, P) * int.from_bytes(s, "big")) % P).to_bytes(16, "big")
               for s, b, c in zip(total, before, carry)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pos, pa.int64()), pa.array(key, pa.binary()), batch.column(3)],
                                         ["conv_id", "pos", "key", "chars"])


def prefix_keys(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), key of the conversation's first pos + 1 turns, chars: code points of the turn's text. Stored."""
    own = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                     F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    sums = stored(own.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
                  .mapInArrow(_part_sums, "conv_id long, part int, place long, sum binary, chars long"), "trie-sums")
    parts = (sums.groupBy("conv_id", "part").agg(F.max(F.struct("place", "sum")).alias("last"))
             .groupBy("conv_id").agg(F.collect_list(F.struct("part", (F.col("last.place") + 1).alias("turns"), "last.sum")).alias("parts"))
             .filter("size(parts) > 1"))
    # at most one conversation for each bound between partitions
    carry = F.broadcast(parts.mapInArrow(_carry, "conv_id long, part int, before long, carry binary"))
    return stored(sums.join(carry, ["conv_id", "part"], "left").select("conv_id", "place", "sum", "chars", "before", "carry")
                  .mapInArrow(_add_carry, "conv_id long, pos long, key binary, chars long"), "trie-keys")


# ---------------------------------------------------------------- rebuilt conversations

def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, pos, key, chars, len, h, used, key of the h own turns, key of the used turns) -> conv, depth, key, chars, len."""
    for batch in small_batches(batches, 5000):
        conv, pos, key, chars, length, h, used, own, other = (c.to_pylist() for c in batch.columns)
        keys = []
        for k, n, u, a, b in zip(key, h, used, own, other):
            if a == b and n == u:
                keys.append(k)
                continue
            rest = int.from_bytes(k, "big") - int.from_bytes(a, "big")
            shift = pow(_INVERSE, n - u, P) if n > u else 1
            keys.append(((int.from_bytes(b, "big") + rest * shift) % P).to_bytes(16, "big"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p - n + u + 1 for p, n, u in zip(pos, h, used)], pa.int64()),
                                          pa.array(keys, pa.binary()), batch.column(3), batch.column(4)],
                                         ["conv_id", "depth", "key", "chars", "len"])


def rebuilt(keys: DataFrame, head: Column, base: Column) -> DataFrame:
    """conv_id, depth, key, chars, len of every prefix of every rebuilt conversation, depth 0 included. Stored.

    ``head`` (0 to HEAD) is the number of first turns that are taken from the
    conversation ``base`` instead; both are expressions of conv_id.
    """
    # the keys and characters of a conversation's first turns, by number of turns
    first = [F.max(F.when(F.col("pos") == i, F.struct("key", "chars"))) for i in range(HEAD)]
    convs = keys.groupBy("conv_id").agg(F.count("*").alias("own"), F.array(F.struct(F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("chars")),
                                                                             *first).alias("first"))
    convs = stored(convs.withColumn("h", head.cast("int")).withColumn("base", base.cast("long")), "trie-convs")
    bases = convs.join(convs.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi").select(
        F.col("conv_id").alias("base"), F.col("own").alias("of_base"), F.col("first").alias("first_of_base"))
    told = (convs.join(bases, "base", "left")
            .withColumn("used", F.least("h", F.coalesce("of_base", F.lit(0))).cast("int"))
            .withColumn("len", F.col("used") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
            .withColumn("taken", F.expr("slice(coalesce(first_of_base, first), 1, used + 1)")))
    told = stored(told.select("conv_id", "len", "h", "used", "taken", F.expr("if(own >= h, first[h].key, null)").alias("own_key"),
                              F.expr("element_at(taken, -1).key").alias("taken_key")), "trie-heads")
    heads = told.select("conv_id", F.posexplode("taken").alias("depth", "t"), "len").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "t.key", "t.chars", "len")
    tails = (keys.join(told, "conv_id").filter("pos >= h")
             .select("conv_id", "pos", "key", "chars", "len", "h", "used", "own_key", "taken_key")
             .mapInArrow(_moved, "conv_id long, depth long, key binary, chars long, len long"))
    return stored(heads.unionByName(tails), "trie-prefixes")


# ---------------------------------------------------------------- ends

def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv) -> key, first conv, up to ``size`` ids joined by a comma."""
    key, ids = None, []
    for batch in small_batches(batches, 5000):
        out = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key or len(ids) == size:
                if ids:
                    out.append((key, ids[0], ",".join(map(str, ids))))
                key, ids = k, []
            ids.append(c)
        yield _piece_rows(out)
    if ids:
        yield _piece_rows([(key, ids[0], ",".join(map(str, ids)))])


def _piece_rows(rows: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.string())], ["key", "first", "ids"])


def _ends_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (key, first) -> key, SHA-256 of its pieces joined by a comma: one piece in memory at a time."""
    def digests():
        rows = ((k, i) for b in small_batches(batches) for k, i in zip(b.column(0).to_pylist(), b.column(2).to_pylist()))
        for key, own in itertools.groupby(rows, key=lambda r: r[0]):
            sha = hashlib.sha256(next(own)[1].encode())
            for _, ids in own:
                sha.update(b"," + ids.encode())
            yield key, sha.hexdigest()

    rows = digests()
    while some := list(itertools.islice(rows, 5000)):
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.binary()), pa.array([r[1] for r in some], pa.string())],
                                         ["key", "ends_sha256"])


def ends(prefixes: DataFrame) -> DataFrame:
    """key, ends_sha256 of the nodes at which conversations end."""
    own = prefixes.filter("depth = len").select("key", "conv_id")
    pieces = own.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(partial(_pieces, size=PIECE), "key binary, first long, ids string")
    return (pieces.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(_ends_digest, "key binary, ends_sha256 string"))


# ---------------------------------------------------------------- time-forward processing

class SpillingQueue:
    """Priority queue of tuples. Above ``most`` in memory, they go to a sorted file, which is gone when it is closed."""

    def __init__(self, most: int):
        self.most, self.heap, self.runs, self.heads = most, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            file = tempfile.TemporaryFile()
            for at in range(0, len(self.heap), 1000):
                if at == 0:
                    self.heap.sort()
                pickle.dump(self.heap[at:at + 1000], file, pickle.HIGHEST_PROTOCOL)
            file.seek(0)
            self.heap = []
            self.runs.append(self._read(file))
            heapq.heappush(self.heads, (next(self.runs[-1]), len(self.runs) - 1))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def peek(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if not self.heads or (self.heap and self.heap[0] <= self.heads[0][0]):
            return heapq.heappop(self.heap)
        item, run = self.heads[0]
        following = next(self.runs[run], None)
        if following is None:
            heapq.heappop(self.heads)
        else:
            heapq.heapreplace(self.heads, (following, run))
        return item


#: A node for time-forward processing: children and leaves that are known already, saved of its own and of those.
_STATE = ["depth", "key", "parent", "conv_id", "n_convs", "saved", "n_children", "n_leaves"]
STATE = "depth long, key binary, parent binary, conv_id long, n_convs long, saved long, n_children long, n_leaves long"
DONE = STATE + ", parent_conv_id long, to_parent boolean"


def time_forward(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Nodes by (depth descending, key), with a last column ``top``: its parent is not among them -> complete nodes.

    A message to a parent is the child's whole row under (-parent's depth,
    parent's key), the order in which nodes come. Nodes on ``top`` come out with to_parent.
    """
    queue, out = SpillingQueue(most), []
    for batch in small_batches(batches, 5000):
        for depth, key, parent, conv, n, saved, children, leaves, top in zip(*(c.to_pylist() for c in batch.columns)):
            while (message := queue.peek()) is not None and message[:2] == (-depth, key):
                child = queue.pop()[2]
                children, leaves, saved = children + 1, leaves + child[7], saved + child[5]
                out.append((*child, conv, False))
            row = (depth, key, parent, conv, n, saved, children, leaves or 1)
            if top:
                out.append((*row, None, True))
            else:
                queue.push((1 - depth, parent, row))
        yield _done(out)
        out = []


def _done(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.bool_()]
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], [*_STATE, "parent_conv_id", "to_parent"])


def _shards(state: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``state`` with ``shard``: key of the shard's root, null for the nodes above all shards, and ``root_depth``. Stored.

    Depth by depth (from 8 on doubling) the subtrees that are small enough become shards.
    """
    left = state.withColumn("shard", F.when(F.col("depth") == 0, None).otherwise(F.lit(ROOT)))
    done, depth = left.filter("depth = 0").withColumn("shard", F.lit(None).cast("binary")).withColumn("root_depth", F.lit(None).cast("long")), 1
    left = state.filter("depth > 0")
    while True:
        # a node's ancestor at this depth is that of its least member
        at = prefixes.filter(F.col("depth") == depth).select("conv_id", F.col("key").alias("shard"))
        below = left.join(at, "conv_id", "left").withColumn("shard", F.when(F.col("depth") >= depth, F.col("shard")))
        large = stored(below.filter("shard is not null").groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_NODES)
                       .select("shard"), "trie-large")
        if large.isEmpty():
            return stored(done.unionByName(below.withColumn("root_depth", F.when(F.col("shard").isNotNull(), F.lit(depth).cast("long")))), "trie-shards")
        # (at most 1 / SHARD_NODES of the nodes are such roots)
        split = below.join(large.withColumn("split", F.lit(True)), "shard", "left")
        now = split.filter("split is null").drop("split")
        done = done.unionByName(now.withColumn("root_depth", F.when(F.col("shard").isNotNull(), F.lit(depth).cast("long"))))
        roots = split.filter("split").filter(F.col("depth") == depth).drop("split").withColumn("shard", F.lit(None).cast("binary"))
        done = stored(done.unionByName(roots.withColumn("root_depth", F.lit(None).cast("long"))), "trie-shards")
        left = stored(split.filter("split").filter(F.col("depth") > depth).drop("split", "shard"), "trie-left")
        depth = depth + 1 if depth < 8 else depth * 2


def trie(turns: DataFrame, head: Column | None = None, base: Column | None = None) -> DataFrame:
    """Nodes: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``head`` and ``base`` as for rebuilt(); without them conversations stay as they are.
    """
    prefixes = rebuilt(prefix_keys(turns), F.lit(0) if head is None else head, F.col("conv_id") if base is None else base)
    # a prefix's parent: the prefix of one turn less in its least member
    nodes = stored(prefixes.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")),
                   "trie-nodes")
    shared = nodes.filter("n_convs > 1 or depth = 0")
    single = nodes.filter("n_convs = 1 and depth > 0")
    # the end of a conversation that no other one shares
    tails = stored(single.groupBy("conv_id").agg(F.min(F.struct("depth", "key")).alias("at"), F.max("depth").alias("last"))
                   .select("conv_id", "at.*", "last"), "trie-tails")
    inner = (single.select("conv_id", "depth", "key").join(tails.select("conv_id", F.col("depth").alias("from"), "last"), "conv_id")
             .filter("depth > from")
             .select("key", "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                     (F.col("depth") < F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                     F.lit(0).cast("long").alias("saved_tokens")))
    up = prefixes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"))
    zero = F.lit(0).cast("long")
    state = (shared.select("conv_id", "depth", "key", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                           zero.alias("n_children"), zero.alias("n_leaves"))
             .unionByName(tails.select("conv_id", "depth", "key", F.lit(1).cast("long").alias("n_convs"), zero.alias("saved"),
                                       (F.col("depth") < F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves")))
             .join(up, ["conv_id", "depth"], "left"))
    sharded = _shards(stored(state.select(*_STATE), "trie-state"), prefixes)
    within = stored(sharded.filter("shard is not null").repartition("shard").withColumn("top", F.col("depth") == F.col("root_depth"))
                    .sortWithinPartitions(F.desc("depth"), "key").select(*_STATE, "top").mapInArrow(partial(time_forward, most=QUEUE), DONE), "trie-within")
    roots = within.filter("to_parent")
    sums = roots.groupBy("parent").agg(F.sum("saved").alias("s"), F.count("*").alias("c"), F.sum("n_leaves").alias("l"))
    above = (sharded.filter("shard is null").join(sums.withColumnRenamed("parent", "key"), "key", "left")
             .select("depth", "key", sharded["parent"], "conv_id", "n_convs", (F.col("saved") + F.coalesce("s", zero)).alias("saved"),
                     (F.col("n_children") + F.coalesce("c", zero)).alias("n_children"), (F.col("n_leaves") + F.coalesce("l", zero)).alias("n_leaves"),
                     (F.col("depth") == 0).alias("top")))
    # the nodes above shards: the root, and roots of subtrees of over SHARD_NODES nodes
    across = stored(above.repartition(1).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(partial(time_forward, most=QUEUE), DONE), "trie-across")
    known = roots.drop("parent_conv_id").join(across.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", "left")
    done = (within.filter("not to_parent").unionByName(known).unionByName(across)
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens")))
    none = hashlib.sha256(b"").hexdigest()
    return (done.unionByName(inner).join(ends(prefixes), "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations whose first crc32(conv_id) mod 6 turns are those of the first conversation of their hundred."""
    conv = F.col("conv_id")
    return trie(table(spark, sf_dir, "conversations"), doc_crc(conv) % 6, conv - conv % 100)


#: Prefixes as chains of md5; totals by joining every node to the path of its least member.
SQL = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         md5(coalesce(role, '')) || md5(coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)), lambda r, x: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)
), parts AS (
  SELECT convs.c, 0 AS o, pos, t, chars FROM convs JOIN turns ON turns.c = convs.base AND pos <= h
  UNION ALL
  SELECT convs.c, 1 AS o, pos, t, chars FROM convs JOIN turns USING (c) WHERE pos > h
), numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY o, pos) AS d, t, chars FROM parts
), prefixes AS (
  SELECT c, d, md5(string_agg(t, '') OVER (PARTITION BY c ORDER BY d)) AS k, chars FROM numbered
  UNION ALL
  SELECT c, 0, 'root', 0 FROM convs
), lengths AS (
  SELECT c, max(d) AS len FROM prefixes GROUP BY c
), nodes AS (
  SELECT k, d, min(c) AS c, count(*) AS n, max(chars) AS chars,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '') AS ends
  FROM prefixes JOIN lengths USING (c) GROUP BY k, d
), parents AS (
  SELECT nodes.k, up.k AS parent FROM nodes JOIN prefixes up ON up.c = nodes.c AND up.d = nodes.d - 1
), children AS (
  SELECT parent AS k, count(*) AS n_children FROM parents GROUP BY parent
), totals AS (
  SELECT up.k, sum(CASE WHEN children.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((nodes.n - 1) * nodes.chars) AS saved
  FROM nodes LEFT JOIN children USING (k) JOIN prefixes up ON up.c = nodes.c AND up.d <= nodes.d GROUP BY up.k
)
SELECT nodes.c AS conv_id, nodes.d::BIGINT AS depth, p.c AS parent_conv_id, nodes.n AS n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN totals USING (k) LEFT JOIN children USING (k) LEFT JOIN parents USING (k) LEFT JOIN nodes p ON p.k = parents.parent
"""
