import hashlib
import random
import zlib

import pytest

from valorem.llm import prefix_trie as pt


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    members, ends = {}, {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
        ends.setdefault(tuple(t), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    totals = {}
    for k in sorted(members, key=len, reverse=True):
        below = [totals[x] for x in children.get(k, [])]
        own = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        totals[k] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), *totals[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, m in members.items()), key=str)


def made(rng, n, common=0.3):
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randint(0, 400), rng.randint(0, 5) * 100, rng.randint(100, 120)])
        for t in range(rng.randint(0, 9)):
            text = "same" if rng.random() < common else rng.choice(["a", "bé", "", None, "long " * 3])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None, "assistant"]), text))
    rows += [(None, 1, "user", "no conversation"), (7, None, None, None), (200, 1, "user", None), (200, 1, "user", None)]
    rows += [(555, i, "user", f"t{i % 3}") for i in range(300)]
    rows += [(556, i, "user", f"t{i % 3}") for i in range(300)] + [(500, i, "user", f"t{i % 3}") for i in range(290)]
    rows += [(c, 0, "user", "one turn") for c in range(1000, 1200)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, key int, depth string"


@pytest.mark.parametrize("shard, queue, piece", [(10_000, 200_000, 2_000), (5, 3, 2), (40, 1, 7)])
def test_against_brute_force(spark, tmp_path, monkeypatch, shard, queue, piece):
    monkeypatch.setattr(pt, "SHARD_NODES", shard)
    monkeypatch.setattr(pt, "QUEUE", queue)
    monkeypatch.setattr(pt, "PIECE", piece)
    rows = made(random.Random(shard), 150)
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = pt.op13_prefix_trie(spark, str(tmp_path)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_queue_spills_in_order():
    rng = random.Random(3)
    queue, held = pt.SpillingQueue(10), []
    for _ in range(3000):
        if held and rng.random() < 0.45:
            assert queue.peek() == min(held)
            item = queue.pop()
            assert item == min(held)
            held.remove(item)
        else:
            item = (rng.randint(0, 500), rng.randint(0, 10 ** 9))
            queue.push(item)
            held.append(item)
    assert [queue.pop() for _ in range(len(held))] == sorted(held)
    assert queue.peek() is None


def test_time_forward_with_a_spilling_queue():
    import pyarrow as pa
    # a root of 30 children, each of two leaves
    rows = [(0, b"r", None, 0, 60, 0, 0, 0, True)]
    rows += [(1, b"c%02d" % i, b"r", i * 2, 2, 5, 0, 0, False) for i in range(30)]
    rows += [(2, b"l%02d%d" % (i, j), b"c%02d" % i, i * 2 + j, 1, 0, 0, 1, False) for i in range(30) for j in range(2)]
    rows.sort(key=lambda r: (-r[0], r[1]))
    types = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.bool_()]
    batches = [pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[a:a + 7]), types)], [*pt._STATE, "top"])
               for a in range(0, len(rows), 7)]
    out = [r for b in pt.time_forward(iter(batches), 2) for r in b.to_pylist()]
    assert len(out) == 91
    root = next(r for r in out if r["depth"] == 0)
    assert (root["n_children"], root["n_leaves"], root["saved"]) == (30, 60, 150)
    assert all(r["n_children"] == 2 and r["parent_conv_id"] == 0 for r in out if r["depth"] == 1)
    assert all(r["parent_conv_id"] == r["conv_id"] // 2 * 2 for r in out if r["depth"] == 2)


def test_long_conversation_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, i, "user", str(i)) for i in range(500)] + [(c, 0, "user", "0") for c in range(2, 5)]
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
        got = {(r.conv_id, r.pos): r.key for r in pt.prefix_keys(turns).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, power = 0, 1
    for i in range(500):
        total, power = (total + pt._digest("user", str(i)) * power) % pt.P, power * pt.BASE % pt.P
        assert int.from_bytes(got[1, i], "big") == total
    assert {got[c, 0] for c in range(1, 5)} == {got[1, 0]}


def test_conversations_as_they_are_and_empty(spark):
    turns = spark.createDataFrame([(1, 0, "u", "abc"), (2, 0, "u", "abc"), (2, 1, "u", "d")], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in pt.trie(turns).collect()}
    assert got == {(1, 0): (None, 2, 1, 1, 3), (1, 1): (1, 2, 1, 1, 3), (2, 2): (1, 1, 0, 1, 0)}
    assert pt.trie(turns.filter("false")).collect() == []
