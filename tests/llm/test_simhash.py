import random

import numpy as np
import pytest
import xxhash

from valorem.llm import simhash


def plain_fingerprint(text, words=3):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i:i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=3):
    """fingerprint -> representative, by comparing every pair."""
    fps = sorted(set(prints))
    arr = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= max_bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {f: fps[find(i)] for i, f in enumerate(fps)}


def expected(rows):
    prints = {i: plain_fingerprint(t) for i, (_, t) in enumerate(rows)}
    root = plain_components(prints.values())
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root[prints[i]]
            least[r] = min(least.get(r, doc), doc)
    return sorted(((doc, f"{prints[i]:016x}", least.get(root[prints[i]])) for i, (doc, _) in enumerate(rows)), key=str)


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "two words", "a b c", "É É É é", "x\x85y z w", "\x1fodd sep"]
    texts += [" ".join(rng.choice(["ab", "Cd", "é", "f", "gh"]) for _ in range(n)) for n in (4, 300, 700, 2000)]
    got = simhash.fingerprints([None if t is None else t.encode() for t in texts])
    assert [int(g) for g in got] == [plain_fingerprint(t) for t in texts]


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(str(i * 7919 % 1013) for i in range(5000))
    whole = simhash.fingerprints([text.encode()])
    monkeypatch.setattr(simhash, "text_pieces", lambda t: __import__("valorem.llm.common", fromlist=["x"]).text_pieces(t, 97))
    monkeypatch.setattr(simhash, "BLOCK", 50)
    assert whole == simhash.fingerprints([text.encode()]) == plain_fingerprint(text)


def test_whole_table_against_brute_force(spark):
    from valorem.llm.common import table
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in simhash.op4_simhash(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == expected(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "same words here again"), (3, "same words here again"), (None, "Same words HERE again"),
            (7, "one"), (5, "one"), (9, "\n"), (4, "w " * 30000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, key int")
    got = sorted((tuple(r) for r in simhash.simhash_groups(docs).collect()), key=str)
    assert got == expected(rows)
    assert simhash.simhash_groups(docs.filter("false")).collect() == []


@pytest.mark.parametrize("most", [4096, 20, 3])
def test_links_of_crowded_balls(spark, most):
    """Many fingerprints within few bits: the common signatures are split by further levels, no component is lost."""
    rng = random.Random(5)
    fps = set()
    for centre in (rng.getrandbits(64), rng.getrandbits(64), 0):
        for _ in range(150):
            f = centre
            for _ in range(rng.randint(0, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = simhash.near_links(frame, 3, most)
    got = {}
    for r in simhash.components(links).collect():
        got.setdefault(r.root, set()).add(int(np.int64(r.node).view(np.uint64)))
    want = {}
    for f, r in plain_components(fps).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


@pytest.mark.parametrize("task_rows", [100_000, 40])
def test_small_tables_in_few_files(spark, monkeypatch, task_rows):
    """Tables of keys are written in files for their rows, not one for each shuffle partition."""
    from valorem.llm import common, components
    many = spark.newSession()
    many.conf.set("spark.sql.shuffle.partitions", "40")
    many.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(common, "TASK_ROWS", task_rows)
    written = {}

    def stored(df, name, **more):
        out = common.stored(df, name, **more)
        written.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(simhash, "stored", stored)
    monkeypatch.setattr(components, "stored", stored)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words) + f" x{i}" if i % 2 else " ".join(rng.choices(words, k=60))) for i in range(200)]
    docs = many.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    got = simhash.simhash_groups(docs)
    most = -(-200 // task_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert got.rdd.getNumPartitions() <= most
    left = simhash.one_per_group(docs)
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in want})
    assert len(written["components"]) > 3 and max(written["simhash-groups"] + written["simhash-gone"]) <= most
    assert max(written["components"]) == 1 or task_rows < 200
