import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from valorem.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.binary(max_size=90), st.lists(st.tuples(st.integers(0, 90), st.sampled_from("idr"), st.integers(0, 255)), max_size=5), st.integers(0, 4))
def test_automaton_is_the_edit_distance(a, changes, edits):
    b = bytearray(a)
    for at, kind, byte in changes:
        at = min(at, len(b))
        b[at:at + (kind != "i")] = bytes([byte]) if kind != "d" else b""
    want = distance(a, bytes(b))
    assert ld.within_edits(a, bytes(b), edits) == (want if want <= edits else None)
    assert ld.within_edits(b"", a, edits) == (len(a) if len(a) <= edits else None)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=8, max_size=60), st.lists(st.tuples(st.integers(0, 60), st.sampled_from("idr"), st.integers(97, 99)), max_size=3))
def test_lines_within_the_edits_share_a_key_and_pass_the_sketch(a, changes):
    b = bytearray(a)
    for at, kind, byte in changes:
        at = min(at, len(b))
        b[at:at + (kind != "i")] = bytes([byte]) if kind != "d" else b""
    b = bytes(b)
    if a == b or len(b) < 5 or distance(a, b) > 3:
        return
    rows = ld.segment_rows([a, b, b"another line in between"], np.array([4, 8, 12]), 3)
    pairs = {frozenset((rows[1, np.stack(x)] >> 2)[:, i].tolist()) for x in ld.meetings(*rows, 3) for i in range(len(x[0]))}
    assert frozenset((1, 2)) in pairs


def plain(rows, edits, min_equal, min_near):
    places = {}
    occurrences = []
    for r, (doc, text) in enumerate(rows):
        for n, line in enumerate(ld.split_lines(text) if text is not None else []):
            place = (doc is None, doc or 0, ld_body(text), n)
            occurrences.append((r, n, line, place))
            if len(line) >= min_equal:
                places[line] = min(places.get(line, place), place)
    near = {a: [b for b in places if a != b and min(len(a), len(b)) >= min_near and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits] for a in places}
    out = []
    for r, (doc, text) in enumerate(rows):
        lines = [] if text is None else text.split("\n")
        n_equal = n_near = n_links = 0
        kept = []
        for _, n, line, place in (o for o in occurrences if o[0] == r):
            equal = line in places and place != places[line]
            close = not equal and any(places[b] < places[line] for b in near.get(line, []))
            n_equal += equal
            n_near += close
            n_links += len(near.get(line, []))
            if not equal and not close:
                kept.append(lines[n])
        out.append((doc, None if text is None else "\n".join(kept), len(lines), n_equal, n_near, n_links))
    return sorted(out, key=str)


def ld_body(text):
    return BODY[text]


BODY = {}


@pytest.mark.parametrize("most, block_rows, send_ids", [(4000, 1000, 1 << 20), (6, 3, 1 << 20), (4000, 1000, 3)])
def test_against_brute_force(spark, most, block_rows, send_ids):
    rng = random.Random(most + send_ids)
    base = ["".join(rng.choice("abc de") for _ in range(rng.choice([5, 11, 14, 25, 60]))).strip() for _ in range(25)]
    base += ["the same long line that many documents hold, twice or more", "Prefix shared by a crowd of lines ", "É" * 12, "x" * 50]

    def variant(line):
        line = list(line)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(line))
            line[at:at + rng.randint(0, 1)] = rng.choice(["", "z", "é", "Q"])
        return "".join(line)

    rows = [(i, "\n".join(variant(rng.choice(base)) if rng.random() < 0.7 else rng.choice(base) for _ in range(rng.randint(0, 9)))) for i in range(50)]
    rows += [(100 + i, f"Prefix shared by a crowd of lines {i:03d}") for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (7, "another text of document seven, long enough\n\n"), (8, None), (9, ""), (None, None), (300, " \n" * 5 + "z" * 3000)]
    docs = spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, text string, n_links int, line string").repartition(3)
    BODY.update({r.text: r.body for r in docs.selectExpr("text", "xxhash64(text) body").collect()})
    got = ld.dedup_lines(docs, 2, 8, 12, most=most, block_rows=block_rows, send_ids=send_ids)
    assert got.columns == ["doc_id", "text", "line", "n_equal", "n_near", "n_links", "n_lines"]
    got = sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_equal", "n_near", "n_links").collect()), key=str)
    assert got == plain(rows, 2, 8, 12)


@pytest.mark.parametrize("most, block_rows", [(4000, 1000), (50, 20)])
def test_rows_grow_with_the_lines_of_a_group(spark, most, block_rows):
    docs = spark.createDataFrame([(i, f"one of very many lines that are nearly the same, {i:03d}") for i in range(200)], "doc_id long, text string").repartition(4)
    met = ld.candidates(docs, most=most, block_rows=block_rows)
    assert met.select("cell", "line").distinct().count() == met.count()
    if most > 200:
        assert met.count() <= 200 * len(ld.segment_rows([b"x" * 53], np.array([4]), ld.EDITS)[0])
    lines = {f"one of very many lines that are nearly the same, {i:03d}".encode() for i in range(200)}
    want = {i: sum(distance(b"%03d" % i, b"%03d" % j) <= ld.EDITS for j in range(200)) - 1 for i in range(200)}
    got = ld.dedup_lines(docs, most=most, block_rows=block_rows).collect()
    assert {r.doc_id: r.n_links for r in got} == want and len(lines) == 200
    assert {r.doc_id: r.n_near for r in got} == {i: int(any(distance(b"%03d" % i, b"%03d" % j) <= ld.EDITS for j in range(i))) for i in range(200)}


def test_any_names_of_other_columns(spark):
    names = ["doc_id", "text", "_id", "_body", "_drop", "_KEY", "body", "h1", "n", "a.b", "n_lines", "score"]
    docs = spark.createDataFrame([(1, "twice\nonce", *names[2:]), (2, "Twice\nalone", *names[2:])], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names[2:]))
    got = ld.dedup_lines(docs, counts=False)
    assert got.columns == names
    assert sorted(tuple(r) for r in got.collect()) == [(1, "twice\nonce", *names[2:]), (2, "alone", *names[2:])]
    counted = ld.dedup_lines(docs)
    assert counted.columns == [c for c in names if c != "n_lines"] + ["n_equal", "n_near", "n_links", "n_lines"]
    assert sorted((r.doc_id, r.n_lines, r.n_equal, r._id) for r in counted.collect()) == [(1, 2, 0, "_id"), (2, 2, 1, "_id")]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_lines(docs).collect() == []


def test_key_is_md5(spark):
    line = "Ünï line".encode()
    assert b"".join(int(x).to_bytes(8, "little", signed=True) for x in ld.line_key(line)) == hashlib.md5(line).digest()
