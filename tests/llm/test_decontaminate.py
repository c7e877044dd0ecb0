import hashlib
import random
import re

import pytest

from valorem.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        if n and item is not None:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def made(rng, n):
    return [rng.choice(["ab", "Cd", "é9", "x", "Ünd", "of"]) + rng.choice(["", "1", "z", "ñ"]) for _ in range(n)]


@pytest.mark.parametrize("block, bitmap_rows", [(1 << 20, 1 << 20), (200, 1 << 20), (1 << 20, 0)])
def test_against_brute_force(spark, monkeypatch, block, bitmap_rows):
    monkeypatch.setattr(dc, "BLOCK", block)
    monkeypatch.setattr(dc, "BITMAP_ROWS", bitmap_rows)
    pieces = dc.text_pieces
    monkeypatch.setattr(dc, "text_pieces", lambda t, size=None: pieces(t, size or block))
    rng = random.Random(block + bitmap_rows)
    items = [(i, ", ".join(made(rng, rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 30, 60])))) for i in range(30)]
    items += [(3, "one more text of item three with enough words to be a window"), (90, items[4][1]), (91, None), (92, "?!"),
              (None, "an item without an id is no item at all and so it is left out"), (93, "tic tic tic tic tic tic tic tic tic tic tic tic")]
    docs = [(1, None), (2, ""), (3, "tic " * 40), (3, "tic " * 9), (None, "tic " * 10), (5, "... !")]
    for i in range(60):
        own = made(rng, rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1] or ""
            w = w.replace(",", rng.choice(["", ",\n", " -"])).split(" ")
            a = rng.randrange(len(w))
            at = rng.randint(0, len(own))
            own[at:at] = w[a:a + rng.randint(1, 40)]
        docs.append((100 + i, rng.choice([str.upper, str])(" ".join(own))))
    d = spark.createDataFrame([(*r, 1, "c") for r in docs], "doc_id long, text string, h int, context string").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, size int")
    got = sorted((tuple(r) for r in dc.contamination(d, b).drop("body").collect()), key=str)
    assert got == plain(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert sorted(tuple(r) for r in dc.contamination(d, b).drop("body").collect()) == plain([(1, "some words"), (2, None)], [])
    assert dc.contamination(d.filter("false"), b).collect() == []
