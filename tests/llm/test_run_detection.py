import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from valorem.llm import run_detection as rd


def plain(w):
    """Every maximal run by definition: stretches of each period, kept when that is their smallest period."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s + q
            while e < n and w[e] == w[e - q]:
                e += 1
            if e - s >= max(24, 3 * q) and not any(all(w[i] == w[i + p] for i in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            s = e - q + 1
    return sorted(out)


def ids(w):
    seen = {}
    return np.array([seen.setdefault(x, len(seen)) for x in w], np.int64)


def made(rng):
    w = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.randrange(5)
        if kind == 0:
            w += [rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randint(0, 60))]
        elif kind == 1:
            w += [rng.choice("ab") for _ in range(rng.randint(0, 120))]
        else:
            base = [rng.choice("abc" if kind == 2 else "abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 40))]
            if kind == 4:
                base = base * rng.randint(1, 4) + ["x"]
            w += (base * 12)[:rng.randint(1, 12 * len(base))]
    return w


@pytest.mark.parametrize("seed", range(120))
def test_against_definition(seed):
    w = made(random.Random(seed))
    assert rd.runs_of(ids(w)) == plain(w)


def test_known_strings():
    assert rd.runs_of(ids(["a"] * 24)) == [(0, 24, 1)]
    assert rd.runs_of(ids(["a"] * 23)) == []
    assert rd.runs_of(ids(list("ab" * 12))) == [(0, 24, 2)]
    assert rd.runs_of(ids([])) == [] and rd.runs_of(ids(["a"])) == []
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    assert rd.runs_of(ids(fib[-1])) == plain(fib[-1])
    long = ["tic"] * 60_000 + ["toc"] + ["tic", "tac"] * 20_000
    assert rd.runs_of(ids(long)) == [(0, 60_000, 1), (60_001, 40_000, 2)]


def test_grammar_gives_the_text_back():
    rng = random.Random(5)
    for _ in range(40):
        w = [rng.randrange(4) for _ in range(rng.randint(2, 300))]
        made_, starts = rd.repair(w)
        for left, size, own in made_:
            assert len(own) > 1 and 0 < left < size
            assert len({tuple(w[p:p + size]) for p in own}) == 1
        assert starts[0] == 0 and starts == sorted(set(starts))


def row(doc_id, text):
    w = (text or "").encode().split()
    index = rd.planted(doc_id, len(w))
    if index is not None:
        w = [w[i] for i in index]
    runs = plain(w)
    keep = [True] * len(w)
    for s, n, q in runs:
        keep[s + q:s + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for x, k in zip(w, keep) if k)).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    docs = [(i, rng.choice([" ", "\t", "\n\n"]).join(made(rng)), "c") for i in range(80)]
    docs += [(1, None, "c"), (2, "", "c"), (3, " \n ", "c"), (None, "é b " * 30, "c"), (4, "é b " * 30, None), (4, "é b " * 30, None),
             (5, "a b " * 30, "c"), (6, None, "c")]
    spark.createDataFrame(docs, "doc_id long, text string, runs string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = rd.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((row(d, t) for d, t, _ in docs), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rd.periodic_runs(docs).collect() == []
