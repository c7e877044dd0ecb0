import hashlib
import random

import pytest

from valorem.llm import substring_dedup as sd


def plain(docs, span):
    """(id, n_words, n_removed, sha of the kept words) by definition."""
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - span + 1):
            if d is not None:
                k = tuple(w[i:i + span])
                least[k] = min(least.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - span + 1):
            if d is not None and least[tuple(w[i:i + span])] < d:
                gone |= set(range(i, i + span))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, n, span):
    def some(k):
        return [rng.choice("abcdefghijklmnopqrstuvwxyzé") + rng.choice("123456789") for _ in range(k)]

    shared = [some(rng.randint(span - 2, 3 * span)) for _ in range(6)]
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a " * 3 * span), (5, "a " * span), (6, "a " * (span - 1)), (None, "a " * 2 * span), (8, "b " * 4 * span)]
    for i in range(n):
        w = some(rng.randint(0, 2 * span))
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            s = s[a:a + rng.randint(1, len(s))]
            if rng.random() < 0.3:
                s = s[:len(s) // 2] + some(1) + s[len(s) // 2:]
            at = rng.randint(0, len(w))
            w[at:at] = s
        docs.append((rng.randint(0, 2 * n), rng.choice([" ", "\t", "\n "]).join(w)))
    for d, t in rng.sample(docs, 8):
        docs += [(d, t), (rng.randint(0, 3 * n), t)]
    return docs


@pytest.mark.parametrize("span, gram, block", [(50, 10, 1 << 20), (6, 2, 300), (8, 3, 1), (5, 5, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, span, gram, block):
    monkeypatch.setattr(sd, "BLOCK", block)
    docs = corpus(random.Random(span), 70, span)
    d = spark.createDataFrame([(*x, 1, "c") for x in docs], "doc_id long, text string, h int, factors string").repartition(3)
    words, factors = sd.parsed(d, span, gram)
    own = {(r.doc_id, r.body): r.factors for r in factors.collect()}
    cut = sd.dedup_substrings(d, span, gram).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in cut]
    got += [(r.doc_id, r.n_words, 0, r.words_sha256) for r in words.collect() if (r.doc_id, r.body) not in own]
    assert sorted(got, key=str) == plain(docs, span)
    assert all(f.length >= span and f.source < k[0] for k, fs in own.items() for f in fs)


def test_least_of():
    import numpy as np
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 4, 7, 41):
        v = rng.integers(0, 9, 200)
        want = [max(j for j in range(i, i + width) if v[j] == v[i:i + width].min()) for i in range(200 - width + 1)]
        assert sd.least_of(v, width).tolist() == want


def test_query_over_a_table(spark, tmp_path):
    docs = corpus(random.Random(9), 60, 50)
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, sd.op12_substring_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == plain(docs, 50)


def test_one_passage_in_very_many_documents(spark):
    passage = " ".join(f"w{i}" for i in range(70))
    docs = [(i, f"x{i} " * 20 + passage + f" y{i}" * 20) for i in range(400)]
    got = {r.doc_id: r.kept for r in sd.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: " ".join([f"x{i}"] * 20 + [f"y{i}"] * 20) for i in range(1, 400)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sd.dedup_substrings(docs).collect() == []
    words, factors = sd.parsed(docs)
    assert words.collect() == [] and factors.collect() == []
