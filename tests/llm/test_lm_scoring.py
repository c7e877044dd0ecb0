import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from valorem.llm import lm_scoring as lm
from valorem.llm.common import doc_crc


def plain_tokens(text):
    return (text or "").encode().lower().split() + [b"\0end"]


def plain(rows, held):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base score."""
    counts = {}
    for (doc, text), h in zip(rows, held):
        if not h:
            for t in plain_tokens(text):
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for (doc, text), h in zip(rows, held):
        own = plain_tokens(text)
        base = sum(math.log10((counts.get(t, 0) + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((doc, h, len(own), sum(t in counts for t in own), n, round(base, 6)))
    return sorted(out, key=str)


def rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    out = [(i, " ".join(rng.choice(vocabulary[:rng.choice([3, 10, 60])]) for _ in range(rng.randint(0, 80)))) for i in range(120)]
    out += [(200, "the same passage again and again " * 20), (201, "The SAME passage again and again " * 20), (202, None), (203, ""), (204, " \t\r\n"),
            (3, out[3][1]), (None, "a null id"), (205, "É é \x85 x\x1fy"), (206, "unheard of words only here"), (207, "w0 " * 5000)]
    return out


def frame(spark, data, parts):
    return spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, row int, bucket string").repartition(parts)


def held_out():
    return (doc_crc(F.col("doc_id")) % 5) == 1


@pytest.fixture(scope="module")
def scored(spark):
    return [tuple(r) for r in lm.lm_scores(frame(spark, rows(), 4), held_out()).collect()]


def test_counts_and_base_score(scored):
    data = rows()
    held = [zlib.crc32(str(d if d is not None else "").encode()) % 5 == 1 for d, _ in data]
    assert any(held)
    assert sorted(((*r[:5], round(r[5], 6)) for r in scored), key=str) == plain(data, held)
    assert all(r[6] < 0 for r in scored)


def test_layout_does_not_matter(spark, scored, monkeypatch):
    monkeypatch.setattr(lm, "JOINED", 1)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 50)
    again = [tuple(r) for r in lm.lm_scores(frame(spark, rows(), 9), held_out(), buckets=7).collect()]
    a, b = ({(r[0], r[2], round(r[5], 6)): r[6] for r in x} for x in (scored, again))
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_pieces_do_not_change_tokens(monkeypatch):
    texts = [t.encode() if t is not None else None for _, t in rows()]
    whole = lm.tokens(texts)
    monkeypatch.setattr(lm, "BLOCK", 40)
    for a, b in zip(whole, lm.tokens(texts)):
        assert (a == b).all()
    doc, word, context = whole
    assert np.bincount(doc).tolist() == [len(plain_tokens(t)) for _, t in rows()]
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    assert (context[first] == 0).all() and (np.delete(context, first) > 0).all()


def test_hot_words_are_scored_like_others(spark, scored, monkeypatch):
    """Splitting words over buckets changes where they are counted, not how: counts are equal, scores near."""
    monkeypatch.setattr(lm, "HOT_SHARE", 2.0)  # no word is hot
    cold = {(r[0], r[2], round(r[5], 6)): r[6] for r in (tuple(x) for x in lm.lm_scores(frame(spark, rows(), 4), held_out()).collect())}
    hot = {(r[0], r[2], round(r[5], 6)): r[6] for r in scored}
    assert hot.keys() == cold.keys()
    worst = max(hot, key=lambda k: abs(hot[k] - cold[k]) / (1 + abs(cold[k])))
    assert abs(sum(hot.values()) - sum(cold.values())) < 0.01 * abs(sum(cold.values())), (worst, hot[worst], cold[worst])


def test_predictive_probabilities_of_a_bucket():
    """All counts in one bucket: sum of P(w | u) over known words and the unknown place is 1 in each sampled round."""
    rng = np.random.default_rng(3)
    texts = [b" ".join(rng.choice([b"aa", b"bb", b"cc", b"dd", b"ee"], rng.integers(0, 60))) for _ in range(40)]
    doc, word, context = lm.tokens(texts)
    order = np.lexsort((context, word))
    part = lm._packed(word[order], context[order], (doc[order] << 1).astype(np.uint32), np.ones(len(order), np.uint32), 0)
    own = lm.Bucket([part], np.empty(0, np.uint64))
    customers = np.bincount(own.context, weights=own.c, minlength=lm.CONTEXTS)
    tables = np.bincount(own.context, minlength=lm.CONTEXTS).astype(float)
    totals = lm.Totals(np.empty(0, np.uint64), tokens=int(own.c.sum()), words=len(own.word), customers=customers, tables=tables, discounts=(0.4, 0.6))
    totals.root = (float(len(own.c)), float(len(own.word)))
    assert own.c.sum() == sum(len(t.split()) + 1 for t in texts)
    for t, cw, tw in own.rounds(totals):
        assert ((t >= 1) & (t <= own.c)).all() and ((tw >= 1) & (tw <= cw)).all()
        root = (cw.sum(), tw.sum())
        above = totals.root_probability(cw, tw, root)
        unknown = totals.root_probability(0.0, 0.0, root)
        assert abs(above.sum() + unknown - 1) < 1e-9
        by_context = np.bincount(own.context, weights=t, minlength=lm.CONTEXTS)
        for u in np.unique(own.context):
            p = (1.0 + 0.6 * by_context[u]) * above / (1.0 + customers[u])
            mine = own.context == u
            p[own.word_of[mine]] += (own.c - 0.6 * t)[mine] / (1.0 + customers[u])
            assert abs(p.sum() + (1.0 + 0.6 * by_context[u]) * unknown / (1.0 + customers[u]) - 1) < 1e-9


def exact_law(c, new, d, most):
    """Probabilities of 1 .. most tables by the recursion over generalised Stirling numbers, as logarithms."""
    k = np.arange(1, most + 1)
    row = np.full(most, -np.inf)
    row[0] = 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(1, c):
            stay = np.where(n - k * d > 0, np.log(np.maximum(n - k * d, 1e-300)), -np.inf) + row
            row = np.logaddexp(np.concatenate(([-np.inf], row[:-1])), stay)
    weight = row + k * math.log(new)
    p = np.exp(weight - weight.max())
    return p / p.sum()


@pytest.mark.parametrize("c, new, d", [(2, 0.3, 0.5), (3, 0.7, 0.5), (20, 2.0, 0.7), (32, 2.0, 0.8), (33, 2.0, 0.8), (100, 2.0, 0.7), (1000, 5.0, 0.8),
                                       (5000, 3.0, 0.8), (5000, 3.0, 0.3), (700, 40.0, 0.6), (1001, 90.0, 0.5), (30000, 6.0, 0.4), (60, 1e6, 0.9)])
def test_seating_follows_the_restaurant_process(c, new, d):
    law = exact_law(c, new, d, min(c, 600))
    n = 40_000
    got = lm.seated(np.full(n, c), np.full(n, new), d, lm.mix(np.arange(n, dtype=np.uint64)))
    mean = (law * np.arange(1, len(law) + 1)).sum()
    var = (law * np.arange(1, len(law) + 1) ** 2).sum() - mean ** 2
    assert abs(got.mean() - mean) < 0.01 * mean + 4 * math.sqrt(var / n)
    assert abs(got.var() - var) < 0.05 * var + 0.01
    drawn = np.bincount(got.astype(int), minlength=len(law) + 1)[1:] / n
    assert np.abs(np.cumsum(drawn)[:len(law)] - np.cumsum(law)).max() < 0.015


@pytest.mark.parametrize("c, new, d", [(2000, 700.0, 0.6), (900, 5000.0, 0.8), (20000, 600.0, 0.7)])
def test_dishes_with_many_tables(c, new, d):
    law = exact_law(c, new, d, min(c, 2500))
    n = 20_000
    got = lm.seated(np.full(n, c), np.full(n, new), d, lm.mix(np.arange(n, dtype=np.uint64)))
    mean = (law * np.arange(1, len(law) + 1)).sum()
    deviation = math.sqrt((law * np.arange(1, len(law) + 1) ** 2).sum() - mean ** 2)
    assert abs(got.mean() - mean) < 0.002 * mean and abs(got.std() - deviation) < 0.03 * deviation
    assert got.min() >= 1 and got.max() <= c


def test_held_out_perplexity(spark):
    got = lm.op5_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    text = {d.doc_id: d.text for d in docs}
    held = [zlib.crc32(str(d.doc_id).encode()) % 5 == 1 for d in docs]
    want = plain([(d.doc_id, d.text) for d in docs], held)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
    own = [r for r in got if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    assert len(got) == len(text)


def test_empty(spark):
    docs = frame(spark, rows(), 2)
    assert lm.lm_scores(docs.filter("false"), F.lit(False)).collect() == []
    untrained = lm.lm_scores(docs.limit(3), F.lit(True)).collect()
    assert len(untrained) == 3 and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained)


def test_every_previous_word_is_a_context_of_its_own(monkeypatch):
    """Far more previous words than a part holds: each has its own customers, added up over the buckets."""
    words = [b"w%d" % i for i in range(40_000)]
    doc, word, context = lm.tokens([b" x ".join(words)])
    after = context[word == word[1]]  # contexts of x
    assert len(np.unique(after)) == len(words) - 1
    monkeypatch.setattr(lm, "CONTEXTS", 7)
    parts = []
    for k in range(2):
        own = (word & np.uint64(1)) == k
        order = np.lexsort((context[own], word[own]))
        parts.append(lm._packed(word[own][order], context[own][order], np.zeros(own.sum(), np.uint32), np.ones(own.sum(), np.uint32), 0))
    own = lm.Bucket(parts, np.empty(0, np.uint64), [0, 1])
    values = np.bincount(own.context, weights=own.c)[:, None]
    sent = sorted(lm._sent([5, 9], own, values, 4), key=lambda r: r[1])
    assert max(r[2] for r in sent) <= 7 and {r[0] for r in sent} == {5, 9}
    back = lm.pa.Table.from_batches(lm._add_up(1)(iter([lm._sent_batch(sent)]))).to_pylist()
    plain = dict(zip(*map(np.ndarray.tolist, np.unique(context, return_counts=True))))
    for bucket in (5, 9):
        got = lm._answered([r | {"width": 1} for r in back if r["bucket"] == bucket])
        assert (got[0] == own.contexts[own.member == (bucket == 9)]).all()
        assert [plain[u] for u in got[0].tolist()] == got[1][:, 0].tolist()


def dealt(rng, texts, buckets):
    """Batches of _deal and of _gather for some texts in one portion, all for training but each fifth."""
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array(range(texts)), lm.pa.array(range(texts)), lm.pa.array([i % 5 == 1 for i in range(texts)]),
                                           lm.pa.array([" ".join(f"w{k}" for k in rng.zipf(1.3, 100) % 50_000).encode() for _ in range(texts)])],
                                          ["row", "doc_id", "held_out", "text"])
    hot = np.empty(0, np.uint64)
    sent = lm.pa.Table.from_batches(lm._deal(buckets, hot)(iter([batch]))).sort_by("bucket")
    return sent, lm.pa.Table.from_batches(lm._gather(buckets, hot)(iter(sent.to_batches())))


def test_bytes_that_a_token_takes_on_disk():
    """What is dealt and what is stored of it: both hold each (word, context) of a portion once, contexts by number."""
    sent, kept = dealt(np.random.default_rng(5), 2000, 16)
    tokens = 2000 * 101
    assert sum(c.nbytes for c in sent.columns) < 3.7 * tokens  # 4.2 with all entries and whole contexts
    assert sum(c.nbytes for c in kept.columns) < 3.7 * tokens  # 6.2


def test_answers_come_back_in_the_order_of_the_pairs():
    """Each pair of a portion is one of its bucket's, the same number of them as its texts' row has."""
    sent, kept = dealt(np.random.default_rng(6), 300, 4)
    texts = [r for r in sent.to_pylist() if r["bucket"] < 0]
    parts = {r["bucket"]: lm._unpacked(r["part"]) for r in sent.to_pylist() if r["bucket"] >= 0}
    entries, doc, n, ids, null, held, n_tokens = lm._columns(texts[0]["part"])
    assert len(texts) == 1 and len(entries) == sum(len(p[1]) for p in parts.values()) and entries.sum() == len(doc) == len(n)
    assert n_tokens.tolist() == [101] * 300 and ids.tolist() == list(range(300)) and not null.any() and held.sum() == 60
    for row in kept.to_pylist():
        if row["part"] is not None:
            _, word, context, c = lm._unpacked(row["part"])
            (block, places), = map(lm._columns, row["places"])
            at = np.cumsum(places).astype(int)
            own = parts[row["bucket"]]
            assert int(block[0]) == own[0] == texts[0]["block"]
            assert (word[at] == own[1]).all() and (context[at] == own[2]).all() and (c[at] == own[3]).all()
            assert (np.lexsort((context, word)) == np.arange(len(word))).all()


def test_squeezed_numbers_come_back():
    for columns in ([[]], [[0]], [[5, 0, 2 ** 64 - 1], [], [255, 256]], [[True, False]]):
        got = lm._columns(lm._squeezed(*(np.array(c, np.uint64) for c in columns)))
        assert [c.tolist() for c in got] == columns


def test_shuffles_of_a_stored_frame_leave_the_disk(spark):
    """The setting holds while the frame is written, and only then."""
    from valorem.llm import common

    before = spark.conf.get(common.SHUFFLE_CLEANUP, None)
    frame = spark.range(1000).repartition(4, "id")
    seen = []

    class Spy:
        sparkSession, schema = spark, frame.schema

        class write:
            @staticmethod
            def parquet(path):
                seen.append(spark.conf.get(common.SHUFFLE_CLEANUP, None))
                frame.write.parquet(path)

    assert common.stored(Spy, "kept").count() == common.stored(Spy, "dropped", drop_shuffles=True).count() == 1000
    assert seen == [before, "true"] and spark.conf.get(common.SHUFFLE_CLEANUP, None) == before
