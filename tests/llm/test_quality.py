import numpy as np

from valorem.llm import quality as q


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(4)
    bag = np.repeat(np.arange(5), [1, 3, 2, 7, 1])
    x = rng.normal(size=(len(bag), q.WIDTH))
    target = np.array([0, 1, 1, 0.5, 0])
    m = q.start(2)
    _, grad = q.gradients(m, bag, x, target)
    for name, value in vars(m).items():
        flat = value.reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up, _ = q.gradients(m, bag, x, target)
            flat[i] = kept - 1e-5
            down, _ = q.gradients(m, bag, x, target)
            flat[i] = kept
            assert abs((up - down) / 2e-5 - getattr(grad, name).reshape(-1)[i]) < 1e-6, name


def plain_passages(text):
    words = text.split()
    return max(1, -(-len(words) // q.PASSAGE)), len(words)


def test_a_text_scores_alike_in_any_batch(monkeypatch):
    texts = [b"", None, b"one", b" \n ", b"word " * 64, b"word " * 65, "É ñ ü".encode() * 300, b"A!! B!! " * 500, b"x" * 5000]
    m = q.start(1)
    whole = m.score(texts)
    assert ((whole >= 0) & (whole <= 1)).all()
    for i, t in enumerate(texts):
        assert abs(m.score([t])[0] - whole[i]) < 1e-9
    n = np.bincount(np.concatenate([bag for bag, _ in q.passages(texts)]), minlength=len(texts))
    assert n.tolist() == [plain_passages(t or b"")[0] for t in texts]


def test_every_passage_counts():
    """The score depends on words far into a very long text."""
    m = q.start(1)
    base = b"plain words here " * 200_000
    assert m.score([base])[0] != m.score([base + b"AND!! LOUD!! " * 2000])[0]


def test_tables(spark):
    docs = spark.createDataFrame([(1, "a fine text", 9), (2, "BAD!! TEXT!!", 9), (2, "BAD!! TEXT!!", 9), (3, None, 9), (None, "x", 9), (4, "", 9)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (77, 1)], "doc_id long, quality int")
    m = q.train(docs, labels)
    got = q.score(docs, m)
    assert got.columns == ["doc_id", "score"] and got.count() == 6
    assert all(0 <= r.score <= 1 for r in got.collect())
    same = [r.score for r in got.collect() if r.doc_id == 2]
    assert same[0] == same[1]
    assert q.score(docs.filter("false"), q.train(docs, labels.filter("false"))).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = q.op10_quality(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    own = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in own) / len(own) > 0.95
