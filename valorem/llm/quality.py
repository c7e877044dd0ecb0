"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each). A passage is encoded
by a learned layer over square roots of its hashed byte n-gram shares and some
surface shares. Gated attention weighs the passages:

    h = tanh(W x + b)         a = softmax over the document of  w . (tanh(V h) * sigmoid(U h))
    score = sigmoid(c . sum(a h) + d)

Only document labels are given; the weights are learned with them by Adam on a
bounded sample: ``SAMPLE`` labelled documents in the order of a hash of their
id, of each at most ``SAMPLE_PASSAGES`` passages spread evenly over the text.
Scoring reads every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import doc_crc, small_batches, table, text_pieces

PASSAGE = 64
BUCKETS = 256
GRAMS = (1, 2, 3)
HIDDEN, GATE = 32, 16
SAMPLE = 2000
SAMPLE_PASSAGES = 64
EPOCHS = 200
RATE = 0.02
DECAY = 1e-4
GOOD = 0.7
#: Bytes of text that are encoded at once.
BLOCK = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Surface classes of bytes: white space, upper case, lower case, digits, other ASCII, bytes of other characters.
_CLASSES = 6
_CLASS = np.full(256, 4)
_CLASS[_SPACE] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 5
WIDTH = BUCKETS + _CLASSES + 2


def _encode(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the segment, features) of each passage. A segment without words has one passage of zeros."""
    pad = max(GRAMS) - 1
    raw = np.frombuffer((b" " * pad).join(segments) + b" " * pad, np.uint8)
    length = np.array([len(s) + pad for s in segments])
    start = np.cumsum(length) - length
    segment = np.repeat(np.arange(len(segments)), length)
    own = np.ones(len(raw), bool)  # not padding
    for i in range(1, pad + 1):
        own[start + length - i] = False
    space = _SPACE[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    begins[start] = ~space[start]
    word = np.cumsum(begins)
    before = word[start] - begins[start]
    n_words = np.append(before[1:], word[-1]) - before
    passages = np.maximum(1, (n_words + PASSAGE - 1) // PASSAGE)
    first = np.cumsum(passages) - passages
    within = np.maximum(word - before[segment] - 1, 0) // PASSAGE
    passage = first[segment] + within
    total = int(passages.sum())

    counts = np.zeros(total * BUCKETS)
    value = np.zeros(len(raw), np.uint32)
    for n in GRAMS:
        size = len(raw) - n + 1
        value = value[:size] * np.uint32(0x9E3779B1) + (raw[n - 1:] + np.uint32(n)) * np.uint32(0x85EBCA77)
        bucket = ((value ^ (value >> np.uint32(15))) * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        mine = own[:size]
        counts += np.bincount(passage[:size][mine] * BUCKETS + bucket[mine], minlength=total * BUCKETS)
    counts = counts.reshape(total, BUCKETS)
    classes = np.bincount(passage[own] * _CLASSES + _CLASS[raw[own]], minlength=total * _CLASSES).reshape(total, _CLASSES)
    words = np.bincount(passage[begins], minlength=total)
    size = np.maximum(1, classes.sum(axis=1, keepdims=True))
    x = np.concatenate([
        np.sqrt(counts / (len(GRAMS) * size)), classes / size,
        (words / PASSAGE)[:, None], np.minimum(size / np.maximum(1, words)[:, None] / 10, 3)], axis=1)
    x[words == 0] = 0
    return np.repeat(np.arange(len(segments)), passages), x.astype(np.float32)


def passages(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, features) of each passage, in blocks; a text's passages follow one another."""
    segments: list[bytes] = []
    owners: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for piece in text_pieces(text or b"", BLOCK):
            segments.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= BLOCK:
                where, x = _encode(segments)
                yield np.array(owners)[where], x
                segments, owners, held = [], [], 0
    if segments:
        where, x = _encode(segments)
        yield np.array(owners)[where], x


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """The weights: W, b (encoder), V, U, w (gated attention), c, d (classifier)."""

    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    d: np.ndarray

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and attention logit of each passage."""
        h = np.tanh(x @ self.W + self.b)
        return h, (np.tanh(h @ self.V) * _sigmoid(h @ self.U)) @ self.w

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        bags, hs, logits = [], [], []
        for bag, x in passages(texts):
            h, logit = self.encode(x)
            bags.append(bag)
            hs.append(h)
            logits.append(logit)
        bag, h, logit = map(np.concatenate, (bags, hs, logits))
        z, _, _ = pool(bag, h, logit)
        return _sigmoid(z @ self.c + self.d[0])


def pool(bag: np.ndarray, h: np.ndarray, logit: np.ndarray):
    """Weighted representation of each bag (bags are consecutive numbers from 0), first passages, weights."""
    first = np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
    e = np.exp(logit - np.maximum.reduceat(logit, first)[bag])
    weight = e / np.add.reduceat(e, first)[bag]
    return np.add.reduceat(weight[:, None] * h, first, axis=0), first, weight


def start(seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)

    def matrix(rows: int, columns: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(rows), (rows, columns))

    return Model(matrix(WIDTH, HIDDEN) * 3, np.zeros(HIDDEN), matrix(HIDDEN, GATE), matrix(HIDDEN, GATE),
                 matrix(GATE, 1)[:, 0], matrix(HIDDEN, 1)[:, 0], np.zeros(1))


def gradients(m: Model, bag: np.ndarray, x: np.ndarray, target: np.ndarray) -> tuple[float, Model]:
    """Mean cross entropy over the bags, and its gradient by every weight."""
    h = np.tanh(x @ m.W + m.b)
    t, s = np.tanh(h @ m.V), _sigmoid(h @ m.U)
    z, first, weight = pool(bag, h, (t * s) @ m.w)
    logit = z @ m.c + m.d[0]
    p = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - target * logit))
    g = (p - target) / len(target)
    dz = g[:, None] * m.c
    along = (dz[bag] * h).sum(axis=1)
    da = weight * (along - np.add.reduceat(weight * along, first)[bag])
    gate = da[:, None] * m.w
    dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
    dh = (weight[:, None] * dz[bag] + dt @ m.V.T + ds @ m.U.T) * (1 - h * h)
    return loss, Model(x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ da, z.T @ g, np.array([g.sum()]))


def fit(bag: np.ndarray, x: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> Model:
    """Adam over whole bags. Without any bag the starting weights are returned."""
    m = start(seed)
    if not len(target):
        return m
    x = x.astype(np.float64)
    first = {k: np.zeros_like(v) for k, v in vars(m).items()}
    second = {k: np.zeros_like(v) for k, v in vars(m).items()}
    for step in range(1, epochs + 1):
        _, grad = gradients(m, bag, x, target)
        for k, v in vars(m).items():
            g = getattr(grad, k) + DECAY * v
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            v -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return m


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, target, data = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for i, t, text in zip(ids, target, data):
            x = np.concatenate([x for _, x in passages([text])])
            if len(x) > SAMPLE_PASSAGES:
                x = x[np.linspace(0, len(x) - 1, SAMPLE_PASSAGES).astype(int)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i]), pa.array([t]), pa.array([x.tobytes()], pa.binary())], ["doc_id", "target", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From documents (doc_id, text) that have a label (doc_id, quality); several labels of a document are averaged.

    Rows that repeat a doc_id give one bag, that of the text with the least
    hash. Null labels and ids are left out; null text is empty.
    """
    target = (labels.filter("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("target")))
    present = docs.select("doc_id").distinct().join(target, "doc_id")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` rows of two numbers
             .groupBy("doc_id", "target").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
             .select(F.col("doc_id").cast("long"), "target", F.encode("t.text", "UTF-8").alias("text")))
    rows = texts.mapInArrow(_sample_rows, "doc_id long, target double, x binary").toArrow().to_pylist()
    rows.sort(key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in rows]
    if not bags:
        return start()
    return fit(np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.concatenate(bags), np.array([r["target"] for r in rows]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` without text, and score (replaced if it is there). Null text is empty."""
    names = [c for c in docs.columns if c not in ("text", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*names, F.encode("text", "UTF-8").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            got = shared.value.score(batch.column(len(names)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got)], [*names, "score"])

    return own.mapInArrow(run, own.drop("text").withColumn("score", F.lit(0.0)).schema)


def op10_quality(spark, sf_dir):
    """Learns from labelled documents whose crc32(doc_id) mod 4 is not 2, scores every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = (doc_crc(F.col("doc_id")) % 4) == 2
    model = train(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    return (score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted")))
