"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams (1 to 3 characters of the lower-cased text, all
that is not a letter folded to one space) per language over every training
document: tasks add up dense counts and emit one row per language and bucket,
which Spark sums. The model is a languages x ``BUCKETS`` matrix of log
probabilities; its size does not depend on the corpus, and it is broadcast.
Scoring sums, for a batch of texts at once, the matrix rows of the n-grams
that occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import doc_crc, small_batches, table

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
#: Languages at most (1,000 x 32,768 floats are 131 MB); more is an error, not a cut.
MAX_LANGUAGES = 1000
#: Characters that are hashed at once.
BLOCK = 1 << 19
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def _folded(text: str) -> str:
    """Lower-cased, each run of other characters than letters one space, a space at both ends; empty without letters."""
    own = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {own} " if any(map(str.isalpha, own)) else ""


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, str]]:
    """(numbers of the texts, their folded pieces joined). Long texts come in pieces that overlap by two characters."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        text = text or ""
        for at in range(0, len(text), BLOCK):
            own = _folded(text[at:at + BLOCK + 2])
            if own:
                owners.append(np.full(len(own), i))
                parts.append(own)
                held += len(own)
            if held >= BLOCK:
                yield np.concatenate(owners), "".join(parts)
                owners, parts, held = [], [], 0
    if parts:
        yield np.concatenate(owners), "".join(parts)


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of every n-gram, in blocks, in the order of the texts for each n."""
    for owner, joined in _pieces(texts):
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        value = np.zeros(len(codes), np.uint32)
        for n in GRAMS:
            size = max(0, len(codes) - n + 1)
            value = value[:size] * _MULTIPLIERS[0] + (codes[n - 1:] + np.uint32(n)) * _MULTIPLIERS[1]
            mixed = (value ^ (value >> np.uint32(15))) * _MULTIPLIERS[2]
            own = owner[:size]
            whole = own == owner[n - 1:]
            yield own[whole], (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)[whole]


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # BUCKETS x languages
    prior: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in small_batches(batches):
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs) if x == lang]
            docs[lang] = docs.get(lang, 0) + len(own)
            total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, buckets in grams(own):
                total += np.bincount(buckets, minlength=BUCKETS)
    for lang, total in sums.items():
        used = np.append(np.flatnonzero(total), -1)  # bucket -1: the number of documents
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array(used), pa.array(np.append(total[used[:-1]], docs[lang]))],
            ["lang", "bucket", "n"])


def train(docs: DataFrame) -> Model:
    """From all rows of ``docs`` (text, lang) whose lang is not null; null text is empty."""
    known = docs.filter("lang is not null").select("lang", F.coalesce("text", F.lit("")).alias("text"))
    counts = (known.mapInArrow(_count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    rows = counts.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("n")).limit(MAX_LANGUAGES + 1)
    total: dict[str, np.ndarray] = {}
    prior: dict[str, int] = {}
    for r in rows.toLocalIterator():  # at most BUCKETS + 1 entries a language
        own = np.zeros(BUCKETS)
        prior[r.lang] = r.n.pop(-1, 0)
        own[list(r.n.keys())] = list(r.n.values())
        total[r.lang] = own
    if len(total) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: raise MAX_LANGUAGES and the memory for the model")
    languages = sorted(total)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    weights = np.stack([total[x] for x in languages], axis=1) + SMOOTHING
    share = np.array([prior[x] + SMOOTHING for x in languages])
    return Model(languages, np.log(weights / weights.sum(axis=0)).astype(np.float32), np.log(share / share.sum()))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability; ``und`` and 0 without letters (or without any learned language).

    Ties go to the language that sorts first.
    """
    sums = np.zeros((len(texts), len(model.languages)))
    seen = np.zeros(len(texts), bool)
    for owner, buckets in grams(texts):
        if len(owner):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            seen[owner[first]] = True
            if model.languages:
                sums[owner[first]] += np.add.reduceat(model.log_prob[buckets], first, axis=0, dtype=np.float64)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    sums += model.prior
    best = sums.argmax(axis=1)
    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, share, 0.0)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` that it has, with lang_pred and score (replaced if they are there)."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    own = docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = own.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            lang, score = predict(shared.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return own.mapInArrow(run, schema)


def op9_language_id(spark, sf_dir):
    """Learns from the documents whose crc32(doc_id) mod 4 is not 2, predicts every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = (doc_crc(F.col("doc_id")) % 4) == 2
    model = train(docs.filter(~held_out).select("text", "lang"))
    return (identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))
