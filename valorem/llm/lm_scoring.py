"""Document scores by a hierarchical Pitman-Yor language model.

Two levels of restaurants: one restaurant for each context (the previous
word, by its 64-bit hash; 0 is the start of a text), which share one parent, the restaurant of words without context, above a uniform
base over the known words and one place for all others:

    P(w)     = (C_w - d0 t_w + (s0 + d0 T) / (V + 1)) / (s0 + C)
    P(w | u) = (c_uw - d1 t_uw + (s1 + d1 T_u) P(w)) / (s1 + c_u)

c_uw counts w after u in the training texts, t_uw the tables that serve w in
u's restaurant; C_w, the customers of w in the parent, is the sum of t_uw.
Tables are seated by Gibbs sampling of the Chinese restaurant process, a dish
at a time: its customers get up and sit down again, at tables with weight
(size - d) or at new ones with weight (s + d T) P(w), and their number of
tables is drawn from that law as a whole (``seated``). After ``BURN_IN`` rounds the
predictive probabilities of ``SAMPLES`` rounds are averaged; the score is
their log10, summed over the tokens.

On Spark the words are dealt into buckets by hash, so all that concerns one
dish is in one place. What a restaurant's dishes share (c_u, T_u) is added up
over the buckets before the next pass: a bucket sends its own sums for each of
its contexts, dealt into blocks by context; a block adds up what the buckets
sent and answers each with the totals of the contexts that it named; the
answers are stored, in the order of the bucket's contexts and without naming
them again, and joined to the buckets. A context is one row of a part
for each bucket that has it, however common it is. Within a pass the totals
stay fixed, so rows are seated independently of one another. Random numbers are hashes of (word, context,
round): the result doesn't depend on partitions, order or retries.

Texts are dealt in portions. Only the distinct (word, context) of a portion go
to the buckets, each with its training tokens; which texts have them stays in
a row of the portion. A bucket answers a portion with the probability and the
word's count of each pair that it was sent, in the same order, and the
portion's row adds them up by text.

Words that hold half of ``HOT_SHARE`` of all tokens or more (at most 2 / HOT_SHARE
words) are split over buckets by context; their parent counts are summed like
T_u. Within a text, repeats of a (context, word) are one entry.

On the way, numbers are kept as differences in sorted order, byte by byte,
compressed. A shuffle's files are dropped when its result is stored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import doc_crc, stored, table, text_pieces
from valorem.llm.hashing import Rolling, mix

#: Contexts that a bucket sends in one part at most.
CONTEXTS = 1 << 15
STRENGTH = (1.0, 1.0)
BURN_IN = 2
SAMPLES = 3
#: Tables up to which a dish's distribution is written out; counts up to which all its ratios are kept, and are computed exactly.
WIDTH, DENSE, EXACT = 512, 512, 16384
#: Numbers of a distribution that are held at once.
CELLS = 1 << 19
HOT_SHARE = 0.002
#: Tokens in a bucket on average, and buckets at least.
BUCKET_TOKENS = 1_200_000
LEAST_BUCKETS = 128
#: Tokens that a task sorts at once before it deals them out.
BLOCK_TOKENS = 2_000_000
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20
#: Packed bytes of buckets that are seated together at least.
JOINED = 1_000_000
#: Steps of 1 in which a pair's -log10 probability is sent (in four bytes, so it may be 32 at most).
STEPS = 1 << 27

END = mix(np.array([0x656E64], np.uint64))[0]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False


# --- tokens --------------------------------------------------------------------------------------------------

def _hashed(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the segment, hash) of each word."""
    raw = np.frombuffer(b"\n".join(segments) + b"\n", np.uint8)
    mask = _IS_WORD[raw]
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edges = np.concatenate(([0], edges))
    begin, end = edges[0::2], edges[1::2]
    length = np.array([len(s) + 1 for s in segments])
    owner = np.searchsorted(np.cumsum(length), begin, side="right")
    return owner, Rolling(_LOWER[raw]).spans(begin, end)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, word, context) of each token of some texts; the last of each text is its end."""
    owners, words, segments, numbers, held = [], [], [], [], 0

    def settle() -> None:
        owner, word = _hashed(segments)
        owners.append(np.array(numbers)[owner])
        words.append(word)
        segments.clear()
        numbers.clear()

    for i, text in enumerate(texts):
        for piece in text_pieces(text or b"", BLOCK):
            segments.append(piece)
            numbers.append(i)
            held += len(piece)
            if held >= BLOCK:
                settle()
                held = 0
    if segments:
        settle()
    owner = np.concatenate([*owners, np.empty(0, np.int32)]).astype(np.int32)
    word = np.concatenate([*words, np.empty(0, np.uint64)])
    owners.clear()
    words.clear()
    place = np.arange(len(word)) + owner  # each text before has one end
    doc = np.empty(len(word) + len(texts), np.int32)
    out = np.full(len(doc), END)
    out[place] = word
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)) + 1) - 1
    doc[place], doc[ends] = owner, np.arange(len(texts))
    context = np.zeros(len(doc), np.uint64)
    context[1:] = np.maximum(mix(out[:-1] + np.uint64(1)), np.uint64(1))
    context[ends[:-1] + 1] = 0
    return doc, out, context


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about BLOCK_TOKENS tokens, or one text. The text is the last column."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0))
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (6 * BLOCK_TOKENS))) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if low < high:
                yield batch.slice(low, high - low)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a quarter of the hot share or more within a batch, and the number of tokens as word 0."""
    for texts in _portions(batches):
        _, word, _ = tokens(texts.column(0).to_pylist())
        own, n = np.unique(word, return_counts=True)
        keep = n >= HOT_SHARE / 4 * len(word)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(own[keep], np.uint64(0)).view(np.int64)), pa.array(np.append(n[keep], len(word)))], ["word", "n"])


def _counted(known: np.ndarray):
    """The tokens of each of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(known), np.int64)
        for texts in _portions(batches):
            at = _among(tokens(texts.column(0).to_pylist())[1], known)
            n += np.bincount(at[at >= 0], minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(n)], ["word", "n"])

    return run


def hot_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Words of half of HOT_SHARE of the tokens or more, and the number of all tokens.

    A word with that share has half its occurrences or more in batches of
    which it holds half that share, so those that pass a quarter of HOT_SHARE
    by their counts in such batches (at most 4 / HOT_SHARE words) are counted
    in full: the words do not depend on the batches.
    """
    texts = docs.select(F.encode("text", "UTF-8").alias("text"))
    rows = stored(texts.mapInArrow(_common, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-common-words")
    total = rows.filter("word = 0").agg(F.sum("n")).first()[0] or 0
    bar = math.ceil(HOT_SHARE / 4 * total)
    known = np.sort(np.array([r.word for r in rows.filter((F.col("word") != 0) & (F.col("n") >= bar)).select("word").collect()], np.int64).view(np.uint64))
    if not len(known):
        return known, total
    counts = (texts.mapInArrow(_counted(known), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
              .filter(F.col("n") >= math.ceil(HOT_SHARE / 2 * total)).collect())
    return np.sort(np.array([r.word for r in counts], np.int64).view(np.uint64)), total


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted array ``known``, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


# --- dealing words to buckets --------------------------------------------------------------------------------

def _squeezed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers (0 or more), each byte of a number apart from the others, compressed."""
    head, raw = [len(columns)], []
    for column in columns:
        column = np.ascontiguousarray(column).astype(np.uint64)
        width = max(1, (int(column.max()).bit_length() + 7) // 8) if len(column) else 1
        head += [len(column), width]
        raw.append(column.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    data = b"".join([np.array(head, np.int64).tobytes(), *raw])
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _columns(data: bytes) -> list[np.ndarray]:
    """The columns of ``_squeezed``, as unsigned 64-bit numbers."""
    raw = np.frombuffer(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.uint8)
    count = int(raw[:8].view(np.int64)[0])
    head = raw[8:8 + 16 * count].view(np.int64).tolist()
    out, at = [], 8 + 16 * count
    for n, width in zip(head[0::2], head[1::2]):
        column = np.zeros((n, 8), np.uint8)
        column[:, :width] = raw[at:at + n * width].reshape(width, n).T
        out.append(column.view(np.uint64)[:, 0])
        at += n * width
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Places where a row differs from the one before."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for x in sorted_columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _pairs_packed(word, context, c, block: int) -> bytes:
    """Distinct (word, context) in order, c training tokens of each: words and contexts once, then each pair's context by its place."""
    first = _starts(word)
    known, place = np.unique(context, return_inverse=True)
    place = _steps(place.astype(np.int64))
    place[first] = np.searchsorted(known, context[first])
    return _squeezed(np.array([block]), _steps(word[first]), np.diff(np.append(first, len(word))), _steps(known), place, c)


def _packed(word, context, doc, n, block: int) -> bytes:
    """The pairs of entries in order of (word, context). n counts for training unless the last bit of ``doc`` is set."""
    first = _starts(word, context)
    return _pairs_packed(word[first], context[first], np.add.reduceat(np.where(doc & 1, 0, n).astype(np.int64), first), block)


def _unpacked(part: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """block, and the word, context and training tokens of each pair."""
    block, word, runs, known, place, c = _columns(part)
    runs = runs.astype(np.int64)
    first = np.cumsum(runs) - runs
    upto = np.cumsum(place)
    place = upto - np.repeat(upto[first] - place[first], runs)
    return int(block[0]), np.repeat(np.cumsum(word), runs), np.cumsum(known)[place.astype(np.int64)], c.astype(np.int64)


_DEALT = "bucket int, block long, part binary"


def _dealt_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], ["bucket", "block", "part"])


def _deal(buckets: int, hot: np.ndarray):
    """(row, doc_id, held_out, text) -> for each portion a row of its texts (in a bucket below 0), and for each of its buckets one packed part.

    The texts' row has the entries of each pair, in the order of bucket, word
    and context: their number, then text and repeats of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            block, ids, held = batch.column(0)[0].as_py(), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
            doc, word, context = tokens(batch.column(3).to_pylist())
            n_tokens = np.bincount(doc, minlength=len(ids))
            known, place = np.unique(word, return_inverse=True)
            follows, at = np.unique(context, return_inverse=True)
            order = np.argsort(place.astype(np.int64) * len(follows) + at, kind="stable")  # by word, context, text
            del place, at, known, follows
            doc, word, context = doc[order], word[order], context[order]
            new = _starts(word, context, doc)
            n = np.diff(np.append(new, len(word)))
            doc, word, context = doc[new], word[new], context[new]
            bucket = (((word >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)  # grows with the word
            split = _among(word, hot) >= 0
            if split.any():
                spread = mix(word[split] ^ mix(context[split]))
                bucket[split] = (((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, doc, word, context, n = bucket[order], doc[order], word[order], context[order], n[order]
            entries = np.diff(np.append(_starts(word, context), len(word)))
            texts = _squeezed(entries, doc, n, np.asarray(pc.fill_null(ids, 0)).view(np.uint64), np.asarray(pc.is_null(ids)), held, n_tokens)
            yield _dealt_batch([(-1 - int(mix(np.array([block], np.uint64))[0]) % buckets, block, texts)])
            first = _starts(bucket)
            for a, b in zip(first, np.append(first[1:], len(bucket))):
                yield _dealt_batch([(int(bucket[a]), block, _packed(word[a:b], context[a:b], held[doc[a:b]].astype(np.uint8), n[a:b], block))])

    return run


# --- one bucket ----------------------------------------------------------------------------------------------

@dataclass
class Totals:
    """What is known of the whole corpus: scalars and numbers for each hot word; and, in a task, vectors over a bucket's contexts."""

    hot: np.ndarray
    burn_in: int = BURN_IN
    samples: int = SAMPLES
    tokens: int = 0
    words: int = 0
    customers: np.ndarray | None = None  # c_u
    tables: np.ndarray | None = None  # T_u that seatings start from
    discounts: tuple[float, float] = (0.5, 0.5)
    root: tuple[float, float] = (0.0, 0.0)  # C and T that seatings start from
    hot_count: np.ndarray | None = None  # training tokens of each hot word
    hot_root: np.ndarray | None = None  # P(w) of each hot word that seatings start from
    # by sample: (C, T), P(w) of the hot words
    sampled: list[tuple[tuple[float, float], np.ndarray]] = field(default_factory=list)

    def root_probability(self, customers, tables, root):
        d, s = self.discounts[0], STRENGTH[0]
        return (customers - d * tables + (s + d * root[1]) / (self.words + 1)) / (s + root[0])

    def root_weight(self) -> float:
        return (STRENGTH[0] + self.discounts[0] * self.root[1]) / (self.words + 1)


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    x = mix(key + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


@lru_cache(maxsize=4)
def _stirling(d: float) -> tuple[np.ndarray, np.ndarray]:
    """Counts c (ascending) and, for each, the running sums over t <= WIDTH of log(S(c, t - 1) / S(c, t)), from t = 2 on.

    S are generalised Stirling numbers: S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t),
    so the ratios r(c, t) follow from those of c alone. Kept are all counts up
    to DENSE and 32 an octave up to EXACT. As c grows, r(c, t) falls to
    d (t - 1); beyond EXACT the rest falls by the power that it had in the
    last octave. A ratio of t > c is infinite: there are no such tables.
    """
    t = np.arange(2, WIDTH + 1)
    r = np.full(len(t), np.inf)
    counts, rows = [1], [r.copy()]
    beyond = {int(DENSE * 2 ** (i / 32)) for i in range(1, 1 + 32 * int(math.log2(EXACT / DENSE)))}
    half = None
    for c in range(1, EXACT):
        n = min(c, WIDTH) - 1  # finite ratios of c: t = 2 .. n + 1
        own, k = r[:n], t[:n]
        below = np.concatenate(([0.0], own[:-1]))
        following = own * (below + c - (k - 1) * d) / (own + c - k * d)
        if n < len(t):
            r[n] = (own[-1] if n else 0.0) + c * (1 - d)  # S(c + 1, c)
        r[:n] = following
        if c + 1 <= DENSE or c + 1 in beyond:
            counts.append(c + 1)
            rows.append(r.copy())
        if c + 1 == EXACT // 2:
            half = r.copy()
    least = d * (t - 1)
    rest = np.maximum(r - least, 1e-300)
    power = np.maximum(np.log2(np.maximum(half - least, 1e-300) / rest), 1e-3)
    for octave in range(1, 65):
        counts.append(EXACT * 2.0 ** (octave / 2))
        rows.append(least + rest * 2.0 ** (-power * octave / 2))
    with np.errstate(invalid="ignore"):
        sums = np.cumsum(np.log(np.stack(rows)), axis=1)
    return np.array(counts, float), sums


def _narrow(c: np.ndarray, new: np.ndarray, d: float, u: np.ndarray, width: int) -> np.ndarray:
    """A draw of each row's tables (``width`` at most) by the inverse of its distribution function."""
    counts, sums = _stirling(d)
    after = np.minimum(np.searchsorted(counts, c), len(counts) - 1)
    upper = sums[after, :width - 1]
    off = np.flatnonzero(counts[after] != c)
    if len(off):
        x0, x1 = np.log(counts[after[off] - 1]), np.log(counts[after[off]])
        share = np.clip((np.log(c[off]) - x0) / (x1 - x0), 0, 1)[:, None]
        upper[off] = (1 - share) * sums[after[off] - 1, :width - 1] + share * upper[off]
    weight = np.concatenate([np.zeros((len(c), 1)), np.log(new)[:, None] * np.arange(1, width) - upper], axis=1)
    upto = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
    return 1.0 + (upto < (u * upto[:, -1])[:, None]).sum(axis=1)


def _wide(c: np.ndarray, new: np.ndarray, d: float, u: np.ndarray) -> np.ndarray:
    """A normal draw with the law's mean and variance, for rows that may have more than WIDTH tables.

    The tables are a Poisson number of independent sizes, given that they add
    up to c: with g(x) = (1 - (1 - x)^d) / d, new g(x) tables whose sizes have
    the generating function g. x solves new x (1 - x)^(d - 1) = c.
    """
    y = np.zeros(len(c))  # log(x / (1 - x)); the left side grows with it
    low, high = np.full(len(c), -700.0), np.full(len(c), 700.0)
    goal = np.log(c) - np.log(new)
    for _ in range(60):
        over = -np.logaddexp(0, -y) - (d - 1) * np.logaddexp(0, y) > goal
        high, low = np.where(over, y, high), np.where(over, low, y)
        y = (low + high) / 2
    rest, x = np.exp(-np.logaddexp(0, y)), np.exp(-np.logaddexp(0, -y))
    g = -np.expm1(d * np.log(rest)) / d
    size = x * rest ** (d - 1) / g
    square = size + (1 - d) * x * x * rest ** (d - 2) / g
    mean = new * g
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * _uniform(np.ascontiguousarray(u).view(np.uint64), 0))
    return np.clip(np.rint(mean + np.sqrt(np.maximum(mean * (1 - size * size / square), 0)) * normal), 1, c)


def seated(c: np.ndarray, new: np.ndarray, d: float, key: np.ndarray) -> np.ndarray:
    """Tables of each dish: c customers, weight ``new`` of a new table, discount d.

    All customers of a dish get up and sit down again together: given the
    other dishes, the probability of t tables is in proportion to
    S(c, t) new^t with generalised Stirling numbers S, and t is drawn from
    that, whatever the count.
    """
    out = np.minimum(c, 1).astype(np.float64)
    new = np.maximum(new, 1e-12)
    most = np.minimum(c, 10 + new / d + 9 * np.sqrt(new / d))
    u = _uniform(key, 0)
    width = 2
    while width <= WIDTH:  # rows of like widths go together
        own = np.flatnonzero((c > 1) & (most > (width // 2 if width > 2 else 0)) & (most <= width))
        for at in range(0, len(own), max(1, CELLS // width)):
            rows = own[at:at + max(1, CELLS // width)]
            out[rows] = _narrow(c[rows].astype(float), new[rows], d, u[rows], width)
        width *= 2
    large = np.flatnonzero(most > WIDTH)
    if len(large):
        out[large] = _wide(c[large].astype(float), new[large], d, u[large])
    return out


class Bucket:
    """Pairs of a bucket, or of several, by (word, context), with training counts.

    ``members`` has the place of each part's bucket among them. Contexts are
    numbered by bucket, then in order, so each bucket has its own.
    """

    def __init__(self, parts: list[bytes], hot: np.ndarray, members: list[int] | None = None):
        self.blocks, words, contexts, counts = map(list, zip(*map(_unpacked, parts)))  # the first: of each part
        sizes = [len(x) for x in words]
        member = np.repeat(np.array(members if members is not None else [0] * len(parts), np.int32), sizes)
        word, context, c = np.concatenate(words), np.concatenate(contexts), np.concatenate(counts)
        del words, contexts, counts
        order = np.argsort(context, kind="stable")
        order = order[np.argsort(word[order], kind="stable")]
        word, context, c, member = word[order], context[order], c[order], member[order]
        pair_at, word_at = _starts(word, context), _starts(word)
        place = np.empty(len(order), np.int32)
        place[order] = np.repeat(np.arange(len(pair_at), dtype=np.int32), np.diff(np.append(pair_at, len(order))))
        self.places = np.split(place, np.cumsum(sizes)[:-1])  # by part: which of the pairs are its own
        del order, place
        self.c = np.add.reduceat(c, pair_at)
        self.count = np.add.reduceat(c, word_at)
        self.word = word[word_at]
        self.word_of = np.repeat(np.arange(len(word_at), dtype=np.int32), np.diff(np.append(word_at, len(word))))[pair_at]  # of a pair
        context, self.owner = context[pair_at], member[pair_at]
        order = np.lexsort((context, self.owner))
        new = _starts(context[order], self.owner[order])
        self.context = np.empty(len(order), np.int64)
        self.context[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
        self.contexts, self.member = context[order][new], self.owner[order][new]  # of a number
        self.hot = _among(self.word, hot)
        self.key = mix(self.word[self.word_of] ^ mix(context))

    def rounds(self, totals: Totals) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(t_uw of the pairs, C_w, t_w of the words) after each round. C_w and t_w of a hot word are of no use here."""
        d0, d1 = totals.discounts
        live = np.flatnonzero(self.c > 0)
        of = self.word_of[live]
        t = np.zeros(len(self.c))
        t[live] = 1
        customers = np.bincount(of, minlength=len(self.word)).astype(np.float64)
        tables = np.minimum(customers, 1)
        for r in range(totals.burn_in + totals.samples):
            p = totals.root_probability(customers, tables, totals.root)
            if totals.hot_root is not None and len(totals.hot):
                p = np.where(self.hot >= 0, totals.hot_root[self.hot], p)
            new = (STRENGTH[1] + d1 * totals.tables[self.context[live]]) * p[of]
            t[live] = seated(self.c[live], new, d1, mix(self.key[live] + np.uint64(r)))
            customers = np.bincount(of, weights=t[live], minlength=len(self.word))
            tables = seated(customers.astype(np.int64), np.full(len(self.word), totals.root_weight()), d0, mix(self.word + np.uint64(1000 + r)))
            yield t.copy(), customers, tables


def _buckets(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple[list[dict], Bucket, np.ndarray | None]]:
    """(rows of the buckets, their pairs, the totals of their contexts), small ones joined.

    Seating depends on word and context alone, so joining changes nothing.
    """
    rows, held = [], 0

    def settle() -> tuple[list[dict], Bucket, np.ndarray | None]:
        own = Bucket([x["part"] for x in rows], hot, list(range(len(rows))))
        totals = [np.concatenate([_in_order(x[k]) for x in rows]) for k in sorted(rows[0]) if k.startswith("totals")]
        if any(len(x) != len(own.contexts) for x in totals):
            raise ValueError("totals of other contexts than the bucket's")
        return rows, own, np.concatenate(totals, axis=1) if totals else None

    for batch in batches:
        for row in batch.to_pylist():
            rows.append(row)
            held += len(row["part"])
            if held >= JOINED:
                yield settle()
                rows, held = [], 0
                pa.default_memory_pool().release_unused()
    if rows:
        yield settle()


# --- totals of contexts --------------------------------------------------------------------------------------

_SENT = "bucket int, block int, n long, sums binary"


def _sums_packed(context: np.ndarray, values: np.ndarray) -> bytes:
    """Contexts in order and their counts, all whole numbers."""
    return _squeezed(_steps(context), *values.T)


def _sums_unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    context, *values = _columns(data)
    return np.cumsum(context), np.stack(values, axis=1).astype(np.float64)


def _answered(answer: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in order, and the totals of each."""
    parts = [_sums_unpacked(x["sums"]) for x in answer]
    context, values = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    order = np.argsort(context)
    return context[order], values[order]


def _sent(numbers: list[int], own: Bucket, values: np.ndarray, blocks: int) -> Iterator[tuple[int, int, int, bytes]]:
    """_SENT of what buckets have of their contexts (a row of ``values`` each)."""
    block = (((own.contexts >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero((np.diff(own.member, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    for a, b in zip(first, np.append(first[1:], len(block))):
        for low in range(a, b, CONTEXTS):
            high = min(b, low + CONTEXTS)
            yield numbers[own.member[a]], int(block[a]), int(high - low), _sums_packed(own.contexts[low:high], values[low:high])


def _sent_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["bucket", "block", "n", "sums"])


def _add_up(columns: int):
    """Parts sorted by block -> the same parts with the sums over all parts of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(held: list[dict]) -> pa.RecordBatch:
            parts = [_sums_unpacked(x["sums"]) for x in held]
            _, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            values = np.concatenate([v for _, v in parts])
            total = np.stack([np.bincount(place, weights=values[:, k])[place] for k in range(columns)], axis=1)
            ends = np.cumsum([x["n"] for x in held])
            return _sent_batch([(x["bucket"], x["block"], x["n"], _sums_packed(c, total[end - x["n"]:end]))
                                for x, (c, _), end in zip(held, parts, ends)])

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["block"] != held[0]["block"]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return run


_ADDED = "bucket int, first long, sums binary, kind string, key long, value double"


def _add_all(columns: int):
    """``_sample``'s rows sorted by block -> totals of each part without the contexts' names (but the first, for order), and the other numbers as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: list[pa.RecordBatch] = []

        def sent() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = np.asarray(batch.column(1)) >= 0
                yield batch.filter(pa.array(own)).select(["bucket", "block", "n", "sums"])
                numbers.append(batch.filter(pa.array(~own)).select(["kind", "key", "value"]))

        def out(**found) -> pa.RecordBatch:
            n = len(next(iter(found.values())))
            types = (pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.float64())
            names = [x.split()[0] for x in _ADDED.split(", ")]
            return pa.RecordBatch.from_arrays([found[c] if c in found else pa.nulls(n, t) for c, t in zip(names, types)], names)

        for batch in _add_up(columns)(sent()):
            first, sums = [], []
            for data in batch.column(3).to_pylist():
                context, values = _answered([{"sums": data}])
                first.append(context[0])
                sums.append(_squeezed(*values.T))
            yield out(bucket=batch.column(0), first=pa.array(np.array(first, np.uint64).view(np.int64)), sums=pa.array(sums, pa.binary()))
        for batch in numbers:
            yield out(**dict(zip(batch.schema.names, batch.columns)))

    return run


def _in_order(answer: list[dict]) -> np.ndarray:
    """The totals of a bucket's contexts, in the order of the contexts."""
    return np.concatenate([np.stack(_columns(x["sums"]), axis=1) for x in sorted(answer, key=lambda x: x["first"] % (1 << 64))]).astype(np.float64)


def _totals(sent: DataFrame, columns: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(bucket, ``name``: the totals of the bucket's contexts in ``columns`` columns, in parts), and the other numbers of ``_sample``."""
    rows = stored(sent.repartition("block").sortWithinPartitions("block").mapInArrow(_add_all(columns), _ADDED), f"lm-{name}", drop_shuffles=True)
    return (rows.filter("sums is not null").groupBy("bucket").agg(F.collect_list(F.struct("first", "sums")).alias(name)),
            rows.filter("kind is not null").select("kind", "key", "value"))


def _stats_rows(kinds: dict[str, dict[int, float] | np.ndarray]) -> pa.RecordBatch:
    kind, key, value = [], [], []
    for k, own in kinds.items():
        items = own.items() if isinstance(own, dict) else ((int(i), float(own[i])) for i in np.flatnonzero(own))
        for i, v in items:
            kind.append(k)
            key.append(i)
            value.append(v)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(key, pa.int64()), pa.array(value, pa.float64())], ["kind", "key", "value"])


_GATHERED = "bucket int, part binary, places array<binary>, block long, texts binary, kind string, key long, value double"


def _gather(buckets: int, hot: np.ndarray):
    """Rows sorted by bucket -> one row for each bucket, the portions' rows, and the corpus counts of this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.float64()]
        names = [x.split()[0] for x in _GATHERED.split(", ")]

        def out(n: int, /, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names)

        sums = {k: 0.0 for k in ("words", "tokens", "pairs1", "pairs2", "words1", "words2", "root")}
        hot_count, hot_root = np.zeros(len(hot)), np.zeros(len(hot))

        def settle(bucket: int, parts: list[bytes]) -> pa.RecordBatch:
            own = Bucket(parts, hot)
            live = own.c > 0
            dishes = np.bincount(own.word_of[live], minlength=len(own.word))
            cold = own.hot < 0
            np.add.at(hot_count, own.hot[~cold], own.count[~cold])
            np.add.at(hot_root, own.hot[~cold], dishes[~cold])
            for k, v in (("words", (own.count[cold] > 0).sum()), ("tokens", own.count.sum()), ("root", dishes.sum()),
                         ("pairs1", (own.c == 1).sum()), ("pairs2", (own.c == 2).sum()),
                         ("words1", (dishes[cold] == 1).sum()), ("words2", (dishes[cold] == 2).sum())):
                sums[k] += float(v)
            part = _pairs_packed(own.word[own.word_of], own.contexts[own.context], own.c, 0)
            places = [_squeezed(np.array([block]), _steps(place)) for block, place in zip(own.blocks, own.places)]
            return out(1, bucket=pa.array([bucket], pa.int32()), part=pa.array([part], pa.binary()), places=pa.array([places], pa.list_(pa.binary())))

        at, parts = None, []
        for batch in batches:
            dealt = batch.column(0).to_numpy()
            texts = np.flatnonzero(dealt < 0)
            if len(texts):
                own = batch.take(pa.array(texts))
                yield out(len(texts), block=own.column(1), texts=own.column(2))
            for i in np.flatnonzero(dealt >= 0):
                if at is not None and dealt[i] != at:
                    yield settle(at, parts)
                    parts = []
                at = int(dealt[i])
                parts.append(batch.column(2)[int(i)].as_py())
        if parts:
            yield settle(at, parts)
        found = {k: {0: v} for k, v in sums.items()} | {"hot_count": hot_count, "hot_root": hot_root}
        stats = _stats_rows(found)
        yield out(stats.num_rows, kind=stats.column(0), key=stats.column(1), value=stats.column(2))

    return run


def _sums(frame: DataFrame, size: dict[str, int]) -> dict[str, np.ndarray]:
    """kind, key, value summed: vectors of the given sizes (all fixed by parameters)."""
    out = {k: np.zeros(n) for k, n in size.items()}
    rows = frame.groupBy("kind", "key").agg(F.sum("value").alias("value")).toArrow()
    kind, key, value = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    for k in out:
        own = kind == k
        out[k][key[own].astype(np.int64)] = value[own]
    return out


def _discount(ones: float, twos: float) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


_SAMPLED = _SENT + ", kind string, key long, value double"


def _sampled_batch(rows: pa.RecordBatch, blocks: int) -> pa.RecordBatch:
    """Rows of _SENT, or of ``_stats_rows`` in blocks below 0."""
    own = dict(zip(rows.schema.names, rows.columns))
    if "key" in own:
        own["block"] = pa.array(-1 - np.asarray(own["key"]) % blocks, pa.int32())
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.float64()]
    names = [x.split()[0] for x in _SAMPLED.split(", ")]
    return pa.RecordBatch.from_arrays([own[c] if c in own else pa.nulls(rows.num_rows, t) for c, t in zip(names, types)], names)


def _count(hot: np.ndarray, blocks: int):
    """Buckets -> the sums by context of tokens and of dishes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, own, _ in _buckets(batches, hot):
            pairs = np.stack([np.bincount(own.context, weights=x, minlength=len(own.contexts)) for x in (own.c, own.c > 0)], axis=1)
            yield _sampled_batch(_sent_batch(_sent([x["bucket"] for x in rows], own, pairs, blocks)), blocks)

    return run


def _sample(shared, blocks: int):
    """Buckets with totals (the last column: T_u) -> for each sample the sums of t by context, of C_w and t_w over the words, and of t by hot word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Totals = shared.value
        n = totals.samples
        found = {"customers": np.zeros(n), "root": np.zeros(n), "hot": np.zeros(n * max(1, len(totals.hot)))}

        for rows, own, known in _buckets(batches, totals.hot):
            cold = own.hot < 0
            by_context = np.zeros((len(own.contexts), n))
            for r, (t, customers, tables) in enumerate(own.rounds(replace(totals, tables=known[:, -1]))):
                s = r - totals.burn_in
                if s >= 0:
                    by_context[:, s] = np.bincount(own.context, weights=t, minlength=len(own.contexts))
                    found["customers"][s] += customers.sum()
                    found["root"][s] += tables[cold].sum()
                    np.add.at(found["hot"], s * len(totals.hot) + own.hot[~cold], customers[~cold])
            yield _sampled_batch(_sent_batch(_sent([x["bucket"] for x in rows], own, by_context, blocks)), blocks)
        yield _sampled_batch(_stats_rows(found), blocks)

    return run


def _sampled(model: DataFrame, totals: Totals, blocks: int, name: str) -> DataFrame:
    """Fills totals.sampled by one pass over the buckets with totals; gives T_u of each sample."""
    shared = model.sparkSession.sparkContext.broadcast(totals)
    n = len(totals.hot)
    tables_of, numbers = _totals(model.mapInArrow(_sample(shared, blocks), _SAMPLED), totals.samples, name)
    got = _sums(numbers, {"customers": totals.samples, "root": totals.samples, "hot": totals.samples * max(1, n)})
    totals.sampled = []
    for s in range(totals.samples):
        customers = got["hot"][s * n:(s + 1) * n]
        tables = seated(customers.astype(np.int64), np.full(n, totals.root_weight()), totals.discounts[0], mix(totals.hot + np.uint64(1000 + totals.burn_in + s)))
        root = (float(got["customers"][s]), float(got["root"][s] + tables.sum()))
        totals.sampled.append((root, totals.root_probability(customers, tables, root)))
    return tables_of


def _score(shared):
    """Buckets with totals, in columns: c_u, first T_u, T_u that seatings start from, T_u of each sample -> answers to the portions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Totals = shared.value
        s1, d1 = STRENGTH[1], totals.discounts[1]

        for rows, own, known in _buckets(batches, totals.hot):
            p = np.zeros(len(own.c))
            u = own.context
            for r, (t, customers, tables) in enumerate(own.rounds(replace(totals, tables=known[:, 2]))):
                if r >= totals.burn_in:
                    root, hot = totals.sampled[r - totals.burn_in]
                    above = totals.root_probability(customers, tables, root)
                    if len(totals.hot):
                        above = np.where(own.hot >= 0, hot[own.hot], above)
                    p += (own.c - d1 * t + (s1 + d1 * known[u, 3 + r - totals.burn_in]) * above[own.word_of]) / (s1 + known[u, 0])
            count = own.count
            if len(totals.hot):
                count = np.where(own.hot >= 0, totals.hot_count[own.hot], count)
            count = count[own.word_of]
            cost = np.rint(np.maximum(-np.log10(p / totals.samples), 0) * STEPS)
            if not cost.max() < 1 << 32:
                raise ValueError("a probability below 1e-32")
            for number, row in enumerate(rows):
                mine = np.flatnonzero(own.owner == number)  # the bucket's pairs, in its own order
                for data in row["places"]:
                    block, place = _columns(data)
                    at = mine[np.cumsum(place).astype(np.int64)]
                    yield _dealt_batch([(row["bucket"], int(block[0]), _squeezed(cost[at], count[at]))])

    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by portion and bucket (first its texts) -> the sums of each text."""

    def settle(texts: bytes, answers: list[bytes]) -> pa.RecordBatch:
        entries, doc, n, ids, null, held, n_tokens = _columns(texts)
        cost, count = (np.concatenate(x).astype(np.float64) for x in zip(*map(_columns, answers)))
        if len(cost) != len(entries):
            raise ValueError("answers to other pairs than the portion's")
        entries, doc, n = entries.astype(np.int64), doc.astype(np.int64), n.astype(np.float64)
        known, base, score = (np.bincount(doc, weights=n * np.repeat(x, entries), minlength=len(ids))
                              for x in (count > 0, np.log10(count + 0.5), cost / -STEPS))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids.view(np.int64), mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(n_tokens.astype(np.int64)),
             pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)], [x.split()[0] for x in _SCORED.split(", ")])

    block, texts, answers = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                if block is not None:
                    yield settle(texts, answers)
                block, texts, answers = row["block"], row["part"], []
            elif row["block"] != block:
                raise ValueError("an answer without texts")
            else:
                answers.append(row["part"])
    if block is not None:
        yield settle(texts, answers)


def lm_scores(docs: DataFrame, held_out, buckets: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Learns from the rows for which the column ``held_out`` is not true and
    scores all. Null and empty texts have one token, their end. Without any
    training text, base and score come from no counts: V and N are 0. Rows
    that share a doc_id are separate rows; other columns are ignored.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"), F.encode("text", "UTF-8").alias("text"))
    hot, n = hot_words(docs)
    buckets = buckets or max(LEAST_BUCKETS, math.ceil(n / BUCKET_TOKENS))
    dealt = own.mapInArrow(_deal(buckets, hot), _DEALT)
    gathered = stored(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_gather(buckets, hot), _GATHERED), "lm-buckets", drop_shuffles=True)
    model = gathered.filter("part is not null").select("bucket", "part")

    got = _sums(gathered.filter("kind is not null").select("kind", "key", "value"),
                {"hot_count": max(1, len(hot)), "hot_root": max(1, len(hot)),
                 **{k: 1 for k in ("words", "tokens", "pairs1", "pairs2", "words1", "words2", "root")}})
    hot_seen = int((got["hot_count"] > 0).sum())
    totals = Totals(hot, tokens=int(got["tokens"][0]), words=int(got["words"][0]) + hot_seen)
    totals.discounts = (_discount(got["words1"][0], got["words2"][0]), _discount(got["pairs1"][0], got["pairs2"][0]))
    totals.root = (float(got["root"][0]), float(totals.words))
    totals.hot_count = got["hot_count"]
    totals.hot_root = totals.root_probability(got["hot_root"], np.minimum(got["hot_root"], 1), totals.root)
    # One round from one table per dish, then all rounds from the tables that it found.
    totals.burn_in, totals.samples = 0, 1
    counted, _ = _totals(model.mapInArrow(_count(hot, buckets), _SAMPLED), 2, "totals0")
    begun = _sampled(model.join(counted, "bucket"), totals, buckets, "totals1")
    totals.root, totals.hot_root = totals.sampled[-1]
    totals.burn_in, totals.samples = BURN_IN, SAMPLES
    kept = _sampled(model.join(begun, "bucket"), totals, buckets, "totals2")

    shared = docs.sparkSession.sparkContext.broadcast(totals)
    asked = gathered.filter("part is not null").select("bucket", "part", "places")
    answers = stored(asked.join(counted, "bucket").join(begun, "bucket").join(kept, "bucket").mapInArrow(_score(shared), _DEALT), "lm-answers", drop_shuffles=True)
    texts = gathered.filter("texts is not null").select(F.lit(-1).alias("bucket"), "block", F.col("texts").alias("part"))
    rest = math.log10(totals.tokens + 0.5 * (totals.words + 1))
    return texts.unionByName(answers).repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(_scored, _SCORED).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(rest)).alias("base_score"), "score")


def op5_lm_scoring(spark, sf_dir):
    """Learns from the documents whose crc32(doc_id) mod 5 is not 1."""
    return lm_scores(table(spark, sf_dir, "documents"), (doc_crc(F.col("doc_id")) % 5) == 1)
