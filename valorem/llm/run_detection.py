"""Periodic run detection on Re-Pair grammars.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(MIN_LENGTH, MIN_TIMES * q) that no neighbouring word extends.

Every pair of neighbouring words inside a run occurs at least twice in it, and
Re-Pair never replaces a pair that occurs once. So a text is cut at the pairs
that occur once, each piece again, until a piece has none; only pieces of
MIN_LENGTH words or more can hold a run. Each is compressed by Re-Pair: the
most frequent pair of symbols becomes a nonterminal until no pair repeats.

A run lies in the text of some lowest node of the derivation, so it crosses
that node's boundary (the place where its two symbols meet, or one of the
places where symbols of the start sequence meet). Boundaries of a nonterminal
are looked at once, at its first occurrence: at least half of a run lies on
one side of the boundary, so the k-gram next to the boundary on that side
comes again one period away (k = 4 for periods under 16, otherwise the
greatest power of two up to half of them); each such place gives a period,
and extending it both ways gives the stretch. Stretches of a nonterminal are
then moved to every position at which it was made, those of one period that
overlap by a period are merged, and those contained in a run of a divisor
of their period go.

A document is one row and one task's work: memory is in proportion to its
words. Nulls and texts without words have no run. Repeated rows each give a
row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.llm.common import small_batches, table
from valorem.llm.hashing import mix

MIN_LENGTH = 24
MIN_TIMES = 3
#: Nearest repeats of a k-gram that are looked up for all boundaries at once; boundaries with more are done one by one.
TOGETHER = 16

RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# ---------------------------------------------------------------- pieces

def repeated_pieces(word: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(offset, words) of the longest pieces in which every pair of neighbours occurs twice or more."""
    out, todo = [], [(0, word)]
    while todo:
        offset, piece = todo.pop()
        if len(piece) < MIN_LENGTH:
            continue
        pairs = piece[:-1] * (int(piece.max()) + 1) + piece[1:]
        order = np.argsort(pairs, kind="stable")
        same = pairs[order[1:]] == pairs[order[:-1]]
        often = np.zeros(len(pairs), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        if often.all():
            out.append((offset, piece))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
        todo += [(offset + s, piece[s:e + 1]) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())
                 if e + 1 - s >= MIN_LENGTH]
    return out


# ---------------------------------------------------------------- grammar

def repair(word: list[int]) -> tuple[list[tuple[int, int, list[int]]], list[int]]:
    """Re-Pair of a text -> nonterminals as (length of the left symbol, length, positions), and starts of the start sequence.

    A position is where a nonterminal's text begins; those of a nonterminal are all its nodes in the derivation.
    """
    n = len(word)
    symbol = list(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    length = {w: 1 for w in set(word)}
    fresh = max(word) + 1
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        places[word[i], word[i + 1]].append(i)
    heap = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(heap)
    made = []
    while heap:
        count, pair = heapq.heappop(heap)
        left, right = pair
        own, taken = [], -1
        for i in sorted(places[pair]):
            if i != taken and symbol[i] == left and (j := after[i]) < n and symbol[j] == right and (not own or own[-1] != i):
                own.append(i)
                taken = j
        if len(own) < 2:
            del places[pair]
            continue
        if len(own) < -count:  # others have taken some of its places
            places[pair] = own
            heapq.heappush(heap, (-len(own), pair))
            continue
        del places[pair]
        new, fresh = fresh, fresh + 1
        length[new] = length[left] + length[right]
        made.append((length[left], length[new], own))
        fresh_pairs = set()
        for i in own:
            j = after[i]
            k, h = after[j], before[i]
            symbol[i], symbol[j], after[i] = new, -1, k
            if k < n:
                before[k] = i
                places[new, symbol[k]].append(i)
                fresh_pairs.add((new, symbol[k]))
            if h >= 0:
                places[symbol[h], new].append(h)
                fresh_pairs.add((symbol[h], new))
        for fresh_pair in fresh_pairs:
            if len(places[fresh_pair]) > 1:
                heapq.heappush(heap, (-len(places[fresh_pair]), fresh_pair))
            else:
                del places[fresh_pair]
    return made, [i for i in range(n) if symbol[i] != -1]


# ---------------------------------------------------------------- runs over boundaries

def _equal_after(word: np.ndarray, x: int, y: int, high: int) -> int:
    """Number of equal words from x and from y on, y's ending at ``high``."""
    done, step = 0, 32
    while (left := min(step, high - y - done)) > 0:
        other = np.flatnonzero(word[x + done:x + done + left] != word[y + done:y + done + left])
        if len(other):
            return done + int(other[0])
        done, step = done + left, step * 2
    return done


def _equal_before(word: np.ndarray, x: int, y: int, low: int) -> int:
    """Number of equal words just before x and y, x's not going below ``low``."""
    done, step = 0, 32
    while (left := min(step, x - done - low)) > 0:
        other = np.flatnonzero(word[x - done - left:x - done] != word[y - done - left:y - done])
        if len(other):
            return done + left - 1 - int(other[-1])
        done, step = done + left, step * 2
    return done


def _candidates(word: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, int]]:
    """(number of the boundary, period, first word of the k-gram's earlier occurrence) for every boundary ``at``."""
    n = len(word)
    found = []
    grams = mix(word.astype(np.uint64) + np.uint64(1))
    k = 1
    shortest, longest = 1, 15
    while True:
        while k < (4 if shortest == 1 else shortest // 2):
            grams = mix(grams[:-k] * np.uint64(0x9E3779B97F4A7C15) + grams[k:])
            k *= 2
        live = np.flatnonzero(high - low >= max(MIN_LENGTH, MIN_TIMES * shortest))
        if not len(live):
            return found
        order = np.argsort(grams, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = np.flatnonzero(np.append(grams[order[1:]] != grams[order[:-1]], True)) + 1
        for side in (1, -1):
            anchor = at[live] if side == 1 else at[live] - k
            fits = (anchor >= low[live]) & (anchor + k <= high[live])
            which, anchor = live[fits], anchor[fits]
            place = rank[anchor]
            group_end = ends[np.searchsorted(ends, place, "right")]
            group_start = np.concatenate(([0], ends))[np.searchsorted(ends, place, "right")]
            for t in range(1, TOGETHER + 1):
                other = place + side * t
                ok = (other < group_end) & (other >= group_start)
                which, anchor, place, group_start, group_end, other = (v[ok] for v in (which, anchor, place, group_start, group_end, other))
                period = side * (order[other] - anchor)
                near = period <= longest
                keep = near & (period >= shortest) & (MIN_TIMES * period <= high[which] - low[which])
                first = np.minimum(order[other], anchor)
                found += zip(which[keep].tolist(), period[keep].tolist(), first[keep].tolist())
                which, anchor, place, group_start, group_end = (v[near] for v in (which, anchor, place, group_start, group_end))
                if not len(which):
                    break
            for w, a, p, s, e in zip(which.tolist(), anchor.tolist(), place.tolist(), group_start.tolist(), group_end.tolist()):
                others = order[p + TOGETHER + 1:e] if side == 1 else order[s:max(s, p - TOGETHER)]
                period = side * (others - a)
                keep = (period >= shortest) & (period <= longest) & (MIN_TIMES * period <= high[w] - low[w])
                found += [(w, q, min(a, a + side * q)) for q in period[keep].tolist()]
        shortest, longest = longest + 1, longest * 2 + 1
        if MIN_TIMES * shortest > n:
            return found


def _crossing(word: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Stretches (start, end, period) long enough to be runs that cross boundary i within [low, high), by i."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for i, q, x in sorted(set(_candidates(word, at, low, high))):
        if any(x >= s and x + q < e and (q == p or (q % p == 0 and e - s >= q)) for s, e, p in out[i]):
            continue  # the same stretch, or one whose smallest period is p
        start = x - _equal_before(word, x, x + q, int(low[i]))
        end = x + q + _equal_after(word, x, x + q, int(high[i]))
        if end - start >= max(MIN_LENGTH, MIN_TIMES * q) and start < at[i] < end:
            out[i].append((start, end, q))
    return out


def runs_of_piece(word: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal runs (start, end, period) of a piece."""
    made, starts = repair(word.tolist())
    long_ones = [rule for rule in made if rule[1] >= MIN_LENGTH]
    inner = len(long_ones)
    at = np.array([own[0] + left for left, _, own in long_ones] + starts[1:], np.int64)
    low = np.array([own[0] for _, _, own in long_ones] + [0] * (len(starts) - 1), np.int64)
    high = np.array([own[0] + size for _, size, own in long_ones] + [len(word)] * (len(starts) - 1), np.int64)
    if not len(at):
        return []
    by_period: dict[int, set[tuple[int, int]]] = defaultdict(set)
    for i, found in _crossing(word, at, low, high).items():
        moves = [0] if i >= inner else [p - long_ones[i][2][0] for p in long_ones[i][2]]
        for start, end, q in found:
            by_period[q].update((start + move, end + move) for move in moves)
    merged = []
    for q, stretches in by_period.items():
        start = end = None
        for s, e in sorted(stretches):
            if end is not None and s <= end - q:
                end = max(end, e)
            else:
                if end is not None:
                    merged.append((start, end, q))
                start, end = s, e
        merged.append((start, end, q))
    return [(s, e, q) for s, e, q in merged
            if not any(p < q and q % p == 0 and a <= s and e <= b for a, b, p in merged)]


def runs_of(word: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal runs (start, length, period) of a text given as word ids, by start and period."""
    return sorted((offset + s, e - s, q) for offset, piece in repeated_pieces(word) for s, e, q in runs_of_piece(piece))


# ---------------------------------------------------------------- Spark

def _scan(rewrite: Callable[[int | None, int], np.ndarray | None] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            found, collapsed = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or b"").split()
                index = rewrite(doc_id, len(words)) if rewrite else None
                ids: dict[bytes, int] = {}
                word = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
                if index is not None:
                    word, words = word[index], [words[i] for i in index.tolist()]
                own = runs_of(word)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                if own:
                    keep = np.ones(len(words), bool)
                    for s, n, q in own:
                        keep[s + q:s + n] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, runs (by start and period), collapsed: the words outside of runs and of each run's first period, by one space.

    Words are `[^\\x20\\x09-\\x0D]+`. ``rewrite(doc_id, n)`` may give word numbers that are taken instead of 0..n-1.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_scan(rewrite), f"doc_id long, runs {RUNS}, collapsed string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """op11's periodic texts: of every tenth id (by crc32) the words from some place on repeat."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    i[a:] = a + (i[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return i


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: their number, the one of greatest exponent, and digests of all and of the collapsed text.

    A row without doc_id keeps its own words (no periodic tail).
    """
    found = periodic_runs(table(spark, sf_dir, "documents"), planted)
    # longest first: by exact length/period, compared by cross-multiplication
    best = F.expr("aggregate(runs, cast(null as struct<start: long, length: long, period: long>), (b, r) -> "
                  "if(b is null or r.length * b.period > b.length * r.period, r, b))")
    lines = F.array_join(F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
