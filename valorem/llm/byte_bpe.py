"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding reads a piece byte by byte. The encoding of each prefix ends with one
token, and a token may follow another exactly when merging their joint bytes
gives the two back. A prefix is live while the bytes after it begin a longer
token. A state of the transducer is the last settled token and, for each live
prefix, the tokens since and the bytes after it. Tokens that all live prefixes
share are emitted: no later byte can change them, and the lookahead is bounded
by the longest token. States and transitions are made when a text first needs
them and are then table lookups. What short pieces have after their last
compiled transition is read for many pieces at once, from the live prefixes on.

Decoding takes ids in any portions; a UTF-8 state machine holds back the bytes
of a character that is not complete yet.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import small_batches, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Entries of the tables that a task keeps. Full tables become the older ones, which are kept until the next time.
MOST_STATES = 50_000
MOST_PIECES = 400_000
MOST_PAIRS = 400_000
#: Share of these tables for a task of the pipeline, where the stages before it have left less of an executor's memory.
PIPELINE_SHARE = 0.125
#: Times that a transition is asked for before it is compiled.
ASKED = 4
#: Longest piece that is remembered whole, and longest rest of a piece that is read without compiling transitions.
LONG_PIECE = 40
#: Pieces (encoding) or ids (decoding) that are held at once.
PORTION = 100_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@lru_cache(maxsize=4)
def narrow(pattern: str) -> re.Pattern:
    """The pattern for texts without characters above U+FFFF, its classes written out: so ``re`` can read it, which takes half the time."""
    characters = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x10000))))
    out, inside = [], False
    for part in regex.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, regex.DOTALL):
        if regex.fullmatch(r"\\[pP]\{\w+\}|\\[sSdDwW]", part):
            ranges = (m.span() for m in regex.finditer(f"{part}+", characters))
            part = "".join(f"{re.escape(characters[a])}-{re.escape(characters[b - 1])}" for a, b in ranges)
            part = part if inside else f"[{part}]"
        inside = part == "[" or inside and part != "]"
        out.append(part)
    return re.compile("".join(out))


class Nodes:
    """The trie of all tokens as arrays. Nodes are numbers, 0 is the root; ``none`` is a rank that no token has."""

    def __init__(self, ranks: dict[bytes, int], trie: dict[bytes, tuple[int | None, bool]]):
        self.none = max(ranks.values(), default=-1) + 1
        self.size = np.zeros(self.none + 1, np.int64)
        self.size[list(ranks.values())] = list(map(len, ranks))
        prefixes = sorted(trie, key=len)
        number = {b"": 0} | {prefix: i for i, prefix in enumerate(prefixes, 1)}
        parent = np.array([number[prefix[:-1]] for prefix in prefixes], np.int32)
        rank = np.array([-1 if trie[prefix][0] is None else trie[prefix][0] for prefix in prefixes], np.int64)
        length = np.array(list(map(len, prefixes)))
        self.inner = np.zeros(len(number), bool)
        self.inner[parent] = True
        self.top = np.full(len(number), -1)  # the longest token that a node's bytes begin with
        self.shorter = np.full(self.none + 1, -1)  # the next shorter token that a token begins with
        for n in range(1, length.max(initial=0) + 1):
            own = np.flatnonzero(length == n)
            above = self.top[parent[own]]
            self.top[own + 1] = np.where(rank[own] >= 0, rank[own], above)
            self.shorter[rank[own]] = above
        self.shorter[-1] = -1
        key = parent * np.int32(257) + np.array([prefix[-1] for prefix in prefixes], np.int32)
        order = np.argsort(key)
        self.edges, self.child = key[order], (order + 1).astype(np.int32)
        self.first = np.zeros(257, np.int32)
        self.first[key[parent == 0]] = np.flatnonzero(parent == 0) + 1

    def longest(self, data: np.ndarray) -> np.ndarray:
        """At each place the longest token that begins there, or -1. No token holds 256, which must come last."""
        node = self.first[data]
        at = np.flatnonzero(self.inner[node] & (data < 256))
        here, n = node[at], 1
        while len(at):
            key = here * np.int32(257) + data[at + n]
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            found = self.edges[place] == key
            at, here = at[found], self.child[place[found]]
            node[at] = here
            more = self.inner[here]
            at, here, n = at[more], here[more], n + 1
        return self.top[node]


class State:
    """What the transducer knows between two bytes."""

    __slots__ = ("before", "live", "next")

    def __init__(self, before: int | None, live: tuple[tuple[bytes, tuple[int, ...]], ...]):
        self.before = before  # the last settled token, None at the start of a piece
        self.live = live  # for each live prefix, shortest first: the bytes after it, the tokens since the settled one
        self.next: dict[int, tuple[State, tuple[int, ...]] | int] = {}  # or how often it was asked for


class Transducer:
    def __init__(self, ranks: dict[bytes, int], share: float = 1.0):
        self.ranks = ranks
        self.share = share  # of the tables' most entries
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        # Each token and prefix of one -> its rank (None: no token) and whether a longer token begins with it.
        grows = {token[:n] for token in ranks for n in range(1, len(token))}
        prefix = (None, True)
        self.trie: dict[bytes, tuple[int | None, bool]] = dict.fromkeys(grows, prefix)
        self.trie.update((token, (rank, token in grows)) for token, rank in ranks.items())
        self.nodes = Nodes(ranks, self.trie)
        self.pairs: dict[int, bool] = {}  # by left << 32 | right; a left one of ``nodes.none`` stands for none
        self.spines: dict[bytes, tuple | None] = {}
        self.start = State(None, ((b"", ()),))
        self.states: dict[tuple, State] = {}
        self.older: dict[tuple, State] = {}

    def state(self, before: int | None, live: tuple) -> State:
        key = (before, live)
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= MOST_STATES * self.share:
                self.forget()
                self.start.next.clear()
                self.older, self.states = self.states, {}
            found = self.states[key] = self.older.pop(key, None) or State(before, live)
        return found

    def forget(self) -> None:
        """Drops the older states."""
        for state in self.older.values():
            state.next.clear()  # states refer to one another in circles
        self.older = {}

    def close(self) -> None:
        """Drops all states."""
        self.forget()
        self.older, self.states = self.states, {}
        self.forget()

    def spine(self, token: bytes) -> tuple | None:
        """How a token's first and last parts grow while it is merged: two lists of (part, rank that merges it into the next).

        Merges go by least rank, leftmost first. None for a token that its own merges do not make.
        """
        if token in self.spines:
            return self.spines[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        first, last = [], []
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            if at == 0:
                first.append((parts[0], rank))
            if at == len(parts) - 2:
                last.append((parts[-1], rank))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        own = (first + [(token, 1 << 62)], last + [(token, 1 << 62)]) if len(parts) == 1 else None
        self.spines[token] = own
        return own

    def follows(self, left: int | None, right: int) -> bool:
        """May ``right`` come after ``left`` (None: first)?"""
        pair = (self.nodes.none if left is None else left) << 32 | right
        known = self.pairs.get(pair)
        return self.compared(pair) if known is None else known

    def compared(self, pair: int) -> bool:
        """May the right token come after the left one? Only if their joint bytes never merge over the border.

        At any time the border lies between one part of the left token's last
        parts and one of the right token's first parts. Their merge comes when
        its rank is below those that take either part into the next one (at
        equal ranks the leftmost merge comes first).
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        after = self.spine(self.tokens[right])
        known = after is not None
        if known and left != self.nodes.none:
            a, b, i, j = self.spine(self.tokens[left])[1], after[0], 0, 0
            while known:
                rank = self.ranks.get(a[i][0] + b[j][0], 1 << 62)
                if rank < a[i][1] and rank <= b[j][1] and rank < 1 << 62:
                    known = False
                elif a[i][1] == b[j][1] == 1 << 62:
                    break
                elif a[i][1] <= b[j][1]:
                    i += 1
                else:
                    j += 1
        if len(self.pairs) >= MOST_PAIRS * self.share:
            self.pairs.clear()
        self.pairs[pair] = known
        return known

    def follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``follows`` for each pair."""
        pairs, place = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
        pairs = pairs.tolist()
        known = [self.compared(pair) if found is None else found for pair, found in zip(pairs, map(self.pairs.get, pairs))]
        return np.array(known, bool)[place]

    def step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """Next state and the tokens that this byte settles."""
        own, before, trie = bytes((byte,)), state.before, self.trie
        end = None
        live = []
        for suffix, path in state.live:
            suffix += own
            entry = trie.get(suffix)
            if entry is None:
                continue
            token, grows = entry
            if end is None and token is not None and self.follows(path[-1] if path else before, token):
                end = (*path, token)
            if grows:
                live.append((suffix, path))
        live.append((b"", end))
        shared = live[0][1]
        if shared:
            for _, path in live:
                if path[:len(shared)] != shared:
                    shared = shared[:next(i for i, (a, b) in enumerate(zip(shared, (*path, None))) if a != b)]
        if shared:
            n, before = len(shared), shared[-1]
            live = [(suffix, path[n:]) for suffix, path in live]
        found = self.state(before, tuple(live))
        state.next[byte] = found, shared
        return found, shared

    def read(self, state: State, piece: bytes) -> tuple[list[int], State, bytes]:
        """Tokens settled from ``state`` on, the state then, and the bytes left when a transition is not compiled.

        One that was asked for ASKED times is compiled.
        """
        out: list[int] = []
        for at, byte in enumerate(piece):
            way = state.next.get(byte, 0)
            if way.__class__ is int:
                if way < ASKED and len(piece) - at <= LONG_PIECE:
                    state.next[byte] = way + 1
                    return out, state, piece[at:]
                way = self.step(state, byte)
            state, settled = way
            if settled:
                out += settled
        return out, state, b""

    def rests(self, jobs: list[tuple[State, bytes]]) -> list[tuple[int, ...]]:
        """For each state and the bytes that follow and end there: the tokens from the settled one on, without states.

        The tokens of a text are the only ones of which each may follow the
        one before it. So they are found from a live prefix on, token by token:
        the longest that may follow, and a shorter one where no way leads on.
        A place that no way leads on from is not tried again. All jobs take one
        such move at a time.
        """
        nodes = self.nodes
        size = nodes.size
        texts = [state.live[0][0] + piece for state, piece in jobs]
        ended = np.cumsum([len(text) + 1 for text in texts]) - 1
        known = np.array([len(state.live[0][0]) for state, _ in jobs])
        began = np.append(0, ended[:-1] + 1)
        first = began + known  # the last place that was read before
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32)
        data[ended] = 256  # no token goes on here
        longest = nodes.longest(data)
        left = np.full(len(data), nodes.none)  # the last token before a place
        other = np.full(len(data), -1)  # after a live prefix, the next one to be tried
        closed = np.zeros(len(data), bool)
        for n in range(int(known.max()) + 1):
            closed[began[known >= n] + n] = True  # the next token ends beyond what was read before
        places, tokens, before, following = [], [], [], []
        for (state, _), place in zip(jobs, first.tolist()):
            if state.before is None and len(state.live) == 1:
                continue
            then = -1
            for own, path in reversed(state.live):
                at = place - len(own)
                if path or state.before is not None:
                    places.append(at)
                    tokens.append(path[-1] if path else state.before)
                before.append(at)
                following.append(then)
                then = at
        left[places], other[before] = tokens, following
        at, goal, low = began.copy(), ended, first
        token = longest[at]
        while len(at):
            has = token >= 0
            end = at + size[token]
            may = has & ~closed[end]
            may[may] = self.follow(left[at[may]], token[may])
            on, less, back = np.flatnonzero(may), np.flatnonzero(has & ~may), np.flatnonzero(~has)
            left[end[on]] = token[on]
            at[on] = end[on]
            if len(back):
                closed[at[back]] = True
                live = at[back] <= low[back]
                again, back = back[live], back[~live]
                at[again] = other[at[again]]
                if (at[again] < 0).any():
                    raise ValueError("a byte that is no token")
                token[back] = left[at[back]]
                at[back] -= size[token[back]]
                on, less = np.concatenate([on, again]), np.concatenate([less, back])
            token[on] = longest[at[on]]
            token[less] = nodes.shorter[token[less]]
            going = at < goal
            at, goal, low, token = at[going], goal[going], low[going], token[going]
        # Back from the ends, over the tokens that lead there.
        used, at, job, start = np.zeros(len(data), bool), ended, np.arange(len(jobs)), np.empty(len(jobs), np.int64)
        while len(at):
            used[at] = True
            at = at - size[left[at]]
            start[job] = at
            going = at > first[job]
            at, job = at[going], job[going]
        tokens, cuts = left[used].tolist(), np.cumsum(used)[ended].tolist()
        return [next(path for own, path in state.live if len(own) == n) + tuple(tokens[a:b])
                for (state, _), n, a, b in zip(jobs, (first - start).tolist(), [0, *cuts], cuts)]

    def encode(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list = []
        jobs, heads = [], []
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                out.append((whole,))
                continue
            settled, state, left = self.read(self.start, piece)
            if left:
                heads.append((len(out), settled))
                jobs.append((state, left))
            out.append((*settled, *state.live[-1][1]))  # the last live prefix is all that was read
        for (i, settled), own in zip(heads, self.rests(jobs) if jobs else ()):
            out[i] = (*settled, *own)
        return out


class _Pieces(dict):
    """piece -> ids, by the transducer when a piece is new. The last MOST_PIECES new ones and those before are kept."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.older: dict[str, tuple[int, ...]] = {}

    def keep(self, piece: str, ids: tuple[int, ...]) -> None:
        if len(piece) <= LONG_PIECE:
            if len(self) >= MOST_PIECES * self.transducer.share:
                self.older = dict(self)
                self.clear()
            self[piece] = ids

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of pieces that are not in the table, which may drop some of them again."""
        found = {piece: self.older[piece] for piece in pieces if piece in self.older}
        new = [piece for piece in pieces if piece not in found]
        found.update(zip(new, self.transducer.encode([piece.encode() for piece in new])))
        for piece, ids in found.items():
            self.keep(piece, ids)
        return found


#: Byte classes of UTF-8 as (first, last, class); any other byte is of class 0 (never valid).
UTF8_CLASSES = [(0x00, 0x7F, 1), (0x80, 0x8F, 2), (0x90, 0x9F, 3), (0xA0, 0xBF, 4), (0xC2, 0xDF, 5), (0xE0, 0xE0, 6),
                (0xE1, 0xEC, 7), (0xED, 0xED, 8), (0xEE, 0xEF, 7), (0xF0, 0xF0, 9), (0xF1, 0xF3, 10), (0xF4, 0xF4, 11)]
#: state -> class -> state. "" is between characters; other states say what must come next. A missing entry is an error.
UTF8_STATES = {
    "": {1: "", 5: "1", 6: "after E0", 7: "2", 8: "after ED", 9: "after F0", 10: "3", 11: "after F4"},
    "1": {2: "", 3: "", 4: ""},
    "2": {2: "1", 3: "1", 4: "1"},
    "3": {2: "2", 3: "2", 4: "2"},
    "after E0": {4: "1"},
    "after ED": {2: "1", 3: "1"},
    "after F0": {3: "2", 4: "2"},
    "after F4": {2: "2"},
}
_CLASS = [0] * 256
for _first, _last, _class in UTF8_CLASSES:
    for _byte in range(_first, _last + 1):
        _CLASS[_byte] = _class


class Utf8Stream:
    """Bytes in any portions -> text; a broken sequence gives U+FFFD as soon as it is known to be broken."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for start in range(len(data) - 1, max(-1, len(data) - 4), -1):
            state: str | None = ""
            for byte in data[start:]:
                state = UTF8_STATES[state].get(_CLASS[byte])
                if state is None:
                    break
            if state:  # a character begins here and may still be completed
                cut = start
                break
            if not 0x80 <= data[start] <= 0xBF:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, share: float = 1.0):
        self.transducer = Transducer(ranks, share)
        self.pattern = regex.compile(pattern)
        self.narrow, self.wide = narrow(pattern), re.compile("[\U00010000-\U0010FFFF]")
        self.pieces = _Pieces(self.transducer)
        self.bytes_of = self.transducer.tokens.__getitem__

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids in portions."""
        return (ids for _, ids in self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[int, list[int]]]:
        """(number of the text, ids), texts in order and a long one in portions."""
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            if len(text) <= PORTION:
                portions = iter([(self.pattern if self.wide.search(text) else self.narrow).findall(text)])
            else:
                pieces = map(regex.Match.group, self.pattern.finditer(text))
                portions = iter(lambda: list(islice(pieces, PORTION)), [])
            for own in portions:
                held.append((i, own))
                size += len(own)
                if size >= PORTION:
                    yield from self._settled(held)
                    held, size = [], 0
        yield from self._settled(held)

    def _settled(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[int]]]:
        known = [list(map(self.pieces.get, pieces)) for _, pieces in held]
        new = self.pieces.learn({piece for (_, pieces), own in zip(held, known) for piece, ids in zip(pieces, own) if ids is None})
        for (i, pieces), own in zip(held, known):
            yield i, list(chain.from_iterable([ids or new[piece] for piece, ids in zip(pieces, own)]))

    def decode(self, ids: Iterable[int]) -> Iterator[bytes]:
        """Bytes in portions; unknown ids raise."""
        ids = iter(ids)
        while own := list(islice(ids, PORTION)):
            yield b"".join(map(self.bytes_of, own))

    def close(self) -> None:
        self.transducer.close()
        self.pieces.clear()
        self.pieces.older = {}

    def text(self, ids: Iterable[int]) -> str:
        stream = Utf8Stream()
        return "".join(chain(map(stream.feed, self.decode(ids)), iter([stream.close()])))


#: The codec that this worker's last task has left, by vocabulary.
_LEFT: dict[bytes, Codec] = {}


@contextmanager
def _codec(data: bytes, share: float = 1.0):
    """A codec for one task. With whole tables it stays for the worker's next task, which need not fill them again.

    The tables are bounded, whatever the number of tasks, and Spark ends
    workers that have been idle for a minute. With a share of them, room is
    scarce, and they go with the task.

    The cyclic collector rests meanwhile: it would walk the tables again and
    again, and they undo their circles themselves.
    """
    collecting = gc.isenabled()
    gc.disable()
    key = hashlib.sha256(data).digest()
    codec = _LEFT.pop(key, None) if share == 1.0 else None
    for other in list(_LEFT):
        _LEFT.pop(other).close()
    codec = codec or Codec(read_ranks(data), share=share)
    left = False
    try:
        yield codec
        left = share == 1.0
    finally:
        if left:
            _LEFT[key] = codec
        else:
            codec.close()
        if collecting:
            gc.enable()


def _vocabulary(docs: DataFrame, path: str | None):
    """The rank file (a fixed 0.8 MB) as a broadcast, read where the driver has it."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of ``docs`` without text, and ids (array<int>). Null text is empty; no special tokens."""
    names = [c for c in docs.columns if c not in ("text", "ids")]
    shared = _vocabulary(docs, path)
    own = docs.select(*names, F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared.value) as codec:
            for batch in small_batches(batches, 500):
                ids: list[list[int]] = [[] for _ in range(batch.num_rows)]
                for i, own in codec.encode_all(t or "" for t in batch.column(len(names)).to_pylist()):
                    ids[i] += own
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"])

    schema = own.drop("text").withColumn("ids", F.array().cast("array<int>")).schema
    return own.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of ``encoded`` without ids, and text. Null ids are empty."""
    names = [c for c in encoded.columns if c not in ("ids", "text")]
    shared = _vocabulary(encoded, path)
    own = encoded.select(*names, F.col("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared.value) as codec:
            for batch in small_batches(batches, 500):
                texts = [codec.text(ids or ()) for ids in batch.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*names, "text"])

    return own.mapInArrow(run, own.drop("ids").withColumn("text", F.lit("")).schema)


def round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False, share: float = 1.0) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids): each text encoded and its ids decoded.

    One row per input row. Null and empty texts have no tokens. Other columns are ignored.
    ``share`` of the tables' most entries are kept; it changes time and memory, not the ids.
    """
    shared = _vocabulary(docs, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    types = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared.value, share) as codec:
            name = [str(i) for i in range(max(codec.transducer.tokens) + 1)].__getitem__
            for batch in small_batches(batches, 500):
                rows: list[tuple] = []
                for _, portions in groupby(codec.encode_all(text or "" for text in batch.column(1).to_pylist()), itemgetter(0)):
                    n, ids_sha, back, kept, stream = 0, hashlib.sha256(), hashlib.sha256(), [], Utf8Stream()
                    for _, ids in portions:
                        ids_sha.update((" " * bool(n) + " ".join(map(name, ids))).encode())
                        n += len(ids)
                        for data in codec.decode(ids):
                            back.update(stream.feed(data).encode())
                        if with_ids:
                            kept += ids
                    back.update(stream.close().encode())
                    rows.append((n, ids_sha.hexdigest(), back.hexdigest(), kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def op7_byte_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))
