import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken

from valorem.llm import byte_bpe as bb


@pytest.fixture(scope="module")
def ranks():
    with open(public.path(bb.VOCABULARY), "rb") as file:
        return bb.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    out = ["", " ", "a", "   \n\n  x  ", "don't I'll we've", "日本語テキスト 🙂👩‍👩‍👧 ñandú", "<|endoftext|>", "1234567 89", "a\x1cb\x85c d e",
           "ab" * 3000, "a" * 5000, " " * 3000 + "x", "=" * 700, "xyz-" * 900, "é" * 999, "\U0001F600" * 50]
    alphabets = ["abcdeth ", "aAbB \n\t'", "01 .,;!?-=", "éèßñü abc", "日本語 한국어 ру", "".join(map(chr, range(32, 127)))]
    for a in alphabets:
        out += ["".join(rng.choice(a) for _ in range(n)) for n in (5, 50, 400, 4000)]
    out.append("".join(chr(c) for c in range(1, 0x3000)))
    out.append("".join(chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(3000)))
    return out


def test_ids_are_those_of_the_library(ranks, library):
    codec = bb.Codec(ranks)
    for t in texts():
        ids = [i for portion in codec.encode(t) for i in portion]
        assert ids == library.encode_ordinary(t), repr(t[:40])
        assert b"".join(codec.decode(ids)) == t.encode()
        assert codec.text(ids) == t


def test_small_tables_and_portions(ranks, library, monkeypatch):
    monkeypatch.setattr(bb, "MOST_STATES", 50)
    monkeypatch.setattr(bb, "MOST_PAIRS", 50)
    monkeypatch.setattr(bb, "MOST_PIECES", 3)
    monkeypatch.setattr(bb, "PORTION", 7)
    codec = bb.Codec(ranks)
    for t in texts()[:30]:
        assert [i for portion in codec.encode(t) for i in portion] == library.encode_ordinary(t)


def test_lookahead_is_bounded(ranks):
    own = bb.Transducer(ranks)
    longest = max(map(len, ranks))
    rng = random.Random(9)
    for data in (b"a" * 3000, b"ab" * 2000, b"=" * 2000, bytes(rng.choice(b"etaoin") for _ in range(5000)), bytes(rng.randrange(256) for _ in range(3000))):
        state, read, settled = own.start, 0, 0
        for byte in data:
            state, out = own.step(state, byte)
            read, settled = read + 1, settled + sum(len(own.tokens[t]) for t in out)
            assert read - settled <= 4 * longest


def test_utf8_stream_in_all_cuts():
    data = "aé日🙂z".encode() + b"\xff\xc3(\xe2\x82 \xf0\x9f\x99 \x80\xed\xa0\x80\xc0\xaf" + "é".encode() + b"\xf0\x9f"
    whole = data.decode("utf-8", "replace")
    for size in range(1, 7):
        stream = bb.Utf8Stream()
        assert "".join(stream.feed(data[i:i + size]) for i in range(0, len(data), size)) + stream.close() == whole
    stream = bb.Utf8Stream()
    assert [stream.feed(bytes((b,))) for b in "é🙂".encode()] == ["", "é", "", "", "", "🙂"]


def test_tables(spark, library):
    rows = [(i, t) for i, t in enumerate(texts()) if "\x00" not in t] + [(None, "null id"), (900, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n_tokens int, ids_sha256 string").repartition(3)
    want = []
    for doc, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bb.round_trip(docs).collect()), key=str) == sorted(want, key=str)
    encoded = bb.encode(docs)
    assert sorted(len(r.ids) for r in encoded.collect()) == sorted(w[1] for w in want)
    assert sorted(r.text for r in bb.decode(encoded).collect()) == sorted(t or "" for _, t in rows)
    assert bb.round_trip(docs.filter("false")).collect() == []


def test_whole_table_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in bb.op7_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_a_share_of_the_tables_bounds_them_and_keeps_the_ids(ranks, monkeypatch):
    """The pipeline's tasks take a share: with whole tables they passed an executor's memory."""
    monkeypatch.setattr(bb, "MOST_STATES", 100)
    monkeypatch.setattr(bb, "MOST_PIECES", 100)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abeinrstéß7") for _ in range(rng.randint(1, 12))) for _ in range(60)) for _ in range(20)]
    whole, small = bb.Codec(ranks), bb.Codec(ranks, share=0.2)
    for text in texts:
        assert list(whole.encode(text)) == list(small.encode(text))
        assert len(small.pieces) <= 20 and len(small.pieces.older) <= 20 and len(small.transducer.states) <= 21
    assert len(whole.pieces) > 20 or len(whole.pieces.older) > 20


def test_pieces_of_a_batch_are_read_together(ranks, library, monkeypatch):
    """New pieces go through the transducer at once, from whatever state their compiled transitions end in."""
    calls = []
    rests = bb.Transducer.rests
    monkeypatch.setattr(bb.Transducer, "rests", lambda self, jobs: calls.append(len(jobs)) or rests(self, jobs))
    rng = random.Random(11)
    words = ["".join(rng.choice("abeinrstéß日") for _ in range(rng.randint(2, 45))) for _ in range(400)]
    own = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(60)] + ["", "a" * 300, "\U0001F600 x\x1c\x85y"]
    codec = bb.Codec(ranks)
    for _ in range(3):
        got = [[] for _ in own]
        for i, ids in codec.encode_all(own):
            got[i] += ids
        assert got == [library.encode_ordinary(t) for t in own]
        codec.pieces.clear()
        codec.pieces.older = {}
    assert max(calls) > 300 and len(codec.transducer.states) > 100


def test_jobs_from_any_state(ranks, library):
    """Wherever a piece's transitions end, the rest gives the library's tokens."""
    own = bb.Transducer(ranks)
    rng = random.Random(12)
    want, heads, jobs = [], [], []
    for _ in range(300):
        piece = "".join(rng.choice("aeinrstéß日=") for _ in range(rng.randint(2, 30))).encode()
        state, settled, cut = own.start, [], rng.randrange(len(piece))
        for byte in piece[:cut]:
            state, out = own.step(state, byte)
            settled += out
        want.append(library._encode_single_piece(piece))
        heads.append(settled)
        jobs.append((state, piece[cut:]))
    assert sum(len(state.live) > 1 for state, _ in jobs) > 100
    assert [[*head, *rest] for head, rest in zip(heads, own.rests(jobs))] == want


def test_narrow_pattern_cuts_alike():
    import regex

    whole, narrow = regex.compile(public.PATTERN), bb.narrow(public.PATTERN)
    characters = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    rng = random.Random(13)
    for alphabet in ("ab 1.'\n\tsSlL", "  \x1c\x85\xa0 x'", "é日 ñ 한٣½　'll", characters):
        for _ in range(300):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert narrow.findall(text) == whole.findall(text), repr(text)
    assert narrow.findall(characters) == whole.findall(characters)


def test_a_workers_next_task_has_the_tables(ranks):
    with open(public.path(bb.VOCABULARY), "rb") as file:
        data = file.read()
    with bb._codec(data) as first:
        want = list(first.encode("tables that stay"))
    with bb._codec(data) as again:
        assert again is first and len(again.pieces) and list(again.encode("tables that stay")) == want
        with bb._codec(data) as beside:
            assert beside is not again
    with bb._codec(data, 0.2) as small:
        assert small is not first and not bb._LEFT and not first.pieces
    assert not bb._LEFT and not small.pieces


def test_full_tables_do_not_encode_pieces_alone(ranks, library, monkeypatch):
    """When a table is full in the middle of a portion, what the older one held is not encoded again piece by piece."""
    calls = []
    encode = bb.Transducer.encode
    monkeypatch.setattr(bb.Transducer, "encode", lambda self, pieces: calls.append(len(pieces)) or encode(self, pieces))
    monkeypatch.setattr(bb, "MOST_PIECES", 200)
    rng = random.Random(14)
    words = ["".join(rng.choice("abeinrst") for _ in range(8)) for _ in range(300)]
    codec = bb.Codec(ranks)
    for _ in range(8):
        own = [" ".join(rng.sample(words, 150))]
        assert [i for _, ids in codec.encode_all(own) for i in ids] == library.encode_ordinary(own[0])
    assert len(calls) == 8
