import hashlib

import public_tokenizers as public
import pytest
import tiktoken

import corpus_pipeline as cp
from test_decontaminate import plain as plain_hits
from test_line_dedup import BODY, plain as plain_lines
from test_simhash import plain_components, plain_fingerprint
from valorem.llm import byte_bpe, language_id, line_dedup
from valorem.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    """A small table with every odd case, and extra rows of the driver's documents."""
    own = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select(*COLUMNS).orderBy("doc_id").collect()][:50]
    text = own[1][1]
    own += [(5000, None, "en", "s", 0), (5001, "", "fr", None, 0), (5002, "123 ... !!", None, "s", 10), (5003, text, "en", "s", len(text)),
            (5003, text, "en", "s", len(text)), (None, "A text without an id, long enough to be kept as a line.", "en", "s", None),
            (5004, text + "\nand one more line that nobody else has, at the very end of it", "en", "s", 1), (5005, "word " * 30_000, "en", "s", 150_000)]
    frame = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    return frame.cache()


def test_stages_against_brute_force(spark, docs):
    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "byte_bpe"]
    stage = dict(cp.STAGES)

    told = stage["language_id"](spark, docs, sf)
    assert told.columns == COLUMNS
    model = language_id.train(docs.filter("crc32(coalesce(cast(doc_id as string), '')) % 4 <> 2"))
    want = []
    for r in rows_of(docs):
        (lang,), score = language_id.predict(model, [r[1]])
        if lang != "und" and score[0] >= cp.MIN_LANGUAGE_SCORE:
            want.append(r)
    kept = rows_of(told)
    assert kept == sorted(want, key=str) and not any(r[0] in (5000, 5001, 5002) for r in kept)

    told = told.cache()
    BODY.update({r.text: r.body for r in told.selectExpr("text", "xxhash64(text) body").collect()})
    lined = stage["line_dedup"](spark, told, sf)
    assert lined.columns == COLUMNS
    texts = {}
    for doc, text, *_ in plain_lines([(r[0], r[1]) for r in kept], line_dedup.EDITS, line_dedup.MIN_EQUAL, line_dedup.MIN_NEAR):
        if text.strip():
            texts.setdefault(doc, []).append(text)
    got = rows_of(lined)
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == sorted((d, t) for d, ts in texts.items() for t in ts if d is not None)
    assert all(r[4] == len(r[1]) for r in got)

    lined = lined.cache()
    single = stage["simhash"](spark, lined, sf)
    prints = {r: plain_fingerprint(r[1]) for r in got}
    root = plain_components(prints.values())
    groups = {}
    for r in got:
        groups.setdefault(root[prints[r]], set()).add(r[0])
    least = sorted((min((d for d in g if d is not None), default=None) for g in groups.values()), key=str)
    one = rows_of(single)
    assert sorted((r[0] for r in one), key=str) == least and set(one) <= set(got)

    single = single.cache()
    clean = rows_of(stage["decontamination"](spark, single, sf))
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    hit = {h[0] for h in plain_hits([(r[0], r[1]) for r in one], items) if h[5]}
    assert clean == [r for r in one if r[0] not in hit]

    with open(public.path(byte_bpe.VOCABULARY), "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(file.read()), special_tokens={})
    last = {r.doc_id: r for r in stage["byte_bpe"](spark, spark.createDataFrame(clean, docs.schema), sf).collect()}
    assert len(last) == len(clean)
    for r in clean:
        ids = library.encode_ordinary(r[1])
        assert last[r[0]].ids == ids and last[r[0]].n_tokens == len(ids)
        assert last[r[0]].decoded_sha256 == hashlib.sha256(r[1].encode()).hexdigest()


def test_run_and_stages_agree(spark):
    sf = "/root/testdata/sf0.001"
    whole = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in cp.run(spark, sf).collect())
    docs = table(spark, sf, "documents")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
    assert whole == sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in docs.collect())


def test_empty_table(spark, docs):
    none = docs.filter("false")
    for name, stage in cp.STAGES:
        out = stage(spark, none, "/root/testdata/sf0.001")
        assert out.collect() == []
        none = out if name != "byte_bpe" else none


def test_short_lines_that_repeat_go(spark):
    rows = [(1, "Menu\nfirst text of its own"), (2, "second text of its own\n menu \n\n目录一二\n"), (3, "目录一二\nMENU\nx")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(cp.STAGES)["line_dedup"](spark, docs, "").collect()}
    want = {1: rows[0][1], 2: "second text of its own\n\n目录一二\n", 3: "x"}
    assert got == {d: (t, len(t)) for d, t in want.items()}
