import hashlib

import pytest

from valorem.llm import warc_fixity as wf


def digest(url, html):
    html = html or ""
    body = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\n"
            f"Content-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n").encode()
    return len(body), hashlib.sha256(body).hexdigest()


def plain(a, b):
    """(page_id, length, digest, status) by comparing all records."""
    def counted(rows):
        out = {}
        for page, url, html in rows:
            key = (page, *digest(url, html))
            out[key] = out.get(key, 0) + 1
        return out
    one, two = counted(a), counted(b)
    pages_one, pages_two = {k[0] for k in one}, {k[0] for k in two}
    out = [(*k, "ok" if two.get(k) == n else "changed" if k[0] in pages_two else "missing") for k, n in one.items()]
    return sorted(out + [(*k, "extra") for k in two if k[0] not in pages_one], key=str)


def pages():
    out = [(i, f"http://h{i % 3}.example/{i}", f"<p>{'body ' * (i * 37 % 90)}{i}</p>") for i in range(0, 900, 2)]
    out += [(4, "http://h/4", "twice"), (4, "http://h/4", "twice"), (4, "http://other/4", "another"), (None, "u", "null id"), (None, None, None),
            (-7, "http://neg", "x"), (70_000_000, "http://far", "é" * 300_000), (11, "", ""), (12_345, None, "")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int").repartition(3)


def faults():
    own = pages()
    hurt = [(p, u, h[:-1] + "#") if p == 100 else (p, u, h + "!") if p == 300 else (p, (u or "") + "?", h) if p == 70_000_000 else (p, u, h)
            for p, u, h in own if p not in (20, 22, 898)]
    hurt.remove((4, "http://h/4", "twice"))
    return hurt + [(21, "http://new", "extra"), (900_000_000, "http://new", "extra")]


@pytest.mark.parametrize("small", [False, True])
def test_against_all_records(spark, monkeypatch, small):
    if small:  # several ranges, levels and parts
        monkeypatch.setattr(wf, "RANGE", 700)
        monkeypatch.setattr(wf, "FANOUT_BITS", 2)
        monkeypatch.setattr(wf, "ARCHIVE_RECORDS", 20)
    a, b = pages(), faults()
    got = wf.audit(frame(spark, a), frame(spark, b))
    assert got.columns == ["page_id", "archive", "offset", "length", "digest", "status"]
    rows = got.collect()
    assert sorted(((r.page_id, r.length, r.digest, r.status) for r in rows), key=str) == plain(a, b)
    assert {r.status for r in rows} == {"ok", "changed", "missing", "extra"}
    # records of an archive follow one another without gaps
    ends = {}
    for r in sorted((r for r in rows if r.status != "extra"), key=lambda r: (r.archive, r.offset)):
        assert r.offset == ends.get(r.archive, 0)
        ends[r.archive] = r.offset + r.length


def test_same_replicas_need_one_look(spark):
    both = wf.packed(frame(spark, pages()))
    from pyspark.sql import functions as F
    differ, seen = wf.differing_ranges(both.withColumn("replica", F.lit(0)).unionByName(both.withColumn("replica", F.lit(1))))
    assert differ.count() == 0
    rows = {r.level: r.compared for r in seen.collect()}
    assert sum(rows.values()) == rows[max(rows)] <= 3  # only roots (null ids and negative ids have their own) were compared


def test_descends_only_where_replicas_differ(spark, monkeypatch):
    monkeypatch.setattr(wf, "RANGE", 700)
    monkeypatch.setattr(wf, "FANOUT_BITS", 2)
    from pyspark.sql import functions as F
    rows = [r for r in pages() if r[0] is not None and 0 <= r[0] < 900]
    hurt = [(p, u, "#" + h[1:]) if p == 400 else (p, u, h) for p, u, h in rows]
    records = wf.packed(frame(spark, rows)).withColumn("replica", F.lit(0)).unionByName(wf.packed(frame(spark, hurt)).withColumn("replica", F.lit(1)))
    differ, seen = wf.differing_ranges(records)
    assert differ.count() == 1
    assert all(r.differ == 1 and r.compared <= 4 for r in seen.collect())


def test_empty(spark):
    none = frame(spark, pages()).filter("false")
    assert wf.audit(none, none).collect() == []
    assert {r.status for r in wf.audit(frame(spark, pages()), none).collect()} == {"missing"}
    assert {r.status for r in wf.audit(none, frame(spark, pages())).collect()} == {"extra"}


@pytest.mark.parametrize("small", [False, True])
def test_records_added_to_known_pages(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(wf, "RANGE", 700)
        monkeypatch.setattr(wf, "FANOUT_BITS", 2)
        monkeypatch.setattr(wf, "ARCHIVE_RECORDS", 20)
    a = pages()
    more = [(6, "http://h0.example/6", "foreign"), (None, "u", "another null id"), (300, "u", "one")]
    b = [(p, u, h + "!") if p in (300, 500) else (p, u, h) for p, u, h in a] + more + [(4, "http://h/4", "twice")]
    rows = wf.audit(frame(spark, a), frame(spark, b)).collect()
    changed = next((300, *digest(u, h + "!")) for p, u, h in a if p == 300)
    added = [(p, *digest(u, h)) for p, u, h in more] + [changed]
    assert sorted(((r.page_id, r.length, r.digest) for r in rows if r.status == "added"), key=str) == sorted(added, key=str)
    assert sorted(((r.page_id, r.length, r.digest, r.status) for r in rows if r.status != "added"), key=str) == plain(a, b)
