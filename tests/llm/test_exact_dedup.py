import hashlib

import pytest

from valorem.llm import exact_dedup as ed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    out = []
    for doc, text in rows:
        norm = (text or "").translate(LOWER)
        keep = max((d for d in groups[norm] if d is not None), default=None)
        out.append((doc, keep, len(groups[norm]), doc == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(1, None), (2, ""), (3, "É a"), (4, "é a"), (5, "É A"), (6, "x" * 200_000), (7, "X" * 200_000), (8, "tie"), (8, "tie"),
         (None, "TIE"), (None, "alone without an id"), (None, "alone without an id"), (9, "İ"), (10, "i̇"), (11, "K"), (12, "K")]
        + [(100 + i, f"text {i % 37}") for i in range(300)] + [(1000 + i, "hot") for i in range(200)])


@pytest.mark.parametrize("capacity, max_depth, key_bits", [(4096, 16, 64), (4, 16, 64), (4, 3, 64), (4, 16, 3), (1, 5, 1)])
def test_against_brute_force(spark, capacity, max_depth, key_bits):
    docs = spark.createDataFrame([(*r, 1, "n") for r in ROWS], "doc_id long, text string, key int, norm string").repartition(4)
    got = sorted((tuple(r) for r in ed.exact_dedup(docs, capacity, max_depth, key_bits).collect()), key=str)
    assert got == plain(ROWS)


def test_directory_splits_until_buckets_fit(spark):
    keys = ed.keyed(spark.range(3000).selectExpr("id doc_id", "cast(id as string) text"))
    slots = ed.directory(keys, capacity=50, max_depth=10)
    held = (keys.withColumn("slot", ed.slot(10)).join(slots, "slot").groupBy("bucket", "local_depth").count().collect())
    assert sum(r["count"] for r in held) == 3000
    assert all(r["count"] <= 50 for r in held)
    ranges = sorted((r.bucket, r.bucket + (1 << (10 - r.local_depth))) for r in held)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    # a bucket was split only because the range around it was overfull
    for r in held:
        size = 1 << (10 - r.local_depth + 1)
        around = r.bucket // size * size
        assert sum(x["count"] for x in held if around <= x.bucket < around + size) > 50


def test_empty(spark):
    assert ed.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = ed.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
