"""Runs of page numbers: gaps, repeats, listings over several ranges."""

import random

import pytest

from valorem import schema as S
from valorem.sources import pages


def plain(rows):
    out = []
    for listing in {x for x, n in rows if n is not None}:
        numbers = [n for x, n in rows if x == listing and n is not None]
        runs = []
        for n in sorted(set(numbers)):
            if runs and runs[-1][1] + 1 == n:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        for i, (a, b) in enumerate(runs):
            repeats = sum(a <= n <= b for n in numbers) - (b - a + 1)
            out.append((listing, a, b, b - a + 1, repeats, a - runs[i - 1][1] - 1 if i else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_runs_of_many_listings(spark, partitions):
    rng = random.Random(int(partitions))
    rows = [(rng.choice(["a", "b", "", None]), rng.choice([None, *range(60)])) for _ in range(150)]
    rows += [("huge", n) for n in range(3000) if n not in (700, 701, 2999)] + [("one", 4)] * 5
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pages.page_runs(spark.createDataFrame(rows, "listing string, page_no long"))
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_manifest_offsets(spark):
    base = "https://example.org/list?offset="
    stored = spark.createDataFrame([(i, base + str(o), "") for i, o in enumerate((0, 60, 180, 180, 75))], "page_id long, url string, html string")
    numbered = pages.manifest_pages(stored, base).selectExpr("'players' listing", "page_no")
    assert sorted(map(tuple, pages.page_runs(numbered).collect())) == [("players", 0, 1, 2, 0, None), ("players", 3, 3, 1, 1, 1)]
    assert S.PAGE_ROWS == 60


def test_no_pages(spark):
    assert pages.page_runs(spark.createDataFrame([], "listing string, page_no long")).collect() == []
