"""The bucketed master: only touched buckets are rewritten, one of two writers fails, statistics follow."""

import math

import pytest
from pyspark.sql import functions as F

from valorem.operators import profile
from valorem.sources import versions as V


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def people(spark, rows):
    return spark.createDataFrame(rows, "ID string, `Total 1` int, x double")


@pytest.fixture()
def path(tmp_path, spark):
    path = f"{tmp_path}/master"
    V.create(people(spark, [(str(i), i, i / 2) for i in range(200)] + [(None, 5, None)]), path, "ID", 16, ["Total 1", "x"])
    return path


def expected(rows):
    return sorted(((k, *v) for k, v in rows.items()), key=str)


def test_batches_replace_their_keys_and_leave_other_buckets(spark, path):
    want = {str(i): (i, i / 2) for i in range(200)} | {None: (5, None)}
    assert rows_of(V.read(spark, path)) == expected(want)
    before = V.current(spark, path)
    after = V.merge(people(spark, [("7", 700, 1.5), ("new", 1, None)]), path)
    want |= {"7": (700, 1.5), "new": (1, None)}
    assert rows_of(V.read(spark, path)) == expected(want)
    changed = {k for k in after.holds if after.holds[k] != before.holds.get(k)}
    assert after.number == 2 and 1 <= len(changed) <= 2
    assert {k: b for k, b in after.holds.items() if k not in changed} == {k: b for k, b in before.holds.items() if k not in changed}
    V.merge(people(spark, [(None, 6, 6.0)]), path, compact=True)
    want[None] = (6, 6.0)
    assert rows_of(V.read(spark, path)) == expected(want)
    assert rows_of(V.read(spark, path, 1))[:-1] == expected({str(i): (i, i / 2) for i in range(200)} | {None: (5, None)})[:-1]


@pytest.mark.parametrize("send_keys", [0, 1000])
def test_the_highest_sequence_wins_and_missing_columns_are_null(spark, path, send_keys):
    batch = spark.createDataFrame([("3", 1, 10), ("3", 2, 30), ("3", 3, 20), ("z", 9, 1)], "ID string, `Total 1` int, seq int")
    V.merge(batch, path, seq="seq", send_keys=send_keys)
    got = {r.ID: (r["Total 1"], r.x) for r in V.read(spark, path).collect()}
    assert got["3"] == (2, None) and got["z"] == (9, None) and len(got) == 202
    with pytest.raises(ValueError):
        V.merge(batch, path)


def test_of_two_writers_one_fails(spark, path):
    base = V.current(spark, path)
    V.merge(people(spark, [("1", -1, 0.0)]), path, base=base)
    with pytest.raises(V.ConcurrentMerge):
        V.merge(people(spark, [("1", -2, 0.0)]), path, base=base)
    got = {r.ID: r["Total 1"] for r in V.read(spark, path).collect()}
    assert got["1"] == -1 and V.current(spark, path).number == 2
    V.merge(people(spark, [("1", -2, 0.0)]), path)
    assert {r.ID: r["Total 1"] for r in V.read(spark, path).collect()}["1"] == -2
    with pytest.raises(V.ConcurrentMerge):
        V.create(people(spark, []), path, "ID", 4)


def test_statistics_follow_overwritten_extremes(spark, path):
    for batch in ([("199", 0, 0.0), ("0", 50, None)], [("a", 1000, -9.5), ("12", 3, 4.0)], [("a", 2, 2.0), (None, None, 1.0)]):
        V.merge(people(spark, batch), path)
        now = V.read(spark, path)
        want = {c: now.agg(F.count(F.col(f"`{c}`")), F.min(f"`{c}`"), F.max(f"`{c}`"), F.sum(f"`{c}`"), F.avg(f"`{c}`"), F.stddev_samp(f"`{c}`")).first()
                for c in ("Total 1", "x")}
        for r in V.stats(spark, path).collect():
            assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(r[1:], want[r.column])), (r, want)
    bounds = V.rescale_bounds(spark, path, ["Total 1"])
    got = profile.rescale_1_99(now, ["Total 1"], bounds)
    assert rows_of(got) == rows_of(profile.rescale_1_99(now, ["Total 1"]))


def test_master_rows_are_not_shuffled(spark, path):
    base = V.current(spark, path)
    fresh = V._with_bucket(people(spark, [("3", 1, 1.0)]), "ID", base.buckets)
    touched = {r[0] for r in fresh.select(V.BUCKET).collect()}
    plan = V.merged_rows(spark, base, fresh, touched)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's own, to its buckets
    assert len(base.folders(touched)) == 1


def test_empty_tables_and_batches(spark, tmp_path):
    path = f"{tmp_path}/none"
    V.create(people(spark, []), path, "ID", 8)
    assert V.current(spark, path).holds == {} and V.read(spark, path).collect() == [] and V.stats(spark, path).collect() == []
    V.merge(people(spark, []), path)
    V.merge(people(spark, [("1", 1, 1.0)]), path)
    assert rows_of(V.read(spark, path)) == [("1", 1, 1.0)] and V.current(spark, path).number == 3
    assert V.current(spark, f"{tmp_path}/nowhere") is None
