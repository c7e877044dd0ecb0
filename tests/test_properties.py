"""Property tests (few examples each: every example is a Spark job)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions import clean
from valorem.operators import profile, upsert

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=40))
def test_rescale_bounded_and_monotone(spark, values):
    pdf = pd.DataFrame({"ID": [str(i) for i in range(len(values))], "Total skill": values})
    got = profile.rescale_1_99(spark.createDataFrame(pdf), ["Total skill"]).toPandas()
    got["raw"] = values
    assert got["Total skill"].between(1, 99).all()
    s = got.sort_values("raw")
    assert (s["Total skill"].diff().fillna(0) >= 0).all()
    if len(set(values)) > 1:
        assert got["Total skill"].min() == 1 and got["Total skill"].max() == 99


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9)), min_size=0, max_size=12),
       st.lists(st.tuples(st.sampled_from(["b", "c", "d", None]), st.integers(0, 9)), min_size=1, max_size=12))
def test_upsert_idempotent_and_new_wins(spark, old_rows, new_rows):
    schema = "ID string, v int"
    old = spark.createDataFrame(old_rows, schema)
    new = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(new_rows)], "ID string, v int, seq int")
    once = upsert.keep_last(old, new, seq="seq").drop("source")
    twice = upsert.keep_last(once, new, seq="seq").drop("source")
    assert sorted(once.collect(), key=str) == sorted(twice.select(*once.columns).collect(), key=str)
    last_new = {}
    for k, v in new_rows:
        last_new[k] = v
    got = {r.ID: r.v for r in once.collect()}
    for k, v in last_new.items():
        assert got[k] == v
    assert set(got) == {k for k, _ in old_rows} | set(last_new)


@SETTINGS
@given(st.decimals(min_value=0, max_value=999, places=1, allow_nan=False),
       st.sampled_from(["M", "K", ""]))
def test_money_round_trip(spark, amount, suffix):
    text = f"€{amount}{suffix}"
    got = spark.createDataFrame([(text,)], "t string").transform(lambda d: clean.with_money(d, {"v": "t"})).first()["v"]
    mult = {"M": 1e6, "K": 1e3, "": 1.0}[suffix]
    assert got == float(str(amount)) * mult


def test_segment_sets_are_disjoint(spark):
    assert not set(S.GOALKEEPER_INDEXES) & set(S.FIELD_INDEXES)
    idx = spark.range(6).select(F.col("id").cast("double").alias("i"))
    segs = [r[0] for r in idx.select(clean.model_segment("i")).collect()]
    assert segs == ["field", "field", "field", "goalkeeper", None, None]


@SETTINGS
@given(st.lists(st.tuples(st.booleans(), st.floats(min_value=0, max_value=120, allow_nan=False),
                          st.floats(min_value=30, max_value=120, allow_nan=False),
                          st.floats(min_value=30, max_value=120, allow_nan=False),
                          st.floats(min_value=-10, max_value=3e5, allow_nan=False),
                          st.integers(min_value=-5, max_value=120)), min_size=1, max_size=8))
def test_validation_matches_ranges(spark, reqs):
    from valorem.operators import validate
    others = list(dict.fromkeys(f for f in S.GOALKEEPER_FEATURES + S.FIELD_FEATURES if f not in S.SHARED_FEATURES))
    rows = [(str(i), gk, a, o, p, w, *[x] * len(others)) for i, (gk, a, o, p, w, x) in enumerate(reqs)]
    schema = ("ID string, is_goalkeeper boolean, Age double, `Overall rating` double, Potential double, Wage double, "
              + ", ".join(f"`{f}` int" for f in others))
    got = {r.ID: r for r in validate.validate(spark.createDataFrame(rows, schema)).collect()}
    for i, (gk, a, o, p, w, x) in enumerate(reqs):
        checks = [("Age", int(a), 15, 40), ("Overall rating", int(o), 50, 99), ("Potential", int(p), 50, 99),
                  ("Wage", int(w), 0, 200000)]
        seg = S.GOALKEEPER_FEATURES if gk else S.FIELD_FEATURES
        checks += [(f, x, 1, 99) for f in seg if f not in S.SHARED_FEATURES]
        first_bad = next((f for f, v, lo, hi in checks if not lo <= v <= hi), None)
        r = got[str(i)]
        assert r.valid == (first_bad is None)
        assert (r.error is None) if first_bad is None else r.error.startswith(first_bad + " must be")
