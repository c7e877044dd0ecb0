"""Profiles, upsert, trim, validation and reports on small hand-made frames."""

import math

import pandas as pd
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import prepare, profile, report, upsert, validate


def test_rescale_half_even_and_constant(spark):
    vals = list(range(0, 197))
    pdf = pd.DataFrame({"ID": [str(v) for v in vals], "Total skill": vals, "Total power": [5] * len(vals)})
    df = spark.createDataFrame(pdf)
    got = profile.rescale_1_99(df, ["Total skill", "Total power", "missing"]).orderBy(F.col("ID").cast("int")).toPandas()
    s = pdf["Total skill"]
    expect = (1 + ((s - s.min()) / (s.max() - s.min()) * 98)).round().astype(int)  # pandas rounds half to even
    assert got["Total skill"].tolist() == expect.tolist()
    assert set(got["Total power"]) == {1}
    assert got["Total skill"].min() == 1 and got["Total skill"].max() == 99


def test_histogram_last_bin_closed_and_density_integrates(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 30]], "Wage double")
    h = profile.histogram(spark, df, "Wage", 30).orderBy("bin").collect()
    assert len(h) == 30 and sum(r.n for r in h) == 11 and h[-1].n == 1
    d = profile.density(df, "Wage").orderBy("grid_index").collect()
    step = d[1].x - d[0].x
    assert abs(sum(r.density for r in d) * step - 1.0) < 0.02


def test_correlation_symmetric(spark):
    pdf = pd.DataFrame({c: [float((i * (k + 3)) % 17) for i in range(40)] for k, c in enumerate(S.CORRELATION_COLUMNS)})
    pdf.loc[3, "Age"] = None
    m = profile.correlation_matrix(spark.createDataFrame(pdf)).toPandas()
    piv = m.pivot(index="row_col", columns="col_col", values="corr")
    ref = pdf.corr()
    for a in S.CORRELATION_COLUMNS:
        for b in S.CORRELATION_COLUMNS:
            assert abs(piv.loc[a, b] - ref.loc[a, b]) < 1e-6


def test_upsert_edges(spark):
    old = spark.createDataFrame([("1", "a", 1.0), ("2", "b", 2.0), (None, "n1", 3.0)], "ID string, Name string, Value double")
    new = spark.createDataFrame([("2", "b2", 20.0, 1, "x"), ("3", "c", 30.0, 1, "y"), ("3", "c2", 31.0, 2, "z"),
                                 (None, "n2", 4.0, 1, "w")],
                                "ID string, Name string, Value double, seq int, extra string")
    got = {r.ID: r for r in upsert.keep_last(old, new, "ID", seq="seq").collect()}
    assert set(got) == {"1", "2", "3", None}
    assert got["2"].Name == "b2" and got["3"].Name == "c2" and got[None].Name == "n2" and got["1"].extra is None
    st = upsert.upsert_stats(old, new, "ID", seq="seq").first()
    assert (st.existing_rows, st.new_rows, st.merged_rows, st.added, st.removed) == (3, 4, 4, 1, 3)


def test_upsert_missing_master(spark, tmp_path):
    new = spark.createDataFrame([("1", 1.0)], "ID string, Value double")
    existing = upsert.read_existing(spark, str(tmp_path / "nope"), "parquet", new)
    assert existing.count() == 0
    assert upsert.keep_last(existing, new).count() == 1


def test_trim_edges(spark):
    rows = [("g1", "goalkeeper", 100.0), ("f1", "field", None), ("f2", "field", 10.0), ("f3", "field", 20.0),
            ("f4", "field", 30.0), ("f5", "field", 5e8)]
    df = spark.createDataFrame(rows, "ID string, segment string, Value double")
    out = {r.ID: r for r in prepare.trim_segments(df, cap=1e6, sigmas={"field": 10.0, "goalkeeper": 3.0}).collect()}
    # one-row segment: the row is its own band and stays; null Value dropped; cap applied
    assert "g1" in out and "f1" not in out
    assert out["f5"].Value == 1e6
    # a value exactly on a bound stays
    # mean 2, sample stddev exactly 1: with k = 1 the band is [1, 3], inclusive
    st = spark.createDataFrame([("a", "field", 1.0), ("b", "field", 2.0), ("c", "field", 3.0)],
                               "ID string, segment string, Value_log double")
    band = prepare.fit_band(st, "segment", {"field": 1.0})
    assert prepare.apply_band(st, band).count() == 3
    flagged = prepare.apply_band(st.union(spark.createDataFrame([("d", "field", 9.0)], st.schema)), band, drop=False)
    assert {r.ID: r.is_outlier for r in flagged.collect()} == {"a": False, "b": False, "c": False, "d": True}
    assert not math.isnan(band.first().log_sd)


def test_validate_messages(spark):
    df = spark.createDataFrame(
        [("ok", False, 22.0, 76.0, 82.0, 26000.0), ("age", False, None, 76.0, 82.0, 26000.0),
         ("wage", True, 22.0, 76.0, 82.0, -5.0), ("pot", False, 22.0, 76.0, 49.9, 10.0)],
        "ID string, is_goalkeeper boolean, Age double, `Overall rating` double, Potential double, Wage double")
    got = {r.ID: r for r in validate.validate(df).collect()}
    assert got["ok"].valid and got["ok"].error is None
    assert got["age"].error == "Age must be between 15 and 40"
    assert got["wage"].error == "Wage must be between 0 and 200,000"
    assert got["pot"].error == "Potential must be between 50 and 99"


def test_validate_rejects_what_is_no_number(spark):
    df = spark.createDataFrame(
        [("text", "abc"), ("nan", "NaN"), ("huge", "1e30"), ("none", None), ("float", "12.9")],
        "ID string, Wage string").selectExpr("*", "false AS is_goalkeeper", "22 AS Age", "70 AS `Overall rating`", "70 AS Potential")
    got = {r.ID: (r.valid, r.error, r.Wage) for r in validate.validate(df).collect()}
    for bad in ("text", "nan", "huge"):
        assert got[bad] == (False, "Wage must be a number", None)
    assert got["none"] == (True, None, 0) and got["float"] == (True, None, 12)


def test_attach_predictions_first_wins_and_fallback(spark):
    base = spark.createDataFrame([("1", "A", 10.0), ("2", "A", 11.0), ("3", "B", 12.0), ("4", "C", 13.0)],
                                 "ID string, Name string, Value double")
    gk = spark.createDataFrame([("A", 100.0, "1")], "Name string, Prediction_euros double, order string")
    fd = spark.createDataFrame([("A", 200.0, "0"), ("B", 300.0, "3")], "Name string, Prediction_euros double, order string")
    got = {r.ID: r.Prediction_euros for r in report.attach_predictions(base, [gk, fd]).collect()}
    assert got == {"1": 100.0, "2": 100.0, "3": 300.0, "4": 13.0}


def test_top_distinct_keeps_highest(spark):
    df = spark.createDataFrame([("1", "A", 20.0, 5.0), ("2", "A", 21.0, 9.0), ("3", "B", 30.0, 7.0)],
                               "ID string, Name string, Age double, Value double")
    got = report.top_distinct(df, "Name", "Value", 10, ["Name", "Age", "Value"]).collect()
    assert [(r.Name, r.Age, r.Value) for r in got] == [("A", 21.0, 9.0), ("B", 30.0, 7.0)]


def test_segment_filters(spark):
    from valorem.operators import segments
    df = segments.with_segments(spark.createDataFrame(
        [("1", "Gardien"), ("2", "milieu"), ("3", None), ("4", "attaquant"), ("5", "défenseur")],
        "ID string, `Position category` string"))
    assert sorted(r.ID for r in segments.segment_rows(df, "goalkeeper").collect()) == ["1"]
    assert sorted(r.ID for r in segments.segment_rows(df, "field").collect()) == ["2", "4", "5"]
    assert {r.ID: r["Position category"] for r in df.collect()}["3"] == "unknown"


def test_upsert_stats_empty(spark):
    e = spark.createDataFrame([], "ID string, v int")
    st = upsert.upsert_stats(e, e).first()
    assert (st.existing_rows, st.new_rows, st.merged_rows, st.added, st.removed) == (0, 0, 0, 0, 0)


def test_top_distinct_ignores_null_values_per_name(spark):
    df = spark.createDataFrame([("1", "A", 20.0, None), ("2", "A", 21.0, 3.0), ("3", "B", 30.0, None)],
                               "ID string, Name string, Age double, Value double")
    got = report.top_distinct(df, "Name", "Value", 10, ["Name", "Value"]).collect()
    assert [(r.Name, r.Value) for r in got] == [("A", 3.0), ("B", None)]


def test_rescale_with_frozen_master_stats(spark):
    from valorem.sources.tables import master
    from conftest import SF_SMALL
    m = master(spark, SF_SMALL)
    stats = profile.rescale_stats(m)
    whole = {r.ID: r for r in profile.rescale_1_99(m).collect()}
    batch = m.filter(F.col("Age") > 10)                       # a later, partial batch
    part = profile.rescale_1_99(batch, stats=stats).collect()
    assert part and all(all(r[c] == whole[r.ID][c] for c in S.TOTAL_COLUMNS) for r in part)


def test_density_exact_mode_matches_numpy_and_binned(spark):
    import numpy as np
    xs = [float(v) for v in np.random.default_rng(3).normal(50, 10, 300).round(2)]
    df = spark.createDataFrame([(x,) for x in xs], "Wage double")
    exact = profile.density(df, "Wage", fine_bins=None).orderBy("grid_index").toPandas()
    a = np.array(xs)
    h = a.std(ddof=1) * len(a) ** -0.2
    grid = np.linspace(a.min() - 3 * h, a.max() + 3 * h, 200)
    ref = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(1) / (len(a) * h * np.sqrt(2 * np.pi))
    assert np.allclose(exact["density"].to_numpy(), ref, atol=1e-9)
    binned = profile.density(df, "Wage").orderBy("grid_index").toPandas()
    # binning moves points by at most half a bin: within 0.2% of the peak everywhere
    assert np.abs(binned["density"].to_numpy() - ref).max() <= 2e-3 * ref.max()
