"""End-to-end jobs: ingest -> train -> bounded feed scoring."""

from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import profile
from valorem.plans import jobs
from valorem.session import scratch_path
from valorem.sources import csv_io, feed, versions
from valorem.sources.tables import master

from conftest import SF_SMALL
from test_sources import _row


def test_ingest_upserts_and_reports(spark):
    page = ("<table><tbody>" + _row(pid="1") + _row(pid="2", value="€3M") + _row(pid="3", n=10)
            + _row(pid="4", value="xM") + "</tbody></table>")
    pages_df = spark.createDataFrame([(1, "u", page), (2, "v", "<p>none</p>")], "page_id long, url string, html string")
    root = scratch_path(spark, "ingest")
    first = jobs.ingest(spark, pages_df, f"{root}/master")
    m1 = spark.read.parquet(first["master_path"])
    assert sorted(r.ID for r in m1.collect()) == ["1", "2"] and m1.columns == S.MASTER_COLUMNS
    st = first["status"].first()
    assert (st.pages, st.pages_with_rows, st.rows_kept, st.rows_rejected) == (2, 1, 2, 1)
    assert first["envelope"].count() == 2
    # a second run over a re-read page: new values win, no duplicates
    page2 = "<table><tbody>" + _row(pid="2", value="€4M") + _row(pid="9") + "</tbody></table>"
    second = jobs.ingest(spark, spark.createDataFrame([(3, "w", page2)], pages_df.schema), f"{root}/master")
    assert csv_io.current(spark, f"{root}/master") == second["master_path"] != first["master_path"]
    m2 = {r.ID: r.Value for r in spark.read.parquet(second["master_path"]).collect()}
    assert m2 == {"1": 28.5e6, "2": 4e6, "9": 28.5e6}
    s2 = second["stats"].first()
    assert (s2.existing_rows, s2.new_rows, s2.merged_rows, s2.added, s2.removed) == (2, 2, 3, 1, 1)


def test_ingest_of_a_repeated_id_keeps_the_last_listed(spark):
    def page(values):
        return "<table><tbody>" + "".join(_row(pid="7", value=f"€{v}M") for v in values) + "</tbody></table>"
    rows = [(2, "u", page([1, 2, 3])), (5, "v", page([8, 4])), (3, "w", page([9]))]
    root = scratch_path(spark, "ingest-repeats")
    for parts in (1, 2, 5):
        pages_df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        run = jobs.ingest(spark, pages_df, f"{root}/master-{parts}")
        assert [r.Value for r in spark.read.parquet(run["master_path"]).collect()] == [4e6]


def test_ingest_merged_rewrites_touched_buckets_and_scales_by_kept_statistics(spark):
    schema = "page_id long, url string, html string"

    def page(*rows):
        return spark.createDataFrame([(1, "u", "<table><tbody>" + "".join(rows) + "</tbody></table>")], schema)

    path = scratch_path(spark, "ingest-merged")
    first = jobs.ingest_merged(spark, page(*[_row(pid=str(i)) for i in range(40)]), path, buckets=8)
    assert first["stats"].first().asDict() == {"existing_rows": 0, "new_rows": 40, "merged_rows": 40, "added": 40, "removed": 0}
    second = jobs.ingest_merged(spark, page(_row(pid="2", value="€3M"), _row(pid="2", value="€4M"), _row(pid="x4", value="xM")), path)
    assert second["stats"].first().asDict() == {"existing_rows": 40, "new_rows": 2, "merged_rows": 40, "added": 0, "removed": 2}
    assert second["status"].first().rows_rejected == 1
    rows = {r.ID: r.Value for r in versions.read(spark, path).collect()}
    assert len(rows) == 40 and rows["2"] == 4e6 and rows["3"] == 28.5e6
    changed = [k for k in first["version"].holds if first["version"].holds[k] != second["version"].holds[k]]
    assert len(changed) == 1
    whole = profile.rescale_1_99(versions.read(spark, path), S.TOTAL_COLUMNS)
    want = {tuple(r) for r in whole.filter("ID = '2'").select(*S.TOTAL_COLUMNS).collect()}
    assert {tuple(r) for r in second["rescaled"].select(*S.TOTAL_COLUMNS).collect()} == want
    # nothing listed: a version that holds the same rows
    third = jobs.ingest_merged(spark, spark.createDataFrame([(1, "v", "<p>none</p>")], schema), path)
    assert third["version"].holds == second["version"].holds and third["rescaled"].count() == 0
    empty = scratch_path(spark, "ingest-none")
    jobs.ingest_merged(spark, spark.createDataFrame([(1, "v", "<p>none</p>")], schema), empty)
    assert versions.read(spark, empty).count() == 0


def test_train_save_load_and_score_feed(spark):
    df = master(spark, SF_SMALL)
    root = scratch_path(spark, "jobs-models")
    models, rmse = jobs.train_job(spark, df, f"{root}/models", kinds=["forest", "linear"], tune=False)
    assert {(r.model, r.segment) for r in rmse.collect()} == {(k, s) for k in ["forest", "linear"] for s in S.SEGMENTS}
    loaded = jobs.load_models(f"{root}/models", ["forest", "linear"])
    env = feed.publish(df, key="ID", columns=S.MESSAGE_COLUMNS)
    scored = jobs.score_feed(loaded, env, ["forest", "linear"], max_messages=50)
    assert scored.count() == 100 and scored.filter(F.col("Prediction_euros").isNull()).count() == 0


def test_command_line_train_and_score(spark):
    from valorem.__main__ import main
    root = scratch_path(spark, "cli")
    master(spark, SF_SMALL).write.parquet(f"{root}/master")
    assert main(["train", "--master", f"{root}/master", "--models", f"{root}/models", "--kinds", "forest",
                 "--no-tune"]) == 0
    feed.write_envelope(feed.publish(master(spark, SF_SMALL), key="ID", columns=S.MESSAGE_COLUMNS), f"{root}/env")
    assert main(["score-feed", "--models", f"{root}/models", "--envelope", f"{root}/env", "--out", f"{root}/out",
                 "--max", "40", "--kinds", "forest"]) == 0
    assert spark.read.parquet(f"{root}/out").count() == 40


def test_command_line_ingest(spark, capsys):
    from valorem.__main__ import main
    root = scratch_path(spark, "cli-ingest")
    page = "<table><tbody>" + _row(pid="1") + _row(pid="2", value="€3M") + "</tbody></table>"
    spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string").write.parquet(f"{root}/pages")
    assert main(["ingest", "--pages", f"{root}/pages", "--master", f"{root}/master"]) == 0
    written = capsys.readouterr().out.strip().splitlines()[-1]
    assert spark.read.parquet(written).count() == 2
