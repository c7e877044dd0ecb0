"""Command line for the end-to-end jobs.

    python -m valorem ingest     --pages PAGES_PARQUET --master MASTER_PATH
    python -m valorem train      --master MASTER_PARQUET --models DIR [--kinds forest,linear] [--no-tune]
    python -m valorem score-feed --models DIR --envelope ENVELOPE_JSON --out OUT [--max 300] [--kinds ...]

Runs on the session of the launcher (``spark-submit``) or, when there is
none, on a local session.
"""

from __future__ import annotations

import argparse

from valorem import schema as S


def _session():
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from valorem.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="valorem")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="stored pages -> upserted master table")
    ing.add_argument("--pages", required=True)
    ing.add_argument("--master", required=True)
    tr = sub.add_parser("train", help="master table -> saved models, test RMSE")
    tr.add_argument("--master", required=True)
    tr.add_argument("--models", required=True)
    tr.add_argument("--kinds", default=",".join(S.MODEL_KINDS))
    tr.add_argument("--no-tune", action="store_true")
    sc = sub.add_parser("score-feed", help="bounded feed -> predictions")
    sc.add_argument("--models", required=True)
    sc.add_argument("--envelope", required=True)
    sc.add_argument("--out", required=True)
    sc.add_argument("--max", type=int, default=None, help="score only so many messages (default: all)")
    sc.add_argument("--kinds", default=",".join(S.MODEL_KINDS))
    a = p.parse_args(argv)

    from valorem.plans import jobs
    from valorem.sources import feed
    spark = _session()
    if a.cmd == "ingest":
        run = jobs.ingest(spark, spark.read.parquet(a.pages), a.master)
        run["status"].show(truncate=False)
        run["stats"].show(truncate=False)
        print(run["master_path"])
    elif a.cmd == "train":
        _, rmse = jobs.train_job(spark, spark.read.parquet(a.master), a.models, a.kinds.split(","),
                                 tune=not a.no_tune)
        rmse.orderBy("model", "segment").show(truncate=False)
    else:
        kinds = a.kinds.split(",")
        scored = jobs.score_feed(jobs.load_models(a.models, kinds), feed.read_envelope(spark, a.envelope), kinds, a.max)
        scored.write.mode("overwrite").partitionBy("model").parquet(a.out)
        print(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
