"""End-to-end jobs: the original application's main flows as Spark jobs.

* ``ingest``     stored pages -> listing rows -> upsert into the master table
                 (written as a new version) -> envelope. Totals are stored raw;
                 1..99 totals are derived master-wide (``profile.rescale_1_99``)
                 rather than per batch, so batches stay comparable.
* ``ingest_merged``  the same into a master in hash buckets: only the buckets
                 that the new rows touch are read and written, and the batch's
                 totals are scaled 1..99 by the statistics kept with the table
* ``train_job``  master -> prepared segments -> every model kind, cross-validated
                 -> whole PipelineModels saved -> test RMSE per (model, segment)
* ``score_feed`` bounded read of an envelope -> decoded -> scored by every kind
* ``stream``     the unbounded version of ``score_feed`` (Structured Streaming)

Every step is a DataFrame plan; nothing but model metadata passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.operators import metrics, profile, upsert
from valorem.plans import score, train
from valorem.sources import csv_io, feed, pages, versions
from valorem.session import materialize, scratch_path
from valorem.streaming import listener


def _listed(stored_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are kept (with ``seq``), and the status row."""
    # Parsed once: status, merge, statistics and envelope read the written rows.
    listed = materialize(pages.table_listings(stored_pages, with_rejects=True))
    # The order in which the pages list the rows decides between repeats of an ID.
    rows = listed.filter(~F.col("rejected")).withColumn("seq", F.struct("page_id", "row_index"))
    new = rows.select(*S.MASTER_COLUMNS, "seq")
    n_pages = stored_pages.agg(F.count(F.lit(1))).scalar()
    status = listed.agg(F.count_distinct("page_id").alias("pages_with_rows"),
                        F.count_if(~F.col("rejected")).alias("rows_kept"),
                        F.count_if(F.col("rejected")).alias("rows_rejected")
                        ).select(n_pages.alias("pages"), "pages_with_rows", "rows_kept", "rows_rejected")
    return new, status


def ingest(spark: SparkSession, stored_pages: DataFrame, master_path: str | None,
           fmt: str = "parquet") -> dict:
    """Extract listing rows from stored pages, upsert them into the master
    table at ``master_path`` (new rows win) and publish them.

    Returns {"status", "stats", "master_path", "envelope"}: the extraction
    status row (pages, pages with rows, rows kept, rows rejected for
    unparsable money), the upsert statistics, the path of the new master version
    and the envelope of the new rows. ``master_path`` names the table through all
    runs: each run merges into its current version and then makes the result
    the current one (``csv_io.replace``; ``csv_io.current`` resolves it).
    Of rows that repeat an ID the last listed wins. An empty extraction is reported in ``status``.
    """
    new, status = _listed(stored_pages)
    master_path = master_path or scratch_path(spark, "master-table")
    version = csv_io.current(spark, master_path)
    existing = (spark.read.format(fmt).load(version) if version else
                upsert.read_existing(spark, master_path, fmt, new.drop("seq"))).select(*S.MASTER_COLUMNS)
    merged = upsert.keep_last(existing.withColumn("seq", F.lit(None).cast(new.schema["seq"].dataType)), new, "ID", "seq").drop("source", "seq")
    target = csv_io.replace(merged.select(*S.MASTER_COLUMNS), master_path, fmt)
    return {"status": status,
            "stats": upsert.upsert_stats(existing, new.drop("seq"), "ID"),
            "master_path": target,
            "envelope": feed.publish(new.drop("seq"), key="ID", columns=S.MESSAGE_COLUMNS)}


def ingest_merged(spark: SparkSession, stored_pages: DataFrame, master_path: str, buckets: int = 64) -> dict:
    """As ``ingest``, into the bucketed table at ``master_path`` (``versions``; made by the first run).

    Returns {"status", "stats", "version", "rescaled", "envelope"}. ``stats``
    counts the rows of the versions before and after; ``rescaled`` is the batch
    with its totals on the scale of the whole merged table, whose bounds come
    from the buckets' statistics. Another writer's version in between raises
    ``versions.ConcurrentMerge`` and leaves that version as it is. Of rows that
    repeat an ID the last listed wins; a run without rows gives a version that
    holds what the one before held.
    """
    new, status = _listed(stored_pages)
    base = versions.current(spark, master_path)
    if base is None:
        version = versions.create(new, master_path, "ID", buckets, S.TOTAL_COLUMNS, seq="seq")
    else:
        version = versions.merge(new, master_path, seq="seq", base=base)
    merged = versions.read(spark, master_path, version.number).agg(F.count(F.lit(1)).alias("merged_rows"))
    before = versions.read(spark, master_path, base.number).agg(F.count(F.lit(1))).scalar() if base else F.lit(0).cast("long")
    stats = merged.select(before.alias("existing_rows"), new.agg(F.count(F.lit(1))).scalar().alias("new_rows"), "merged_rows")
    bounds = versions.rescale_bounds(spark, master_path, S.TOTAL_COLUMNS)
    batch = new.drop("seq")
    return {"status": status,
            "stats": stats.withColumn("added", F.expr("merged_rows - existing_rows")).withColumn("removed", F.expr("existing_rows + new_rows - merged_rows")),
            "version": version,
            "rescaled": profile.rescale_1_99(batch, S.TOTAL_COLUMNS, stats=bounds),
            "envelope": feed.publish(batch, key="ID", columns=S.MESSAGE_COLUMNS)}


def train_job(spark: SparkSession, master_df: DataFrame, models_dir: str | None = None,
              kinds: list[str] = S.MODEL_KINDS, tune: bool = True) -> tuple[dict, DataFrame]:
    """Fit every kind for both segments; save each as ``models_dir/<segment>_<kind>``.
    Returns (models, test RMSE per model and segment)."""
    prepared = train.prepare_training(master_df)
    models = train.fitted_models(spark, prepared, kinds, tune=tune)
    if models_dir:
        for (segment, kind), model in models.items():
            train.save(model, f"{models_dir.rstrip('/')}/{segment}_{kind}")
    scored = train.predict(models, prepared.filter(F.col("split") == "test"), kinds)
    return models, metrics.rmse(scored, ["model", "segment"])


def load_models(models_dir: str, kinds: list[str] = S.MODEL_KINDS) -> dict:
    return {(seg, k): train.load(f"{models_dir.rstrip('/')}/{seg}_{k}") for seg in S.SEGMENTS for k in kinds}


def score_feed(models: dict, envelope: DataFrame, kinds: list[str] = S.MODEL_KINDS,
               max_messages: int | None = None, factor: float = 1.0) -> DataFrame:
    """The feed from earliest to latest (with ``max_messages`` its first messages), decoded, scored by every
    kind (listener routing: 'gardien' -> goalkeeper, anything else -> field)."""
    msgs = feed.decode(feed.bounded_read(envelope, max_messages))
    return score.score_table(models, msgs, kinds, factor=factor, route_unknown_to_field=True)


def stream(spark: SparkSession, models: dict, source: DataFrame, out_path: str, reject_path: str,
           checkpoint: str, kinds: list[str] = S.MODEL_KINDS, available_now: bool = False,
           factor: float = 1.0, fmt: str = "parquet"):
    """Unbounded feed scoring; returns the running ``StreamingQuery``."""
    return listener.start(source, models, kinds, out_path, reject_path, checkpoint,
                          available_now=available_now, factor=factor, fmt=fmt)


__all__ = ["ingest", "ingest_merged", "train_job", "load_models", "score_feed", "stream"]
