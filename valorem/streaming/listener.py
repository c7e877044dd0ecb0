"""Structured Streaming scoring of the message feed.

``readStream`` over the envelope (a broker topic, or JSON files of the same
envelope in a shared folder) -> JSON decode (PERMISSIVE; malformed messages go
to a reject output) -> routing ('gardien' -> goalkeeper models, everything else
-> field models) -> ``foreachBatch`` scoring with every model kind ->
append-style output partitioned by ``batch_id`` and ``model_type``.

Replay safety: each micro-batch writes only its own ``batch_id=`` partitions
with dynamic partition overwrite, so a batch re-run after a failure (same
checkpoint, same batch id) replaces its earlier output instead of
duplicating it. The offsets in the checkpoint replace the original's listener
thread, polling sleep, message cap and retry loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from valorem import schema as S
from valorem.functions.clean import feed_route
from valorem.plans import train
from valorem.sources import feed


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(S.ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def broker_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, retries: int = 5) -> DataFrame:
    """Broker source (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting)
              .option("fetchOffset.numRetries", retries))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                           "partition", "offset", "timestamp")


def decoded(stream: DataFrame) -> DataFrame:
    msgs = feed.decode(stream, keep=["key", "partition", "offset"], corrupt_column="_corrupt")
    return msgs.withColumn("segment", feed_route("Position category"))


def _writer(df: DataFrame, fmt: str):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    return w.option("header", True) if fmt == "csv" else w


def batch_scorer(models: dict, kinds: list[str], out_path: str, reject_path: str, factor: float = 1.0,
                 fmt: str = "parquet"):
    """foreachBatch function: score one micro-batch with every kind, write it
    under its own batch_id partition (dynamic overwrite). ``fmt`` is the
    output format (parquet, or csv with a header as report files)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = batch.filter(F.col("_corrupt").isNull())
            scored = train.predict(models, good, kinds)
            lacking = F.coalesce(*[F.when(F.col("segment") == s, train.missing_features(s)) for s in S.SEGMENTS])
            bad = (batch.withColumn("_lacks", F.when(F.col("_corrupt").isNull(), lacking))
                   .filter(F.col("_corrupt").isNotNull() | (F.size("_lacks") > 0))
                   .select(F.lit(batch_id).alias("batch_id"), "key", "partition", "offset",
                           F.coalesce("_corrupt", F.to_json(F.struct("Name", "ID"))).alias("value"),
                           F.when(F.col("_corrupt").isNotNull(), F.lit("not a message"))
                           .otherwise(F.concat(F.lit("no value for "), F.array_join("_lacks", ", "))).alias("reason")))
            if not bad.isEmpty():  # the batch is persisted: a cheap check that skips an empty write
                _writer(bad, fmt).partitionBy("batch_id").save(reject_path)
            out = scored.filter(F.size("missing_features") == 0).select(
                F.lit(batch_id).alias("batch_id"), F.col("model").alias("model_type"), "key", "partition",
                "offset", "Name", "segment", (F.expm1("prediction") * F.lit(factor)).alias("Prediction_euros"))
            _writer(out, fmt).partitionBy("batch_id", "model_type").save(out_path)
        finally:
            batch.unpersist()

    return run


def start(stream: DataFrame, models: dict, kinds: list[str], out_path: str, reject_path: str,
          checkpoint: str, available_now: bool = False, interval: str = "5 seconds",
          factor: float = 1.0, fmt: str = "parquet") -> StreamingQuery:
    w = (decoded(stream).writeStream.foreachBatch(batch_scorer(models, kinds, out_path, reject_path, factor, fmt))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
