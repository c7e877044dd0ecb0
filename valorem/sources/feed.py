"""Keyed message envelope: publish, decode, bounded read, file sink/source.

Envelope columns: ``key, value, topic, partition, offset, timestamp`` — the
shape of a broker record. A published row has a key, a JSON value and a
topic; partition and offset are the broker's to give and are null until a
source that has them (``read_broker``) delivers the record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from valorem import schema as S

DEFAULT_TOPIC = "entities"


def publish(df: DataFrame, key: str = "ID", columns: list[str] | None = None, topic: str = DEFAULT_TOPIC,
            timestamp: F.Column | None = None) -> DataFrame:
    """Rows -> envelope. value = JSON of ``columns`` (default: all), key = ``key`` as string. A projection: no shuffle."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in columns or df.columns])).alias("value"),
        F.lit(topic).alias("topic"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"))


def decode(envelope: DataFrame, schema=S.MESSAGE_SCHEMA, keep: list[str] | None = None,
           corrupt_column: str | None = None) -> DataFrame:
    """JSON value -> columns (PERMISSIVE: malformed JSON gives null fields).

    With ``corrupt_column`` the raw text of unparsable messages is kept there.
    Each message is parsed once: behind a generator, filters on its fields
    don't repeat the parsing for every field that they name.
    """
    keep = keep or []
    parsed = F.explode(F.array(F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE"}))).alias("_m")
    out = envelope.select(*keep, parsed, "value")
    if corrupt_column:
        bad = F.col("_m").isNull() | F.to_json(F.col("_m")).eqNullSafe(F.lit("{}"))
        out = out.withColumn(corrupt_column, F.when(bad, F.col("value")))
        return out.select(*keep, "_m.*", corrupt_column)
    return out.select(*keep, "_m.*")


def bounded_read(envelope: DataFrame, max_messages: int | None = None) -> DataFrame:
    """All messages, or with ``max_messages`` the first so many in (partition, offset, key) order."""
    if max_messages is None:
        return envelope
    return envelope.orderBy("partition", "offset", "key").limit(max_messages)


def write_envelope(envelope: DataFrame, path: str, files: int | None = None) -> None:
    """File sink standing in for the broker: JSON lines of the envelope.

    ``files`` spreads rows round-robin (never by topic partition: there are
    only a few, and each may hold a third of the rows)."""
    out = envelope.repartition(files) if files else envelope
    out.write.mode("overwrite").json(path)


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ENVELOPE_SCHEMA).json(path)


def read_broker(spark: SparkSession, servers: str, topic: str, retries: int = 5) -> DataFrame:
    """Batch read of a broker topic, earliest to latest (needs the Kafka connector);
    offset fetches are retried ``retries`` times by the source itself."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("subscribe", topic).option("startingOffsets", "earliest")
                 .option("endingOffsets", "latest").option("fetchOffset.numRetries", retries).load()
                 .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                         "partition", "offset", "timestamp"))


def read_broker_or_empty(spark: SparkSession, servers: str, topic: str, retries: int = 5) -> DataFrame:
    """``read_broker``; without the connector on the classpath an empty
    envelope. Every other fault (address, password, schema, an unreachable
    broker at the action) is raised."""
    try:
        return read_broker(spark, servers, topic, retries)
    except AnalysisException as e:
        if "Failed to find data source" not in str(e) and "DATA_SOURCE_NOT_FOUND" not in str(e):
            raise
        import logging
        logging.getLogger(__name__).warning("no connector to read %s/%s", servers, topic)
        return spark.createDataFrame([], S.ENVELOPE_SCHEMA)


def write_broker(envelope: DataFrame, servers: str) -> None:
    """Publish to a broker (needs the Kafka connector)."""
    (envelope.select("key", "value", "topic").write.format("kafka")
             .option("kafka.bootstrap.servers", servers).save())
