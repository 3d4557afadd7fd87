"""The change feed: bounded pulls from a topic, typed decode, and publishing rows as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.schemas import CDC_EVENT

# Layout of a topic row that the decoder needs; a file source can stand in for the broker.
FEED_SCHEMA = "key string, value string, partition int, offset bigint"


def kafka_options(brokers: str, topic: str, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic}
    if group:
        options["groupIdPrefix"] = group
    return options


def read_topic_stream(
    spark: SparkSession, brokers: str, topic: str, max_messages: int, group: str | None = None
) -> DataFrame:
    """At most ``max_messages`` per micro-batch, from the earliest offset; progress lives in the checkpoint."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, group))
    rows = reader.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_messages).load()
    return rows.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def read_topic_range(
    spark: SparkSession, brokers: str, topic: str, starting_offsets: str, ending_offsets: str = "latest"
) -> DataFrame:
    """A batch read between recorded offsets (``operators.offsets.kafka_offsets``), by default to the end of the topic."""
    reader = spark.read.format("kafka").options(**kafka_options(brokers, topic))
    rows = reader.option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets).load()
    return rows.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def read_feed_files(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """The same rows from landed JSON files."""
    return spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


def utc(timestamp: Column) -> Column:
    """An instant as wall-clock time in UTC, whatever the session's zone is."""
    seconds = (F.unix_micros(timestamp).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def decode_events(messages: DataFrame) -> DataFrame:
    """Typed events; one record that does not parse or lacks a field fails the batch."""
    event = F.from_json("value", CDC_EVENT, {"mode": "FAILFAST"})
    return _event_columns(messages.withColumn("event", event), strict=True)


def decode_events_with_quarantine(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed events, and beside them the raw records that do not parse or lack a field."""
    schema = f"{CDC_EVENT}, bad_record string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_record"}
    decoded = messages.withColumn("event", F.from_json("value", schema, options))
    good = F.col("event.bad_record").isNull()
    for name in _FIELDS:
        good = good & F.col(f"event.{name}").isNotNull()
    return _event_columns(decoded.filter(good)), decoded.filter(~good).drop("event")


_FIELDS = ("spent_idx", "indexing_type", "reg_at")


def _event_columns(decoded: DataFrame, strict: bool = False) -> DataFrame:
    kinds = {f.name: f.dataType for f in decoded.schema["event"].dataType.fields}

    def field(name: str) -> Column:
        value = F.col(f"event.{name}")
        missing = F.raise_error(F.concat(F.lit(f"event without {name}: "), F.coalesce("value", F.lit("no value"))))
        return F.coalesce(value, missing.cast(kinds[name])) if strict else value

    return decoded.select(
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("msg_offset"),
        field("spent_idx").alias("spent_idx"),
        field("indexing_type").alias("indexing_type"),
        utc(field("reg_at")).alias("reg_at"),
    )


def to_messages(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as JSON messages with an optional key per row."""
    value = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select((F.lit(None) if key is None else key).cast("string").alias("key"), value)


def write_topic(messages: DataFrame, brokers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def event_messages(events: DataFrame) -> DataFrame:
    """Events in the feed's row layout: the inverse of ``decode_events``.

    ``msg_offset`` counts within a partition; a table that numbers its events otherwise brings
    that count as ``partition_offset``.
    """
    place = "partition_offset" if "partition_offset" in events.columns else "msg_offset"
    body = F.struct("spent_idx", "indexing_type", "reg_at")
    return events.select(
        F.col("spent_idx").cast("string").alias("key"),
        F.to_json(body, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"}).alias("value"),
        F.col("partition_id").alias("partition"),
        F.col(place).alias("offset"),
    )
