"""Kafka source and sink options, and the streaming rating source.

The Kafka connector jar is not part of a plain PySpark install; these helpers
only build options and frames, so they are tested as frames. The same stream
code reads Kafka-shaped parquet or text files, which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..options import KafkaOptions, PublishOptions
from ..schemas import KAFKA_RECORD
from .topic_log import stream_topic


def stream_source_rate(records_per_s_per_partition: int, partitions: int, interval_s: int) -> int:
    """Records per trigger that match a per-partition per-second cap (0: no cap)."""
    return int(records_per_s_per_partition) * int(partitions) * int(interval_s)


def kafka_reader_options(
    opts: KafkaOptions = KafkaOptions(), max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``: subscribe to a comma list of topics."""
    o = {
        "kafka.bootstrap.servers": opts.bootstrap_servers,
        "subscribe": ",".join(t.strip() for t in opts.topics.split(",") if t.strip()),
        "startingOffsets": opts.starting_offsets,
        # Structured Streaming keeps offsets in its checkpoint, not in a consumer
        # group; the configured group name becomes the prefix of the groups it uses
        "groupIdPrefix": opts.group_id,
        "failOnDataLoss": str(opts.fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if opts.min_partitions:
        o["minPartitions"] = str(int(opts.min_partitions))
    for k, v in opts.extra.items():
        o[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return o


def kafka_writer_options(opts: PublishOptions = PublishOptions()) -> dict[str, str]:
    """Options for ``write.format("kafka")``; the sink owns the serializers."""
    compression = "gzip" if opts.compression is None or opts.compression == "" else opts.compression
    o = {
        "kafka.bootstrap.servers": opts.bootstrap_servers,
        "topic": opts.topic,
        "kafka.acks": str(opts.acks),
        "kafka.retries": str(opts.retries),
        "kafka.retry.backoff.ms": str(opts.retry_backoff_ms),
        "kafka.compression.type": compression,
        "kafka.linger.ms": str(opts.linger_ms),
        "kafka.request.timeout.ms": str(opts.request_timeout_ms),
        "kafka.metadata.max.age.ms": str(opts.metadata_max_age_ms),
        "kafka.max.block.ms": str(opts.max_block_ms),
        "kafka.send.buffer.bytes": str(opts.send_buffer_bytes),
        "kafka.batch.size": str(opts.batch_size),
        "kafka.buffer.memory": str(opts.buffer_memory),
        "kafka.security.protocol": opts.security_protocol,
    }
    for k, v in opts.extra.items():
        o[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return o


def stream_ratings(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    kafka: KafkaOptions = KafkaOptions(),
    max_per_trigger: int | None = None,
    records_per_s: int = 0,
    interval_s: int = 1,
    checkpoint: str | None = None,
) -> DataFrame:
    """The rating stream.

    ``fmt="kafka"``: subscribe to ``kafka.topics``; rows carry key/value bytes,
    topic, partition, offset, timestamp. ``fmt="parquet"``: files of the same
    record shape (tests, replays). ``fmt="text"``: one message per line. ``fmt="log"``: a topic log
    (:mod:`ratingstream.sources.topic_log`) with offsets, start positions and, given ``records_per_s``,
    a cap per topic partition of that rate times ``interval_s`` (``checkpoint`` is then needed).
    ``max_per_trigger`` caps offsets (Kafka) or files (file sources) per batch.
    """
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**kafka_reader_options(kafka, max_per_trigger)).load()
    if path is None:
        raise ValueError("a path is needed for file streams")
    if fmt == "log":
        return stream_topic(spark, path, kafka.starting_offsets, records_per_s, interval_s, checkpoint)
    reader = spark.readStream
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_per_trigger))
    if fmt == "parquet":
        return reader.schema(KAFKA_RECORD).parquet(path)
    if fmt == "text":
        return reader.text(path)
    raise ValueError("fmt must be 'kafka', 'parquet', 'text' or 'log'")


def write_kafka(df: DataFrame, opts: PublishOptions = PublishOptions()) -> None:
    """Batch write of ``key, value[, topic, partition]`` rows to Kafka."""
    df.write.format("kafka").options(**kafka_writer_options(opts)).save()
