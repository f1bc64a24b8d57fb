"""Registered queries that run the streaming job over the given tables.

The rating topic is replayed from ``events``: Kafka-shaped records are
written once, partitioned by day, to a staging folder. Each day's folder is
then moved into the folder a file stream reads (one rename, so the stream
never sees half a day) and consumed with an ``availableNow`` run from the
same checkpoint: each day is exactly one micro-batch, and every run after
the first is a restart from the checkpoint and the model table.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import KafkaOptions, KMeansOptions, StreamOptions
from ..plans import queries as bq
from ..session import fresh_path, publish_folder
from ..sources import fixtures as fx
from ..sources.kafka import stream_ratings
from ..sources.topic_log import append_wave, caught_up
from .commit_log import read_outcomes, wait_logged
from .job import StreamPaths, read_table, run_log, run_stream


#: Records of a file in the replayed topic's folder, which one task parses.
FILE_ROWS = 50_000


def _days(records: DataFrame) -> list[int]:
    d = records.select(fx.epoch_day("timestamp").alias("d")).distinct()
    return [r[0] for r in d.orderBy("d").collect()]


def replay_by_day(spark: SparkSession, sf_dir: str) -> StreamPaths:
    """Publish each day of records, then run the clusterer until it is caught up."""
    k = bq._key(spark, sf_dir, "stream_run")
    if k in bq._CACHE:
        return bq._CACHE[k]
    records = fx.kafka_records(bq.events(spark, sf_dir))
    vt = bq.vector_table(spark, sf_dir)
    state0 = bq.start_state(spark, sf_dir)
    root = fresh_path(spark, "stream")
    inbox, staging = f"{root}/inbox", f"{root}/staging"
    # a day in files of a few records each is parsed by all cores, whatever order the events came in
    records.withColumn("day", fx.epoch_day("timestamp")).write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("day").parquet(staging)
    opts = StreamOptions(sample_fraction=bq.SAMPLE_FRACTION, report_span=bq.REPORT_SPAN)
    km_opts = KMeansOptions(k=bq.K, dim=vt.dim)
    paths = None
    for d in _days(records):
        publish_folder(spark, f"{staging}/day={d}", f"{inbox}/day={d}")
        source = stream_ratings(spark, "parquet", f"{inbox}/*")
        q, paths = run_stream(
            spark, source, vt, state0, out_dir=f"{root}/out", kmeans=km_opts, opts=opts, available_now=True
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    bq._CACHE[k] = paths
    return paths


def q_stream_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating topic read as a stream (all records once), value as text."""
    root = fresh_path(spark, "stream_read")
    records = fx.kafka_records(bq.events(spark, sf_dir))
    records.write.parquet(f"{root}/inbox")
    source = stream_ratings(spark, "parquet", f"{root}/inbox")
    q = (
        source.select("offset", F.col("value").cast("string").alias("value"))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/out")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(F.col("offset").alias("msg_id"), "value")


def q_stateful_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bq.state_long(run_log(spark, replay_by_day(spark, sf_dir)).latest_model())


def q_stream_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = replay_by_day(spark, sf_dir)
    p = read_table(spark, paths, "predictions")
    return p.select(F.col("offset").alias("msg_id"), "user_id", "movie_id", F.col("cluster").cast("int"))


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = replay_by_day(spark, sf_dir)
    p = read_table(spark, paths, "quarantine")
    return p.select(F.col("offset").alias("msg_id"), "value", "reject_reason")


def q_stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset ranges the stream recorded per batch and topic partition."""
    paths = replay_by_day(spark, sf_dir)
    o = read_table(spark, paths, "offsets")
    return o.select(
        F.col("batch_id").cast("int").alias("batch_id"),
        "topic",
        "partition",
        "from_offset",
        "until_offset",
        "n",
        "n_rejected",
    )


def q_stream_model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model lines that each batch reported, taken apart again into numbers."""
    paths = replay_by_day(spark, sf_dir)
    lines = read_table(spark, paths, "model_report").where(F.col("reported_at").isNotNull())
    center = F.transform(F.split("line", ","), lambda x: x.cast("double"))
    lines = lines.select(F.col("batch_id").cast("int").alias("batch_id"), "cluster", center.alias("center"))
    return bq.long_vectors(lines, ["batch_id", "cluster"], "center", "center", bq.ROUND)


def q_stream_prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction lines that each batch reported, per topic partition and range of offsets."""
    paths = replay_by_day(spark, sf_dir)
    p = read_table(spark, paths, "prediction_report").where(F.col("reported_at").isNotNull())
    return p.select(F.col("batch_id").cast("int").alias("batch_id"), "topic", "partition", "line_no", "n", "line")


def capped_run(spark: SparkSession, sf_dir: str) -> StreamPaths:
    """A skewed topic log read with a cap per partition, every batch by a restarted query; the first attempt fails on a bad row."""
    k = bq._key(spark, sf_dir, "capped_run")
    if k in bq._CACHE:
        return bq._CACHE[k]
    root = fresh_path(spark, "capped")
    wave = append_wave(spark, f"{root}/topic", fx.skewed_records(bq.events(spark, sf_dir)), "events")
    cap = -(-max(wave.ends[fx.TOPIC].values()) // bq.CAPPED_BATCHES)
    vt, state0 = bq.vector_table(spark, sf_dir), bq.start_state(spark, sf_dir)
    kafka = KafkaOptions(starting_offsets="earliest")
    paths, strict = StreamPaths(f"{root}/out"), True
    while strict or not caught_up(spark, f"{root}/topic", paths.checkpoint):
        opts = StreamOptions(sample_fraction=bq.SAMPLE_FRACTION, on_error="fail" if strict else "quarantine", compact_every=2)
        source = stream_ratings(spark, "log", f"{root}/topic", kafka, records_per_s=cap, checkpoint=paths.checkpoint)
        q, _ = run_stream(spark, source, vt, state0, paths.root, KMeansOptions(k=bq.K, dim=vt.dim), opts, available_now=True)
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if not strict:
                raise
        wait_logged(q)
        strict = False
    bq._CACHE[k] = paths
    return paths


def q_stream_capped_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch took from each partition: never more than the partition's own cap."""
    o = read_table(spark, capped_run(spark, sf_dir), "offsets")
    return o.select(F.col("batch_id").cast("int").alias("batch_id"), "topic", "partition", "from_offset", "until_offset", "n")


def q_stream_commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt to commit a batch, with its outcome and offset ranges; the first batch fails once and is retried."""
    o = read_outcomes(spark, capped_run(spark, sf_dir).root)
    o = o.withColumn("has_error", F.col("error").isNotNull()).withColumn("timed", F.col("duration_ms") >= 0)
    cols = [F.col("attempt").cast("int").alias("attempt"), F.col("batch_id").cast("int").alias("batch_id"), "outcome", "has_error", "timed", "n_records"]
    return o.select(*cols, F.inline("ranges"))


def registry():
    return {
        "stream_capped_offsets": q_stream_capped_offsets,
        "stream_commit_log": q_stream_commit_log,
        "stream_model_report": q_stream_model_report,
        "stream_prediction_report": q_stream_prediction_report,
        "stream_offsets": q_stream_offsets,
        "stream_ratings": q_stream_ratings,
        "stateful_model": q_stateful_model,
        "stream_predictions": q_stream_predictions,
        "stream_quarantine": q_stream_quarantine,
    }
