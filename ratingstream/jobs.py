"""The two programs of the reference, as Spark jobs.

* :func:`clusterer_job`: tag-score CSV → movie vectors (once) → rating stream
  → per-batch k-means update, predictions and reports, until stopped.
* :func:`publisher_job`: rating file → checked, trimmed, keyed records → the
  rating topic (one pass per call; call again for another wave), with the
  publish summary; :func:`publish_stream` does the same for every file that
  lands in a folder.
"""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import kmeans as km
from .operators.features import tag_score_rejects
from .operators.publish import observed_summary, publish_progress, publish_ratings
from .options import KafkaOptions, KMeansOptions, PublishOptions, StreamOptions
from .plans import pipeline as pl
from .plans.vector_store import VectorStore
from .session import is_complete
from .sources.files import count_lines, scan_rating_lines, scan_tag_scores
from .sources.kafka import stream_ratings, stream_source_rate, write_kafka
from .sources.topic_log import Wave, append_wave
from .streaming.job import StreamPaths, run_stream


def clusterer_job(
    spark: SparkSession,
    tag_scores_path: str,
    out_dir: str,
    kmeans: KMeansOptions = KMeansOptions(),
    stream: StreamOptions = StreamOptions(),
    kafka: KafkaOptions = KafkaOptions(),
    source_format: str = "kafka",
    source_path: str | None = None,
    source_partitions: int | None = None,
    initial_state: DataFrame | None = None,
    available_now: bool = False,
    wait: bool = True,
    on_tag_error: str = "quarantine",
    refresh_vectors: bool = False,
):
    """Run the streaming clusterer; returns ``(query, paths)``.

    Centres start random (seeded by ``kmeans.seed``) with ``kmeans.weight``,
    unless ``initial_state`` is given or a model table already exists under
    ``out_dir`` (a restart). The per-trigger cap is the per-partition record rate
    times the topic's partitions (``source_partitions``, which a capped Kafka source
    needs) times the batch interval; a rate of 0 sets no cap. A topic log (``source_format="log"``) is
    capped partition by partition. ``on_tag_error="fail"`` stops at the
    first unusable tag score instead of setting it aside. ``refresh_vectors`` follows changes of the
    tag scores: changed content gets vectors of its own, used from the next batch on. Otherwise a run keeps
    the vectors that it was begun with.
    """
    capped = source_format == "kafka" and stream.max_records_per_s_per_partition > 0
    if capped and not source_partitions:
        raise ValueError("a capped Kafka source needs source_partitions (the topics' partition count); a rate of 0 sets no cap")
    root = out_dir.rstrip("/")
    if refresh_vectors:
        vt = VectorStore(spark, f"{root}/vector_versions", tag_scores_path, kmeans.dim, on_tag_error)
        vt.refresh()
    else:
        scores = scan_tag_scores(spark, tag_scores_path)
        if not is_complete(spark, f"{root}/tag_score_rejects"):
            # rows the pivot leaves out (nulls, tags outside 1..dim), kept for inspection
            tag_score_rejects(scores, kmeans.dim).write.mode("overwrite").parquet(f"{root}/tag_score_rejects")
        vt = pl.materialize_vectors(spark, pl.movie_vectors(scores, kmeans.dim, on_tag_error), kmeans.dim, path=f"{root}/vectors")
    state0 = initial_state
    if state0 is None:
        state0 = km.init_centers(spark, kmeans.k, kmeans.dim, kmeans.weight, kmeans.seed)
    cap = None
    if capped:
        cap = stream_source_rate(stream.max_records_per_s_per_partition, source_partitions, stream.interval_s)
    if source_format == "kafka" and kafka.min_partitions is None:
        # spread each batch over the cluster even when the topic has few partitions
        kafka = dataclasses.replace(kafka, min_partitions=spark.sparkContext.defaultParallelism)
    source = stream_ratings(
        spark, source_format, source_path, kafka, cap,
        # a topic log is capped per partition, so its partitions needn't be counted
        records_per_s=stream.max_records_per_s_per_partition, interval_s=stream.interval_s, checkpoint=f"{root}/checkpoint",
    )
    query, paths = run_stream(
        spark, source, vt, state0, out_dir=out_dir, kmeans=kmeans, opts=stream, available_now=available_now
    )
    if wait:
        query.awaitTermination()
    return query, paths


def publisher_job(
    spark: SparkSession,
    input_path: str,
    opts: PublishOptions = PublishOptions(),
    sink: str = "kafka",
    sink_path: str | None = None,
    wave: str | None = None,
) -> dict:
    """One wave: publish every good line of the rating file; returns the summary.

    ``sink="kafka"`` writes to the topic; ``sink="parquet"`` writes the same
    records to ``sink_path`` (replays, tests). ``sink="log"`` adds them to the topic log under ``sink_path``,
    with one commit: a ``wave`` (a name) that died or is run again leaves each record there once.
    """
    lines = scan_rating_lines(spark, input_path)
    seen = Observation("publish")
    records = publish_ratings(lines, opts.topic, opts.partitions, observation=seen)
    if sink == "log":
        return wave_summary(append_wave(spark, sink_path, records, wave, seen, source=input_path))
    if sink == "kafka":
        write_kafka(records, opts)
    elif sink == "parquet":
        # stand-in for the topic: the broker would assign offsets and the log-append time; a
        # unique id past those of earlier waves and the write time play those parts
        first = 0
        if is_complete(spark, sink_path):
            first = (spark.read.parquet(sink_path).agg(F.max("offset")).first()[0] or 0) + 1
        records.withColumn("offset", F.monotonically_increasing_id() + F.lit(first)).withColumn(
            "timestamp", F.current_timestamp()
        ).write.mode("append").parquet(sink_path)
    else:
        raise ValueError("sink must be 'kafka', 'parquet' or 'log'")
    return observed_summary(seen)  # counted by the writing pass, no second read of the file


def wave_summary(wave: Wave) -> dict:
    """The publish summary that a wave's manifest keeps, also for a wave that was in the log already."""
    m = {k: wave.facts[k] for k in ("n_read", "n_rejected", "n_published")}
    return m | {"pct_published": 100.0 * m["n_published"] / m["n_read"] if m["n_read"] else None}


def publish_stream(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    opts: PublishOptions = PublishOptions(),
    sink: str = "kafka",
    available_now: bool = False,
    files_per_step: int | None = None,
):
    """Publish every rating file that lands in ``input_path``; returns the streaming query.

    The streaming twin of :func:`publisher_job` (the reference re-sends its file
    in endless waves; here each new file is one wave). Each micro-batch writes
    its records to the topic (or, with ``sink="parquet"``, to
    ``out_dir/records``) and appends one summary row (read / rejected /
    published) to ``out_dir/summary``, tagged with the batch id so a replay
    overwrites rather than doubles it. ``sink="log"``: the topic log under ``out_dir/topic``.
    ``files_per_step`` caps the files of a micro-batch; :func:`stream_progress` then tells how far it has come.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", int(files_per_step)) if files_per_step else spark.readStream
    lines = reader.text(input_path)

    def fn(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"publish-{batch_id}")
        records = publish_ratings(batch, opts.topic, opts.partitions, observation=seen)
        if sink == "kafka":
            write_kafka(records, opts)
        elif sink == "parquet":
            records.write.mode("overwrite").parquet(f"{out_dir}/records/batch_id={batch_id}")
        elif sink != "log":
            raise ValueError("sink must be 'kafka', 'parquet' or 'log'")
        # the counts were gathered by the write; the summary is one local row
        if sink == "log":  # a batch that is run again is in the log once
            m = wave_summary(append_wave(spark, f"{out_dir}/topic", records, f"batch-{batch_id}", seen))
        else:
            m = observed_summary(seen)
        summary = spark.createDataFrame(
            [(m["n_read"], m["n_rejected"], m["n_published"], m["pct_published"])],
            "n_read long, n_rejected long, n_published long, pct_published double",
        )
        summary.write.mode("overwrite").parquet(f"{out_dir}/summary/batch_id={batch_id}")

    writer = lines.writeStream.foreachBatch(fn).option("checkpointLocation", f"{out_dir}/checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_progress(spark: SparkSession, input_path: str, out_dir: str) -> DataFrame:
    """Progress rows of a :func:`publish_stream`, running or ended, against the lines that lie in ``input_path`` now."""
    n_lines = count_lines(scan_rating_lines(spark, input_path)).first()[0]
    try:
        steps = spark.read.parquet(f"{out_dir}/summary").withColumnRenamed("batch_id", "step")
    except AnalysisException:  # nothing is published yet
        steps = spark.createDataFrame([], "n_read long, n_rejected long, n_published long, step int")
    return publish_progress(steps, n_lines)


def stream_progress_offsets(query) -> list[dict]:
    """Start and end offsets of the last micro-batch, per source (from the query progress)."""
    p = query.lastProgress or {}
    return [
        {"source": s.get("description"), "start": s.get("startOffset"), "end": s.get("endOffset")}
        for s in p.get("sources", [])
    ]


__all__ = ["clusterer_job", "publisher_job", "publish_stream", "stream_progress", "stream_progress_offsets", "StreamPaths"]


def _read_properties(path: str) -> dict:
    """``key value`` / ``key=value`` lines; ``#`` starts a comment."""
    props = {}
    with open(path) as f:
        for line in f:
            line = line.strip()
            if not line or line.startswith("#"):
                continue
            key, _, value = line.replace("=", " ", 1).partition(" ")
            props[key.strip()] = value.strip()
    return props


def main(argv: list[str] | None = None) -> None:
    """``spark-submit launch.py clusterer|publisher ...`` (see README)."""
    import argparse

    from .options import kafka_options_from_properties

    ap = argparse.ArgumentParser(prog="ratingstream")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clusterer", help="stream ratings into the k-means model")
    c.add_argument("--tag-scores", required=True)
    c.add_argument("--out", required=True, help="folder for model state, predictions and the checkpoint")
    c.add_argument("--batch", type=int, default=StreamOptions.interval_s, help="batch interval in seconds")
    c.add_argument("--rate", type=int, default=StreamOptions.max_records_per_s_per_partition, help="records per second and partition; 0: no cap")
    c.add_argument("--source-partitions", type=int, help="partitions of the topics (needed unless --rate 0)")
    c.add_argument("--seed", type=int, help="seed of the random starting centres")
    c.add_argument("--on-tag-error", choices=["quarantine", "fail"], default="quarantine")
    c.add_argument("--refresh-vectors", action="store_true", help="use changed tag scores from the next batch on")
    c.add_argument("--allow-data-loss", action="store_true", help="go on when offsets have expired")
    c.add_argument("--properties", help="kafkaStream.* and kMeans.* settings")
    p = sub.add_parser("publisher", help="publish a rating file to the topic once")
    p.add_argument("--input-file", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--broker-list", required=True)
    p.add_argument("--partitions", type=int, default=PublishOptions.partitions)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"ratingstream-{args.cmd}").getOrCreate()
    if args.cmd == "clusterer":
        props = _read_properties(args.properties) if args.properties else {}
        kopts = KMeansOptions.from_properties({k: v for k, v in props.items() if k.startswith("kMeans.")})
        kafka = kafka_options_from_properties({k: v for k, v in props.items() if k.startswith("kafkaStream.")})
        kopts = dataclasses.replace(kopts, seed=args.seed)
        kafka = dataclasses.replace(kafka, fail_on_data_loss=not args.allow_data_loss)
        sopts = StreamOptions(interval_s=args.batch, max_records_per_s_per_partition=args.rate)
        clusterer_job(
            spark, args.tag_scores, args.out, kopts, sopts, kafka,
            source_partitions=args.source_partitions, on_tag_error=args.on_tag_error, refresh_vectors=args.refresh_vectors,
        )
    else:
        opts = PublishOptions(bootstrap_servers=args.broker_list, topic=args.topic, partitions=args.partitions)
        print(publisher_job(spark, args.input_file, opts))


if __name__ == "__main__":
    main()
