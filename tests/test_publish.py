from pyspark.sql import functions as F

from ratingstream.operators.parse import accepted, parse_rating
from ratingstream.operators.publish import publish_ratings, publish_summary
from ratingstream.options import KafkaOptions, PublishOptions
from ratingstream.sources.kafka import kafka_reader_options, kafka_writer_options, stream_source_rate
from ratingstream.functions.text import decode_int_key


def test_publish_then_parse_is_identity(spark):
    lines = spark.createDataFrame(
        [("2200,3527,4.0,1422126710",), ("1,122,2,945544824",), ("x,1,2,3",), ("-3,5,1.5,7",)], "value string"
    )
    out = publish_ratings(lines, topic="t", partitions=2)
    rows = out.select("value", "partition", decode_int_key("key").alias("k")).collect()
    assert sorted(r["value"] for r in rows) == ["-3,5,1.5", "1,122,2", "2200,3527,4.0"]
    assert {r["value"]: (r["partition"], r["k"]) for r in rows}["-3,5,1.5"] == (1, 1)
    back = accepted(parse_rating(out.select("value")))
    assert sorted((r.user_id, r.movie_id, r.rating) for r in back.collect()) == [
        (-3, 5, 1.5), (1, 122, 2.0), (2200, 3527, 4.0)
    ]
    s = publish_summary(lines).first()
    assert (s.n_read, s.n_rejected, s.n_published, s.pct_published) == (4, 1, 3, 75.0)


def test_kafka_options():
    w = kafka_writer_options(PublishOptions(topic="ratings", extra={"client.id": "c"}))
    assert w["topic"] == "ratings" and w["kafka.acks"] == "0" and w["kafka.retries"] == "3"
    assert w["kafka.compression.type"] == "none" and w["kafka.linger.ms"] == "1000"
    assert w["kafka.client.id"] == "c"
    assert kafka_writer_options(PublishOptions(compression=None))["kafka.compression.type"] == "gzip"
    r = kafka_reader_options(KafkaOptions(topics="a, b,,c"), max_offsets_per_trigger=stream_source_rate(2000, 2, 120))
    assert r["subscribe"] == "a,b,c" and r["startingOffsets"] == "latest"
    assert r["maxOffsetsPerTrigger"] == "480000"
    assert r["groupIdPrefix"] == "KMean_Consumer"
    assert "minPartitions" not in r
    assert kafka_reader_options(KafkaOptions(min_partitions=64))["minPartitions"] == "64"


def test_options_from_reference_properties():
    from ratingstream.options import KMeansOptions, kafka_options_from_properties

    k = KMeansOptions.from_properties(
        {"kMeans.K": "5", "kMeans.DecayFactor": "0.9", "kMeans.RandomCenters.dim": "5", "kMeans.RandomCenters.weight": "0.0"}
    )
    assert (k.k, k.dim, k.weight) == (5, 5, 0.0)
    assert k.decay == 0.8999999761581421  # read as a 32-bit float, as the reference job does
    assert KMeansOptions.from_properties({}).dim == 1128
    o = kafka_options_from_properties(
        {
            "kafkaStream.bootstrap.servers": "localhost:6667",
            "kafkaStream.topics": "test",
            "kafkaStream.group.id": "clusterer-group",
            "kafkaStream.auto.offset.reset": "latest",
            "kafkaStream.key.deserializer": "x",
            "kafkaStream.security.protocol": "PLAINTEXT",
        }
    )
    assert (o.topics, o.group_id, o.starting_offsets) == ("test", "clusterer-group", "latest")
    assert o.extra == {"security.protocol": "PLAINTEXT"}


def test_api_names_every_inventory_operator():
    import ratingstream.api as api

    ids = """scan_tag_scores scan_rating_lines stream_ratings stream_start_position stream_source_rate
    stream_offset_report publish_ratings encode_key publish_options publish_summary model_report
    prediction_report project_value parse_rating reject_bad_lines drop_last_field user_parity_key
    stamp_time rekey_by_movie array_to_features scale_features label_points project_features
    format_center join_ratings_features assemble_tag_vectors count_lines cluster_stats init_centers
    assign_clusters update_centers decay_weights split_dying_cluster latest_model sample_rows
    micro_batch_trigger stream_transform stateful_model per_batch_output train_then_predict checkpoint
    commit_offsets cache_static_side run_until_stopped""".split()
    missing = [i for i in ids if not callable(getattr(api, i, None))]
    assert not missing


def test_prediction_report_lines_are_bounded_and_ordered(spark):
    """The lines are ranges of the key, whatever the number of rows."""
    from ratingstream.operators.reports import prediction_report

    for n in (5, 95):
        preds = spark.createDataFrame([(i, i % 2, i % 5) for i in reversed(range(n))], "msg_id long, partition int, cluster int")
        out = sorted(prediction_report(preds, order_col="msg_id", span=10).collect(), key=lambda r: r["line_no"])
        assert [r["line_no"] for r in out] == list(range((n + 9) // 10))
        assert ",".join(r["line"] for r in out) == ",".join(str(i % 5) for i in range(n))
        assert max(r["n"] for r in out) <= 10
        by_part = prediction_report(preds, order_col="msg_id", span=10, group_cols=("partition",)).collect()
        assert all(int(x) % 1 == 0 for r in by_part for x in r["line"].split(",")) and sum(r["n"] for r in by_part) == n
    assert sum(r["n"] for r in prediction_report(preds).collect()) == 95


def test_publish_counts_come_from_the_writing_pass(spark):
    from pyspark.sql import Observation

    from ratingstream.operators.publish import observed_summary

    lines = spark.createDataFrame(
        [("2200,3527,4.0,1422126710",), ("1,122,2,945544824",), ("x,1,2,3",), ("-3,5,1.5,7",)], "value string"
    )
    seen = Observation("publish")
    publish_ratings(lines, topic="t", observation=seen).write.format("noop").mode("overwrite").save()
    s = observed_summary(seen)
    assert (s["n_read"], s["n_rejected"], s["n_published"], s["pct_published"]) == (4, 1, 3, 75.0)


def test_progress_grows_and_ends_at_the_summary(spark):
    from ratingstream.operators.publish import publish_progress

    steps = spark.createDataFrame([(2, 5, 1, 4), (0, 3, 0, 3), (1, 4, 2, 2)], "step int, n_read long, n_rejected long, n_published long")
    rows = publish_progress(steps, 12).orderBy(F.col("step").asc_nulls_last()).collect()
    assert [(r.step, r.kind, r.n_read, r.n_rejected, r.n_published, r.n_missing) for r in rows] == [
        (0, "progress", 3, 0, 3, 9), (1, "progress", 7, 2, 5, 7), (2, "progress", 12, 3, 9, 3), (None, "shortfall", 12, 3, 9, 3)
    ]
    assert [r.pct_published for r in rows] == [25.0, 500 / 12, 75.0, 75.0]
    assert [r.kind for r in publish_progress(steps.where("n_rejected = 0"), 3).collect()] == ["progress", "sent"]
    none = publish_progress(steps.limit(0), 0).collect()
    assert [(r.kind, r.n_published, r.pct_published) for r in none] == [("sent", 0, None)]
    assert publish_progress(steps.limit(0), 7).first().kind == "shortfall"


def test_a_running_stream_reports_progress(spark):
    from ratingstream.jobs import publish_stream, stream_progress
    from ratingstream.options import PublishOptions
    from ratingstream.session import fresh_path

    root = fresh_path(spark, "t_progress")
    lines = ["1,2,3.0,9", "2,2,3.5,9", "bad,1,1,1", "4,1,1,1"]
    for i, line in enumerate(lines):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{root}/in/{i}")
    assert [r.kind for r in stream_progress(spark, f"{root}/in/*", f"{root}/out").collect()] == ["shortfall"]
    publish_stream(spark, f"{root}/in/*", f"{root}/out", PublishOptions(), "log", True, files_per_step=1).awaitTermination()
    rows = stream_progress(spark, f"{root}/in/*", f"{root}/out").orderBy(F.col("step").asc_nulls_last()).collect()
    assert [r.n_read for r in rows] == [1, 2, 3, 4, 4]
    assert (rows[-1].kind, rows[-1].n_published, rows[-1].n_rejected, rows[-1].n_missing) == ("shortfall", 3, 1, 1)
