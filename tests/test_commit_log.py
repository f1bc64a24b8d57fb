import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ratingstream.options import KafkaOptions, KMeansOptions, StreamOptions
from ratingstream.session import fresh_path
from ratingstream.sources import fixtures as fx
from ratingstream.sources import topic_log as tl
from ratingstream.sources.kafka import stream_ratings
from ratingstream.streaming import commit_log as cl
from ratingstream.streaming.job import run_log, run_stream

from conftest import SF_SMOKE
from test_stream import _setup


def test_offset_pairs():
    start, end = {"t": {"0": 5, "1": 7}}, {"t": {"0": 9, "1": 7, "10": 3}, "u": {"0": 1}}
    assert cl.offset_pairs(start, end) == [("t", 0, 5, 9), ("t", 10, 0, 3), ("u", 0, 0, 1)]
    assert cl.offset_pairs(None, {"logOffset": 3}) == [] and cl.offset_pairs(None, None) == []


def test_first_line_names_the_error():
    text = "Stream x terminated\npy4j.Py4JException: An exception\nTraceback\nValueError: bad rating\nat org.x\n"
    assert cl.first_line(text) == "ValueError: bad rating"
    assert cl.first_line("only text") == "only text" and cl.first_line("") == ""


def test_failed_and_retried_batches_have_a_row_each(spark):
    vt, state0, _ = _setup(spark)
    root = fresh_path(spark, "t_commits")
    wave = tl.append_wave(spark, f"{root}/topic", fx.skewed_records(fx.table(spark, SF_SMOKE, "events")), "a")
    cap = -(-max(wave.ends[fx.TOPIC].values()) // 2)
    kafka = KafkaOptions(starting_offsets="earliest")

    def run(on_error):
        source = stream_ratings(spark, "log", f"{root}/topic", kafka, records_per_s=cap, checkpoint=f"{root}/out/checkpoint")
        q, paths = run_stream(spark, source, vt, state0, f"{root}/out", KMeansOptions(k=3, dim=vt.dim), StreamOptions(on_error=on_error, compact_every=2), available_now=True)
        try:
            q.awaitTermination()
        except StreamingQueryException:
            assert on_error == "fail"
        assert cl.wait_logged(q)
        return paths

    assert cl.unfinished_batch(spark, f"{root}/out/checkpoint") == (None, None, None)
    run("fail")
    assert cl.unfinished_batch(spark, f"{root}/out/checkpoint")[0] == 0
    run("fail")  # the same batch again
    run("quarantine")
    paths = run("quarantine")
    assert tl.caught_up(spark, f"{root}/topic", f"{root}/out/checkpoint")
    rows = cl.read_outcomes(spark, paths.root).orderBy("attempt").collect()
    assert [(r.batch_id, r.outcome) for r in rows] == [(0, "failed"), (0, "failed"), (0, "committed"), (1, "committed")]
    assert [r.error is not None for r in rows] == [True, True, False, False]
    assert rows[0].ranges == rows[1].ranges == rows[2].ranges and len(rows[0].ranges) == 2
    taken = {}
    for r in rows[2:]:
        for x in r.ranges:
            assert x.from_offset == taken.get(x.partition, 0) and x.until_offset - x.from_offset <= cap
            taken[x.partition] = x.until_offset
        assert r.n_records == sum(x.until_offset - x.from_offset for x in r.ranges) and r.duration_ms >= 0
    assert {str(p): u for p, u in taken.items()} == wave.ends[fx.TOPIC]
    assert len({r.query_run for r in rows}) == 4
    assert run_log(spark, paths).last == 1


def test_an_error_outside_a_batch_has_no_batch(spark):
    root, cp = fresh_path(spark, "t_commits"), fresh_path(spark, "t_cp")
    listener = cl.watch(spark, root, cp, "outside")
    source = spark.readStream.format("rate").load()
    q = source.writeStream.foreachBatch(lambda df, b: None).option("checkpointLocation", cp).queryName("outside").trigger(availableNow=True).start()
    q.awaitTermination()
    assert listener.ended.wait(60)
    found = cl.read_outcomes(spark, root).collect()
    assert all(r.outcome == "committed" and r.ranges == [] for r in found)
    # another query's batches are not logged here
    before = len(found)
    other = source.writeStream.foreachBatch(lambda df, b: None).option("checkpointLocation", fresh_path(spark, "t_cp2")).queryName("other").trigger(availableNow=True).start()
    other.awaitTermination()
    time.sleep(1)
    assert cl.read_outcomes(spark, root).count() == before


def test_outcomes_are_merged_as_they_grow(spark):
    root = fresh_path(spark, "t_commits")
    log = cl.CommitLog(spark, root, root, "x", fanout=3)
    for b in range(10):
        log._write(b, "committed" if b % 2 else "failed", None if b % 2 else "E", b, b, [("t", 0, b, b + 1)])
    rows = cl.read_outcomes(spark, root).orderBy("attempt").collect()
    assert [(r.attempt, r.batch_id, r.duration_ms, r.ranges[0].from_offset) for r in rows] == [(b, b, b, b) for b in range(10)]
    assert len(cl._log(spark, cl.log_root(root)).manifest.segments) <= 6


def test_publisher_waves(spark):
    from ratingstream.jobs import publisher_job
    from ratingstream.options import PublishOptions

    root = fresh_path(spark, "t_waves")
    lines = fx.rating_lines_text(spark, SF_SMOKE)
    opts = PublishOptions(topic="ratings")
    one = publisher_job(spark, lines, opts, sink="log", sink_path=root, wave="w")
    again = publisher_job(spark, lines, opts, sink="log", sink_path=root, wave="w")
    n = fx.table(spark, SF_SMOKE, "events").count()
    assert one == again and one["n_published"] == n and one["pct_published"] == 100.0
    assert tl.read_topic(spark, root).count() == n
    publisher_job(spark, lines, opts, sink="log", sink_path=root)
    df = tl.read_topic(spark, root)
    assert df.count() == 2 * n
    per = df.groupBy("partition").agg(F.count_distinct("offset").alias("d"), (F.max("offset") + 1).alias("end"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.d == r.end == r.n for r in per)
    assert json.loads(tl.waves(spark, root)[0].to_json())["facts"]["source"] == lines


def test_publish_stream_to_the_log_is_exactly_once(spark):
    from ratingstream.jobs import publish_stream
    from ratingstream.options import PublishOptions

    root = fresh_path(spark, "t_pubstream")
    lines = fx.rating_file_lines(fx.table(spark, SF_SMOKE, "events")).select("value")
    lines.write.text(f"{root}/in/wave=1")
    for _ in range(2):  # the second run has lost its checkpoint's commits: batch 0 runs again
        q = publish_stream(spark, f"{root}/in/*", f"{root}/out", PublishOptions(topic="ratings"), sink="log", available_now=True)
        q.awaitTermination()
        from ratingstream.session import remove_folder

        remove_folder(spark, f"{root}/out/checkpoint/commits")
    assert tl.read_topic(spark, f"{root}/out/topic").count() == lines.count()
    assert spark.read.parquet(f"{root}/out/summary").agg(F.sum("n_published")).first()[0] == lines.count()


def test_clusterer_job_reads_the_topic_log(spark):
    from ratingstream.jobs import clusterer_job

    root = fresh_path(spark, "t_job_log")
    tl.append_wave(spark, f"{root}/topic", fx.kafka_records(fx.table(spark, SF_SMOKE, "events")).drop("offset"), "a")
    emb = fx.table(spark, SF_SMOKE, "embeddings")
    opts = StreamOptions(max_records_per_s_per_partition=1, interval_s=300)
    q, paths = clusterer_job(
        spark, fx.tag_scores_csv(spark, SF_SMOKE), f"{root}/out", KMeansOptions(k=3, dim=fx.embedding_dim(emb), seed=1), opts,
        KafkaOptions(starting_offsets="earliest"), source_format="log", source_path=f"{root}/topic", available_now=True,
    )
    assert cl.wait_logged(q)
    row = cl.read_outcomes(spark, paths.root).first()
    assert {(x.partition, x.until_offset - x.from_offset) for x in row.ranges} == {(0, 300), (1, 300)}


@pytest.mark.parametrize("sink", ["nowhere"])
def test_unknown_sinks_are_refused(spark, sink):
    from ratingstream.jobs import publisher_job

    with pytest.raises(ValueError):
        publisher_job(spark, fx.rating_lines_text(spark, SF_SMOKE), sink=sink)
