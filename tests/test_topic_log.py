import json

import pytest
from pyspark.sql import functions as F

from ratingstream.session import fresh_path, list_names
from ratingstream.sources import topic_log as tl


def records(spark, n, skew=1, start=0, topic="t"):
    """``n`` records in partition 1 and ``skew * n`` in partition 0."""
    df = spark.range(start, start + n * (skew + 1), numPartitions=5).withColumn("partition", F.when(F.col("id") % (skew + 1) == 0, 1).otherwise(0))
    return df.select(F.col("id").cast("string").cast("binary").alias("key"), F.concat(F.lit("v"), "id").alias("value"), F.lit(topic).alias("topic"), "partition")


def offsets(df):
    """Offsets per partition, which must have no gaps and no repeats."""
    out = {}
    for r in df.groupBy("topic", "partition").agg(F.sort_array(F.collect_list("offset")).alias("o")).collect():
        out[r.topic, r.partition] = r.o
    assert all(o == list(range(len(o))) for o in out.values())
    return {k: len(o) for k, o in out.items()}


def values(df):
    return sorted(r[0] for r in df.select(F.col("value").cast("string")).collect())


def test_waves_number_every_partition_without_gaps(spark):
    root = fresh_path(spark, "t_topic")
    assert tl.read_topic(spark, root).count() == 0
    tl.append_wave(spark, root, records(spark, 30, 3), "a")
    tl.append_wave(spark, root, records(spark, 10, 1, 1000), "b")
    tl.append_wave(spark, root, records(spark, 4, 1, 5000, "other topic/1"), "c")
    df = tl.read_topic(spark, root)
    assert offsets(df) == {("t", 0): 100, ("t", 1): 40, ("other topic/1", 0): 4, ("other topic/1", 1): 4}
    want = records(spark, 30, 3).union(records(spark, 10, 1, 1000)).union(records(spark, 4, 1, 5000))
    assert values(df) == values(want)
    assert [w.wave for w in tl.waves(spark, root)] == ["a", "b", "c"]
    # an earlier wave's records have the lower offsets
    split = df.where("topic = 't'").groupBy("partition", F.expr("int(substring(cast(value AS string), 2)) >= 1000").alias("late")).agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    at = {(r.partition, r.late): (r.lo, r.hi) for r in split.collect()}
    assert all(at[p, False][1] + 1 == at[p, True][0] for p in (0, 1))


def test_a_repeated_wave_is_written_once(spark):
    root = fresh_path(spark, "t_topic")
    one = tl.append_wave(spark, root, records(spark, 20), "a", source="file-1")
    two = tl.append_wave(spark, root, records(spark, 20), "a")
    assert one == two and one.facts == {"source": "file-1"}
    assert offsets(tl.read_topic(spark, root)) == {("t", 0): 20, ("t", 1): 20}


@pytest.mark.parametrize("step", ["_staged_files", "create_text"])
def test_a_killed_wave_can_be_run_again(spark, monkeypatch, step):
    root = fresh_path(spark, "t_topic")
    tl.append_wave(spark, root, records(spark, 5), "a")

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tl, step, die)
        with pytest.raises(KeyboardInterrupt):
            tl.append_wave(spark, root, records(spark, 20, 1, 100), "b")
    assert offsets(tl.read_topic(spark, root)) == {("t", 0): 5, ("t", 1): 5}
    tl.append_wave(spark, root, records(spark, 20, 1, 100), "b")
    df = tl.read_topic(spark, root)
    assert offsets(df) == {("t", 0): 25, ("t", 1): 25}
    assert values(df) == values(records(spark, 5).union(records(spark, 20, 1, 100)))
    assert tl.remove_unfinished(spark, root) == 1 and len(list_names(spark, f"{root}/data")) == 2
    assert tl.read_topic(spark, root).count() == 50


def test_the_loser_of_a_race_numbers_again(spark, monkeypatch):
    root = fresh_path(spark, "t_topic")
    real, raced = tl.create_text, []

    def race(spark_, path, text):
        if not raced:
            raced.append(path)
            tl.append_wave(spark, root, records(spark, 7, 1, 500), "winner")
        return real(spark_, path, text)

    monkeypatch.setattr(tl, "create_text", race)
    tl.append_wave(spark, root, records(spark, 5), "loser")
    assert [w.wave for w in tl.waves(spark, root)] == ["winner", "loser"]
    assert offsets(tl.read_topic(spark, root)) == {("t", 0): 12, ("t", 1): 12}


def ranges(start, end):
    return {(t, k): (start.get(t, {}).get(k, 0), u) for t, p in end.items() for k, u in p.items()}


def drain(spark, root, base, cap, starting="earliest", task_rows=7, limit=50):
    """Run capped batches, each a restart of the query; returns per batch the offsets read per partition."""
    batches = []

    def keep(df, batch_id):
        rows = df.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), "key", "timestamp").collect()
        batches.append((batch_id, sorted((r.topic, r.partition, r.offset, r.value) for r in rows)))
        assert all(r.value == "v" + r.key.decode() and r.timestamp is not None for r in rows)

    for _ in range(limit):
        if tl.caught_up(spark, root, f"{base}/cp"):
            break
        source = tl.stream_topic(spark, root, starting, cap, 1, f"{base}/cp", task_rows)
        q = source.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    return batches


def test_no_partition_is_read_above_its_cap_and_restarts_go_on(spark):
    root, base = fresh_path(spark, "t_topic"), fresh_path(spark, "t_run")
    tl.append_wave(spark, root, records(spark, 20, 10), "a")
    batches = drain(spark, root, base, 30)
    assert [b for b, _ in batches] == list(range(len(batches)))
    per = [{p: sum(r[1] == p for r in rows) for p in (0, 1)} for _, rows in batches]
    assert per == [{0: 30, 1: 20}, *[{0: 30, 1: 0}] * 5, {0: 20, 1: 0}]
    rows = [r for _, b in batches for r in b]
    want = {(r.topic, r.partition, r.offset, r.value.decode()) for r in tl.read_topic(spark, root).collect()}
    assert len(rows) == len(set(rows)) == 220 and set(rows) == want
    # what is published later is read from where the query stopped
    tl.append_wave(spark, root, records(spark, 3, 1, 9000), "b")
    more = drain(spark, root, base, 30)
    assert len(more) == 1 and {(p, o) for _, p, o, _ in more[0][1]} == {(0, o) for o in range(200, 203)} | {(1, o) for o in range(20, 23)}


def test_one_running_query_takes_a_capped_batch_per_trigger(spark):
    root, base = fresh_path(spark, "t_topic"), fresh_path(spark, "t_run")
    tl.append_wave(spark, root, records(spark, 10, 4), "a")
    got = []
    source = tl.stream_topic(spark, root, "earliest", 15, 1, f"{base}/cp")
    q = source.writeStream.foreachBatch(lambda df, b: got.append({r.partition: r["count"] for r in df.groupBy("partition").count().collect()})).option("checkpointLocation", f"{base}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert got == [{0: 15, 1: 10}, {0: 15}, {0: 10}]


@pytest.mark.parametrize("starting,first", [("earliest", {0: 0, 1: 0}), (json.dumps({"t": {"0": 15, "1": -1}}), {0: 15, 1: 5}), (json.dumps({"t": {"1": 4}}), {0: 0, 1: 4})])
def test_start_positions(spark, starting, first):
    root, base = fresh_path(spark, "t_topic"), fresh_path(spark, "t_run")
    tl.append_wave(spark, root, records(spark, 5, 4), "a")
    batches = drain(spark, root, base, 0, starting)
    assert len(batches) == 1
    got = {p: [o for _, q, o, _ in batches[0][1] if q == p] for p in (0, 1)}
    assert got == {0: list(range(first[0], 20)), 1: list(range(first[1], 5))}


def test_latest_starts_at_the_end_and_new_partitions_at_their_first_record(spark):
    root, base = fresh_path(spark, "t_topic"), fresh_path(spark, "t_run")
    tl.append_wave(spark, root, records(spark, 5), "a")
    got = []

    def run():
        source = tl.stream_topic(spark, root, "latest", 100, 1, f"{base}/cp")
        q = source.writeStream.foreachBatch(lambda df, b: got.extend((r.topic, r.partition, r.offset) for r in df.collect())).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None

    source = tl.stream_topic(spark, root, "latest", 100, 1, f"{base}/cp")
    q = source.writeStream.foreachBatch(lambda df, b: got.extend((r.topic, r.partition, r.offset) for r in df.collect())).option("checkpointLocation", f"{base}/cp").start()
    q.processAllAvailable()
    tl.append_wave(spark, root, records(spark, 2, 1, 100), "b")
    tl.append_wave(spark, root, records(spark, 1, 1, 200, "new"), "c")
    q.processAllAvailable()
    q.stop()
    assert sorted(got) == [("new", 0, 0), ("new", 1, 0), ("t", 0, 5), ("t", 0, 6), ("t", 1, 5), ("t", 1, 6)]
    run()
    assert len(got) == 6


def test_a_cap_needs_the_checkpoint(spark):
    with pytest.raises(ValueError):
        tl.stream_topic(spark, "/nowhere", records_per_s=5)
    assert tl.per_partition_cap(2000, 120) == 240_000 and tl.per_partition_cap(0, 120) == 0


def test_a_batch_is_spread_over_the_cores(spark):
    root = fresh_path(spark, "t_topic")
    ends = tl.append_wave(spark, root, records(spark, 30_000, 9).coalesce(1), "a").ends
    read = lambda tasks: tl.TopicLogReader({"path": root, "mintasks": str(tasks)}).partitions({}, ends)
    assert len(read(1)) == 2  # a task per topic partition
    parts = read(4)
    assert len(parts) == 5 and max(sum(hi - lo for _, lo, hi, _ in p.pieces) for p in parts) == 75_000
    reader, seen = tl.TopicLogReader({"path": root}), {0: [], 1: []}
    for p in parts:
        for rows in reader.read(p):
            seen[p.partition] += rows.column(4).to_pylist()
    assert seen == {0: list(range(270_000)), 1: list(range(30_000))}
    assert len(tl.TopicLogReader({"path": root, "mintasks": "64"}).partitions({}, ends)) == 7  # not in crumbs
