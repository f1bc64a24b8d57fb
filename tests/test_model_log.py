import json
import os

import pytest
from pyspark.sql import functions as F

from ratingstream.operators import kmeans as km
from ratingstream.plans import model_log as ml
from ratingstream.plans import model_table as mt
from ratingstream.session import fresh_path, read_text, replace_text


def state(spark, b, k=2):
    return km.state_frame(spark, [[float(b), float(i)] for i in range(k)], [float(b)] * k)


def grow(spark, log, ids):
    for b in ids:
        mt.write_batch(state(spark, b), f"{log.root}/state", b)
        log.commit(b)
        log.compact()


def folders(root):
    path = root.removeprefix("file:")
    return sorted(os.path.relpath(d, path) for d, _, files in os.walk(path) if "_SUCCESS" in files)


def seen(log):
    return sorted(r[0] for r in log.read().select("batch_id").distinct().collect())


@pytest.mark.parametrize("fanout", [2, 4, 16])
def test_ten_thousand_batches_keep_few_folders(fanout):
    m, rewritten, most = ml.Manifest(), 0, 0
    for b in range(10_000):
        m = ml.with_batch(m, b, ["state"])
        while group := ml.next_merge(m, fanout):
            m, one = ml.merged(m, group)
            rewritten += one.n
        most = max(most, len(m.segments))
        assert m.segments[-1].level == 0 and m.last == b  # the newest model has its own folder
    levels = 1
    while fanout**levels < 10_000:
        levels += 1
    assert most <= fanout + 1 + levels * (fanout - 1)
    assert rewritten <= levels * 10_000
    covered = [i for s in m.segments for i in range(s.first, s.last + 1)]
    assert covered == list(range(10_000)) and sum(s.n for s in m.segments) == m.n == 10_000


def test_rows_survive_compaction(spark):
    log = ml.ModelLog(spark, fresh_path(spark, "t_log"), fanout=3)
    ids = [-7, -3, 0, 1, 2, 3, 4, 8, 9, 10, 11, 12, 20, 21]
    grow(spark, log, ids)
    assert seen(log) == ids
    rows = {(r.batch_id, r.cluster): (r.center, r.weight) for r in log.read().collect()}
    assert rows == {(b, i): ([float(b), float(i)], float(b)) for b in ids for i in range(2)}
    assert log.read().schema["batch_id"].dataType.simpleString() == "bigint"
    # what lies on disk: the segments in use, and the folders of the last compaction (kept for readers that planned before it)
    again = ml.ModelLog(spark, log.root, fanout=3)
    assert again.manifest == log.manifest
    named = {s.path("state") for s in log.manifest.segments} | set(log.manifest.garbage)
    assert set(folders(log.root)) == named
    assert [b for b in range(-10, 30) if again.is_committed(b)] == ids
    assert again.before(8) == 4 and again.before(100) == 21
    assert km.model_arrays(again.model(2))[1].tolist() == [2.0, 2.0]
    assert again.begins(ids) and again.begins(ids + [30]) and not again.begins([-7, -2, *ids[2:]]) and not again.begins(ids[:-1])


def test_latest_model_reads_the_pointer_and_one_file(spark):
    log = ml.ModelLog(spark, fresh_path(spark, "t_log"), fanout=4)
    grow(spark, log, range(11))
    newest = ml.ModelLog(spark, log.root).latest_model()
    assert len(newest.inputFiles()) == 1 and "batch_id=10" in newest.inputFiles()[0]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert km.model_arrays(newest)[1].tolist() == [10.0, 10.0]


@pytest.mark.parametrize("step", ["merge", "swap", "remove"])
def test_crash_during_compaction_loses_nothing(spark, monkeypatch, step):
    log = ml.ModelLog(spark, fresh_path(spark, "t_log"), fanout=3)
    grow(spark, log, range(6))
    before = seen(log)
    mt.write_batch(state(spark, 6), f"{log.root}/state", 6)
    log.commit(6)

    def crash(*args, **kwargs):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        if step == "merge":
            m.setattr(ml.ModelLog, "_merge", crash)
        elif step == "swap":
            m.setattr(ml.ModelLog, "_swap", crash)
        else:
            m.setattr(ml, "remove_folder", crash)
        with pytest.raises(RuntimeError, match="crash"):
            log.compact()
    after = ml.ModelLog(spark, log.root, fanout=3)
    assert seen(after) == before + [6]
    after.compact()
    grow(spark, after, range(7, 12))
    assert seen(after) == list(range(12))
    named = {s.path("state") for s in after.manifest.segments} | set(after.manifest.garbage)
    assert set(folders(log.root)) == named


def test_batches_out_of_order_are_refused(spark):
    log = ml.ModelLog(spark, fresh_path(spark, "t_log"))
    grow(spark, log, [5])
    with pytest.raises(ValueError):
        log.commit(5)
    with pytest.raises(RuntimeError):
        log.before(3)


def test_tables_that_some_batches_lack(spark):
    log = ml.ModelLog(spark, fresh_path(spark, "t_log"), ("state", "extra"), fanout=2)
    for b in range(5):
        mt.write_batch(state(spark, b), f"{log.root}/state", b)
        if b % 2:
            spark.createDataFrame([(b * 10,)], "x long").write.parquet(f"{log.root}/extra/batch_id={b}")
        log.commit(b, ["state", "extra"] if b % 2 else ["state"])
        log.compact()
    assert seen(log) == list(range(5))
    assert sorted((r.batch_id, r.x) for r in log.read("extra").collect()) == [(1, 10), (3, 30)]
    with pytest.raises(RuntimeError):
        log.read("nothing")


def test_runs_from_before_the_log_are_taken_over(spark):
    root = fresh_path(spark, "t_log")
    for b in range(4):
        mt.write_batch(state(spark, b), f"{root}/state", b)
    mt.write_batch(state(spark, 9), f"{root}/state", 9)
    for b in range(4):  # 9 isn't marked as done
        path = f"{root}/commits".removeprefix("file:")
        os.makedirs(path, exist_ok=True)
        open(f"{path}/batch_id={b}", "w").close()
    log = ml.ModelLog(spark, root, ("state", "predictions"), legacy=f"{root}/commits", mark="", fanout=3)
    assert seen(log) == [0, 1, 2, 3] and log.last == 3
    assert json.loads(read_text(spark, log.pointer))["n"] == 4


def test_replaced_text_is_whole(spark):
    path = fresh_path(spark, "t_text") + "/CURRENT"
    assert read_text(spark, path) is None
    for text in ("one", "two, longer than before é", ""):
        replace_text(spark, path, text)
        assert read_text(spark, path) == text
    there = [f for f in os.listdir(os.path.dirname(path.removeprefix("file:"))) if not f.endswith(".crc")]
    assert there == ["CURRENT"]


def test_stream_tables_are_read_across_segments(spark):
    """A daily stream with a small fanout: every batch's rows are found, in segments or folders of their own."""
    from ratingstream.options import KMeansOptions, StreamOptions
    from ratingstream.streaming import job
    from test_stream import _setup

    vt, state0, recs = _setup(spark)
    paths = job.StreamPaths(fresh_path(spark, "t_stream_log"))
    mt.write_seed(spark, paths.state, state0)
    opts = StreamOptions(sample_fraction=0.2, compact_every=2)
    day = F.pmod("offset", F.lit(6))
    for b in range(6):
        assert job.process_batch(spark, recs.where(day == b), b, vt, paths, KMeansOptions(k=3, dim=vt.dim), opts)
    assert not job.process_batch(spark, recs.where(day == 0), 0, vt, paths, KMeansOptions(k=3, dim=vt.dim), opts)
    log = job.run_log(spark, paths)
    assert any(s.level for s in log.manifest.segments)
    ranges = job.read_table(spark, paths, "offsets")
    assert ranges.agg(F.sum("n")).first()[0] == recs.count()
    assert sorted(r[0] for r in ranges.select("batch_id").distinct().collect()) == list(range(6))
    wrong = job.read_table(spark, paths, "predictions").where(F.pmod("offset", F.lit(6)) != F.col("batch_id"))
    assert wrong.isEmpty()
