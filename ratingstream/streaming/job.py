"""The streaming clusterer: rating stream → per-batch model update → reports.

``run_stream`` wires a Structured Streaming source to ``foreachBatch``. For
each micro-batch, in order:

1. parse the message values (cached for the batch); bad rows go to
   ``quarantine/batch_id=N``;
2. count the good ratings per movie, join the counts to the cached movie
   vectors (which stay in place), assign each movie to its nearest centre
   and sum per cluster: one distributed aggregate, K rows out;
3. fold the K sums into the previous model on the driver (decay, mini-batch
   rule, split), as MLlib's streaming k-means does;
4. score a 1 % sample of the batch with the updated model and write it to
   ``predictions/batch_id=N``; write Kafka offset ranges to ``offsets/``
   (these writes, the dated model and prediction reports, the quarantine and the
   state run as concurrent jobs);
5. write the new model to ``state/batch_id=N`` (with the outputs above), then
   commit the batch to the run's log (one pointer, replaced atomically), which also merges
   old batches' folders as they grow in number.

Replays are idempotent: a committed batch is skipped, others are
recomputed and overwrite their folders. The streaming checkpoint holds the
source offsets; the state table holds the model, so a restarted query goes
on from the last finished batch. What became of each batch's commit, errors included, is
logged in ``commit_log/`` (:mod:`ratingstream.streaming.commit_log`).

Batch ids of the tables are the query's own plus a base kept beside the checkpoint's
offsets. A query with a new checkpoint (the old one was lost, or another is named) counts its
batches from 0 again; its base is then one past the last committed batch, so its
records are trained on and no folder of an earlier batch is taken for its own.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import kmeans as km
from ..operators.features import sample_rows
from ..operators.parse import REJECT_COL, accepted, parse_rating, quarantined
from ..operators.reports import model_report, offset_ranges, prediction_report
from ..options import KMeansOptions, StreamOptions
from ..plans import model_table as mt
from ..plans import pipeline as pl
from ..plans.model_log import ModelLog
from ..plans.vector_store import VectorStore
from ..session import fresh_path, path_exists, touch
from .commit_log import watch


@dataclass(frozen=True)
class StreamPaths:
    root: str

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def offsets(self) -> str:
        return f"{self.root}/offsets"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    @property
    def clock(self) -> str:
        return f"{self.root}/clock"

    @property
    def commits(self) -> str:
        return f"{self.root}/commits"

    @property
    def model_reports(self) -> str:
        return f"{self.root}/model_report"

    @property
    def prediction_reports(self) -> str:
        return f"{self.root}/prediction_report"


TRIGGER_COL = "_trigger_time"


def _record_columns(batch: DataFrame) -> tuple[list, list[str]]:
    """Columns kept next to the parsed rating, and the sampling key."""
    cols = set(batch.columns)
    keep, key = [], []
    for c in ("topic", "partition", "offset", "timestamp"):
        if c in cols:
            keep.append(c)
    if {"partition", "offset"} <= cols:
        key = ["topic", "partition", "offset"] if "topic" in cols else ["partition", "offset"]
    return keep, key


def process_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    vt: pl.VectorTable,
    paths: StreamPaths,
    kmeans: KMeansOptions,
    opts: StreamOptions,
    memo: dict | None = None,
) -> bool:
    """Run one micro-batch; returns False when it was already complete.

    ``memo`` keeps the last written model on the driver (K rows), so the next
    batch need not read it back; after a restart it is read from the table.
    """
    log = run_log(spark, paths, opts.compact_every)
    if log.is_committed(batch_id):
        return False
    prev_id = log.before(batch_id)
    if memo and memo.get("batch_id", batch_id) == prev_id:
        centers, weights = memo["centers"], memo["weights"]
    else:
        centers, weights = km.model_arrays(log.model(prev_id))
    km.check_dim(centers, vt.dim)

    keep, key = _record_columns(batch)
    if TRIGGER_COL in batch.columns:
        keep = keep + [TRIGGER_COL]
    lines = batch.select(*keep, F.col("value").cast("string").alias("value"))
    parsed = parse_rating(lines, keep=keep + ["value"], on_error=opts.on_error)
    if opts.scale_by_rating:  # such a rating would make its vector, and then a centre, not finite for good
        odd = F.isnan("rating") | (F.abs("rating") == float("inf"))
        parsed = parsed.withColumn(REJECT_COL, F.when(odd, F.lit("rating_not_finite")).otherwise(F.col(REJECT_COL)))
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    cached = [parsed]
    try:
        good = accepted(parsed).drop("value")
        counts = pl.movie_counts(good, opts.scale_by_rating)
        held = None if memo is None else memo.get("assignment")
        if held is None or held.vt is not vt:
            held = pl.incremental_assignment(spark, vt, centers, opts)
            if memo is not None:
                memo["assignment"] = held
        clusters = held.at(centers) if held else None
        # the K cluster sums (this job also fills the cache of the parsed batch)
        n, total = pl.batch_sums(counts, vt, centers, opts.scale_by_rating, opts.assign_method, clusters)
        outputs = []
        if opts.replay_idle_intervals and TRIGGER_COL in keep:
            now = parsed.agg(F.max(F.unix_millis(TRIGGER_COL))).first()[0]
            before = _trigger_millis(spark, paths, prev_id, memo)
            idle = idle_intervals(before, now, opts.interval_s)
            centers, weights = km.train_idle(centers, weights, idle, kmeans.decay, kmeans.time_unit)
            clock = spark.createDataFrame([(int(now), idle)], "trigger_ms long, idle_intervals int")
            outputs.append((clock, "clock"))
        new_centers, new_weights = km.train_step_arrays(
            centers, weights, n, total, kmeans.decay, kmeans.time_unit
        )

        if key:
            sample = sample_rows(good, opts.sample_fraction, seed=opts.sample_seed, key_cols=key)
        else:
            sample = sample_rows(good, opts.sample_fraction, seed=opts.sample_seed + int(batch_id))
        sample = sample.drop(TRIGGER_COL)
        preds = pl.assign_ratings(
            sample, vt, new_centers, opts.assign_method, opts.broadcast_limit_bytes,
            scale_by_rating=opts.scale_by_rating, hot_rows=opts.hot_movie_rows,
            clusters=held.at(new_centers) if held else None,
        )
        preds = preds.persist(StorageLevel.MEMORY_AND_DISK)  # the sample, written and reported
        cached.append(preds)
        new_state = km.state_frame(spark, new_centers, new_weights)
        by_offset = "offset" in keep
        groups = tuple(c for c in ("topic", "partition") if c in keep) if by_offset else ()
        report = prediction_report(preds, order_col="offset" if by_offset else None, span=opts.report_span, group_cols=groups)
        outputs += [
            (preds, "predictions"),
            (quarantined(parsed).drop(TRIGGER_COL), "quarantine"),
        ]
        if "offset" in keep and "partition" in keep:
            rng = offset_ranges(
                parsed.select(*[c for c in ("topic", "partition", "offset") if c in keep], "reject_reason")
            )
            outputs.append((rng, "offsets"))
        outputs += [
            (model_report(new_state.coalesce(1)), "model_report"),
            (report, "prediction_report"),
            (new_state.coalesce(1), "state"),
        ]
        if vt.version:
            outputs.append((spark.createDataFrame([(vt.version,)], "version string").coalesce(1), "vectors"))
        # the outputs are independent jobs over the cached batch: submit them
        # together so their small stages share the executors
        with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
            for f in [pool.submit(_overwrite, df, mt.batch_path(f"{paths.root}/{t}", batch_id)) for df, t in outputs]:
                f.result()
        # only now is the batch done
        log.commit(batch_id, [t for _, t in outputs])
        log.compact()
        if memo is not None:
            memo.update(batch_id=batch_id, centers=new_centers, weights=new_weights)
            if opts.replay_idle_intervals and TRIGGER_COL in keep:
                memo["trigger_ms"] = now
    finally:
        for df in cached:
            df.unpersist()
    return True


#: The tables of a run, by folder.
TABLES = ("state", "predictions", "quarantine", "offsets", "clock", "model_report", "prediction_report", "vectors")


def run_log(spark: SparkSession, paths: StreamPaths, fanout: int = StreamOptions.compact_every) -> ModelLog:
    """The run's committed batches; a run from before the log is taken over from its markers (``commits/``)."""
    return ModelLog(spark, paths.root, TABLES, legacy=paths.commits, mark="", fanout=fanout)


def is_committed(spark: SparkSession, paths: StreamPaths, batch_id: int) -> bool:
    """A batch is done once the log names it (after all its outputs are written)."""
    return run_log(spark, paths).is_committed(batch_id)


_BASE = re.compile(r"batch_base=(\d+)$")


def batch_base(spark: SparkSession, paths: StreamPaths, checkpoint: str) -> int:
    """What this checkpoint's batch ids are counted from in the tables; fixed when the checkpoint is first used."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/batch_base=*")
    marks = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    for st in marks:
        return int(_BASE.search(st.getPath().getName()).group(1))
    if path_exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        return 0  # begun before bases were kept
    last = run_log(spark, paths).last
    base = 0 if last is None else last + 1
    touch(spark, f"{checkpoint.rstrip('/')}/batch_base={base}")
    return base


def idle_intervals(before_ms: int | None, now_ms: int, interval_s: int) -> int:
    """Whole intervals that passed without a batch between two trigger times."""
    if before_ms is None or interval_s <= 0:
        return 0
    return max(0, int((now_ms - before_ms) // (interval_s * 1000)) - 1)


def _trigger_millis(spark: SparkSession, paths: StreamPaths, batch_id: int, memo: dict | None) -> int | None:
    if memo is not None and memo.get("batch_id") == batch_id and "trigger_ms" in memo:
        return memo["trigger_ms"]
    if not mt.has_batch(spark, paths.clock, batch_id):
        return None
    return spark.read.parquet(mt.batch_path(paths.clock, batch_id)).first()["trigger_ms"]


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def run_stream(
    spark: SparkSession,
    source: DataFrame,
    vt: pl.VectorTable | VectorStore,
    state0: DataFrame,
    out_dir: str | None = None,
    kmeans: KMeansOptions = KMeansOptions(),
    opts: StreamOptions = StreamOptions(),
    available_now: bool = False,
    query_name: str | None = None,
    checkpoint: str | None = None,
) -> tuple[StreamingQuery, StreamPaths]:
    """Start the clusterer on a streaming source of rating records or lines.

    ``source`` needs a ``value`` column (bytes or text); Kafka's ``topic``,
    ``partition``, ``offset``, ``timestamp`` are used when present.
    Given a :class:`VectorStore`, each batch looks for changed tag scores first; a batch that is
    run again uses the vectors it was begun with, and each state's version is kept in ``vectors/``.
    ``available_now`` processes what is there and stops (tests, backfills);
    otherwise batches fire every ``opts.interval_s`` seconds. ``checkpoint``
    names another checkpoint folder than ``<out_dir>/checkpoint``.
    """
    paths = StreamPaths(out_dir or fresh_path(spark, "stream"))
    mt.write_seed(spark, paths.state, state0)
    if opts.replay_idle_intervals:
        # inside a micro-batch, current_timestamp() is the batch's trigger time,
        # kept in the offset log, so a replayed batch sees the same value
        source = source.withColumn(TRIGGER_COL, F.current_timestamp())

    memo: dict = {}
    checkpoint = checkpoint or paths.checkpoint
    base = batch_base(spark, paths, checkpoint)

    def fn(batch: DataFrame, batch_id: int) -> None:
        own = base + batch_id
        vectors = vt.for_batch(own, paths.root) if isinstance(vt, VectorStore) else vt
        process_batch(spark, batch, own, vectors, paths, kmeans, opts, memo)

    name = query_name or f"ratings-{uuid.uuid4().hex[:12]}"
    if opts.commit_log:
        watch(spark, paths.root, checkpoint, name, base)
    writer = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{int(opts.interval_s)} seconds")
    return writer.start(), paths


def read_table(spark: SparkSession, paths: StreamPaths, table: str) -> DataFrame:
    """All committed rows of one of the run's tables, with their ``batch_id``."""
    return run_log(spark, paths).read(table)
