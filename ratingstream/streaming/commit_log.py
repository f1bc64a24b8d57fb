"""A log of what became of every batch's commit: success or error, offset ranges, duration.

A listener hears from Spark that a batch's offsets are committed (the query's progress) or that the query
ended with an error. An error belongs to the batch that the checkpoint has planned but not committed;
its ranges are read from the checkpoint's offset log. Each outcome is one row, so a batch that failed and was
retried has a row for every attempt. Rows are kept like a run's other tables (see :mod:`ratingstream.plans.model_log`):
one small folder per outcome, merged as they grow in number. The listener works beside the stream; the
stream doesn't wait for it.
"""

from __future__ import annotations

import json
import threading
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..plans import model_table as mt
from ..plans.model_log import ModelLog
from ..session import list_names, read_text, replace_text

OUTCOMES = "outcomes"
SCHEMA = (
    "batch long, outcome string, error string, duration_ms long, n_records long, "
    "ranges array<struct<topic string, partition int, from_offset long, until_offset long>>, query_run string, logged_at timestamp"
)


def offset_pairs(start: dict | None, end: dict | None) -> list[tuple[str, int, int, int]]:
    """(topic, partition, from, until) of Kafka-shaped offsets ``{topic: {partition: offset}}``; nothing for other shapes."""
    out = []
    for topic, parts in sorted((end or {}).items()):
        if not isinstance(parts, dict):
            return []
        for p, until in sorted(parts.items(), key=lambda x: int(x[0])):
            begin = ((start or {}).get(topic) or {}).get(p, 0)
            if until > begin:
                out.append((topic, int(p), int(begin), int(until)))
    return out


def _json(text: str | None) -> dict | None:
    try:
        value = json.loads(text) if text else None
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def unfinished_batch(spark: SparkSession, checkpoint: str) -> tuple[int | None, dict | None, dict | None]:
    """The batch that a checkpoint has planned but not committed, with its start and end offsets; (None, …) if there is none."""
    checkpoint = checkpoint.rstrip("/")
    planned = [int(n) for n in list_names(spark, f"{checkpoint}/offsets") if n.isdigit()]
    done = [int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not planned or max(planned) <= max(done, default=-1):
        return None, None, None

    def offsets(batch: int) -> dict | None:
        text = read_text(spark, f"{checkpoint}/offsets/{batch}") if batch in planned else None
        return _json(text.splitlines()[2]) if text else None

    last = max(planned)
    return last, offsets(last - 1), offsets(last)


class CommitLog(StreamingQueryListener):
    """Writes the outcomes of one query's batches under ``<root>/commit_log``; ``base`` is added to the query's batch ids."""

    def __init__(self, spark: SparkSession, root: str, checkpoint: str, name: str, base: int = 0, fanout: int = 16):
        super().__init__()
        self.spark, self.checkpoint, self.name, self.base, self.fanout = spark, checkpoint, name, base, fanout
        self.root = log_root(root)
        self.run: str | None = None
        self.since = time.monotonic()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run, self.since = str(event.runId), time.monotonic()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) != self.run or "addBatch" not in p.durationMs:  # another query, or a trigger without a batch
            return
        ranges = [r for s in p.sources for r in offset_pairs(_json(s.startOffset), _json(s.endOffset))]
        self._write(self.base + p.batchId, "committed", None, int(p.durationMs.get("triggerExecution", p.batchDuration)), int(p.numInputRows), ranges)
        self.since = time.monotonic()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) != self.run:
            return
        try:
            if event.exception:
                batch, start, end = unfinished_batch(self.spark, self.checkpoint)
                ranges = offset_pairs(start, end)
                n = sum(u - f for *_, f, u in ranges) if ranges else None
                spent = int((time.monotonic() - self.since) * 1000)
                self._write(None if batch is None else self.base + batch, "failed", first_line(event.exception), spent, n, ranges)
        finally:
            self.ended.set()
            # not from this callback, which the listeners are being called from
            threading.Thread(target=self.spark.streams.removeListener, args=(self,), daemon=True).start()

    def _write(self, batch_id: int | None, outcome: str, error: str | None, duration: int, n: int | None, ranges: list) -> None:
        log = _log(self.spark, self.root, self.fanout)
        number = 0 if log.last is None else log.last + 1
        names = ("topic", "partition", "from_offset", "until_offset")
        row = {
            "batch": batch_id, "outcome": outcome, "error": error, "duration_ms": duration, "n_records": n,
            "ranges": [dict(zip(names, r)) for r in ranges], "query_run": self.run, "logged_at": datetime.now(timezone.utc).isoformat(),
        }
        # a line of JSON needs no job: the stream's next batch isn't kept waiting for executors
        replace_text(self.spark, f"{mt.batch_path(f'{self.root}/{OUTCOMES}', number)}/row.json", json.dumps(row) + "\n")
        log.commit(number, [OUTCOMES])
        log.compact()


def _log(spark: SparkSession, root: str, fanout: int = 16) -> ModelLog:
    return ModelLog(spark, root, (OUTCOMES,), fanout=fanout, fmt="json", schema=SCHEMA)


def log_root(root: str) -> str:
    return f"{root.rstrip('/')}/commit_log"


def first_line(text: str) -> str:
    """The error's own line: what Python raised last, or the first line."""
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    own = [x for x in lines if x.split(":")[0].endswith(("Error", "Exception")) and ":" in x and not x.startswith(("at ", "org.", "java.", "py4j."))]
    return (own or lines or [""])[-1 if own else 0][:1000]


def read_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """``attempt`` (outcomes are numbered as they came), ``batch_id`` (null if no batch was under way) and the rest of ``SCHEMA``."""
    log = _log(spark, log_root(root))
    rows = spark.createDataFrame([], f"{SCHEMA}, batch_id long") if log.last is None else log.read(OUTCOMES)
    rest = [c for c in rows.columns if c not in ("batch", "batch_id")]
    return rows.select(F.col("batch_id").alias("attempt"), F.col("batch").alias("batch_id"), *rest)


_LISTENERS: dict[str, CommitLog] = {}


def watch(spark: SparkSession, root: str, checkpoint: str, name: str, base: int = 0) -> CommitLog:
    """Listen to the query of this name, which is started next; it stops listening when the query ends."""
    listener = CommitLog(spark, root, checkpoint, name, base)
    spark.streams.addListener(listener)
    _LISTENERS[name] = listener
    return listener


def wait_logged(query: StreamingQuery, timeout_s: float = 60) -> bool:
    """Wait until the end of a query that has ended is logged, and with it all of its batches."""
    listener = _LISTENERS.pop(query.name, None)
    return listener is None or listener.ended.wait(timeout_s)
