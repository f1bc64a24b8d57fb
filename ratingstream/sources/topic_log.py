"""A topic as tables: waves of records with gapless offsets per partition, and a stream source over them.

Writing. A wave's records are staged by one Spark write under ``<root>/data/<attempt>``, in files per topic
partition. One small manifest per wave, ``<root>/waves/<number>.json``, lists the files with their row counts and
first offsets; creating it is the commit, and a wave that is named in a manifest is never written again. So a
wave that died at any point, or was repeated, leaves each of its records in the log once. A record's offset is its
file's first offset plus its row's number in the file: nothing is sorted or rewritten to number it, and offsets
have no gaps. Two writers at a time are safe: the manifest's name can be created once, and the loser numbers
its files again after the winner's.

Reading. :func:`read_topic` is the whole log as a DataFrame. :class:`TopicLogSource` is a Spark data
source for streams (``readStream.format("topic_log")``). Its position is an offset per topic partition, as Kafka's;
a batch takes at most ``rate x interval`` records from every partition, whatever is waiting in the others. After
a restart the position is taken from the query's own checkpoint. Tasks read just their rows' row groups.
"""

from __future__ import annotations

import json
import sys
import uuid
from bisect import bisect_right
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schemas import KAFKA_RECORD
from ..session import create_text, list_names, read_text, remove_folder

# Python workers get this module by value, so they need not find the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "topic_log"
_STORED = "key binary, value binary, timestamp timestamp"
#: A batch is spread over the cores, but not in tasks of fewer rows than this.
MIN_TASK_ROWS = 50_000
#: A task decodes its rows' row groups from their beginning, so these are kept small.
ROW_GROUP_BYTES = 8 << 20


@dataclass
class Wave:
    number: int
    wave: str
    files: list[dict]  # path (under the root), topic, partition, first (offset), n
    ends: dict[str, dict[str, int]]  # after this wave, per topic and partition
    facts: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "wave": self.wave, "files": self.files, "ends": self.ends, "facts": self.facts})


def _name(number: int) -> str:
    return f"{number:012d}.json"


def _read_wave(spark: SparkSession, root: str, number: int) -> Wave | None:
    text = read_text(spark, f"{root}/waves/{_name(number)}")
    return None if text is None else Wave(**json.loads(text))


def waves(spark: SparkSession, root: str) -> list[Wave]:
    """All committed waves, in order."""
    root = root.rstrip("/")
    numbers = sorted(int(n[:-5]) for n in list_names(spark, f"{root}/waves") if n.endswith(".json") and n[:-5].isdigit())
    return [_read_wave(spark, root, n) for n in numbers]


def _staged_files(spark: SparkSession, root: str, attempt: str) -> list[dict]:
    """A row per staged file: where it is, its topic partition and its row count (from the files' footers)."""
    base = f"{root}/data/{attempt}"
    df = spark.read.schema(f"{_STORED}, topic string, partition int").option("basePath", base).parquet(base)
    rows = df.groupBy(F.col("_metadata.file_path").alias("path"), "topic", "partition").agg(F.count(F.lit(1)).alias("n")).collect()
    out = []
    for r in rows:
        path = unquote(r.path)
        out.append({"path": path[path.index(f"data/{attempt}/") :], "topic": r.topic, "partition": r.partition, "n": r.n})
    return sorted(out, key=lambda f: f["path"])


def append_wave(spark: SparkSession, root: str, records: DataFrame, wave: str | None = None, observation: Observation | None = None, **facts) -> Wave:
    """Add ``key, value, topic, partition[, timestamp]`` records to the log as one wave; returns its manifest.

    ``wave`` names it: a name that is already in the log is not written again and its manifest is returned
    (without a name every call is a wave). Records without a time get the time of the write. ``facts``, and what
    ``observation`` counted during the write, are kept in the manifest.
    """
    root, wave = root.rstrip("/"), wave or uuid.uuid4().hex
    done = waves(spark, root)
    for w in done:
        if w.wave == wave:
            return w
    attempt = uuid.uuid4().hex
    time = F.col("timestamp").cast("timestamp") if "timestamp" in records.columns else F.current_timestamp()
    key, value = F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    stored = records.select(key, value, time.alias("timestamp"), F.col("topic").cast("string").alias("topic"), F.col("partition").cast("int").alias("partition"))
    stored.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("topic", "partition").parquet(f"{root}/data/{attempt}")
    if observation is not None:
        facts |= {k: v for k, v in observation.get.items()}
    staged = _staged_files(spark, root, attempt)
    while True:
        ends = {t: dict(p) for t, p in done[-1].ends.items()} if done else {}
        files = []
        for f in staged:
            at = ends.setdefault(f["topic"], {})
            p = str(f["partition"])
            files.append(f | {"first": at.get(p, 0)})
            at[p] = at.get(p, 0) + f["n"]
        new = Wave(done[-1].number + 1 if done else 0, wave, files, ends, facts)
        if create_text(spark, f"{root}/waves/{_name(new.number)}", new.to_json()):
            return new
        done = waves(spark, root)  # another writer was first
        for w in done:
            if w.wave == wave:  # it was this very wave: what is staged here is not named by any manifest
                remove_folder(spark, f"{root}/data/{attempt}")
                return w


def remove_unfinished(spark: SparkSession, root: str) -> int:
    """Remove staged files that no wave names (left by writers that died). No writer may be active."""
    root = root.rstrip("/")
    named = {f["path"].split("/")[1] for w in waves(spark, root) for f in w.files}
    lost = [n for n in list_names(spark, f"{root}/data") if n not in named]
    for n in lost:
        remove_folder(spark, f"{root}/data/{n}")
    return len(lost)


def read_topic(spark: SparkSession, root: str) -> DataFrame:
    """Every committed record, with its offset (``key, value, topic, partition, offset, timestamp``)."""
    root = root.rstrip("/")
    files = [f for w in waves(spark, root) for f in w.files]
    if not files:
        return spark.createDataFrame([], KAFKA_RECORD)
    first = spark.createDataFrame([(f["path"], f["topic"], f["partition"], f["first"]) for f in files], "path string, topic string, partition int, first long")
    df = spark.read.schema(_STORED).parquet(*[f"{root}/{f['path']}" for f in files])
    # The path under the root: "data/<attempt>/...", as in the manifests.
    path = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "(data/[0-9a-f]{32}/.*)$", 1))
    rows = df.select("key", "value", "timestamp", path.alias("path"), F.col("_metadata.row_index").alias("row"))
    return rows.join(first, "path").select("key", "value", "topic", "partition", (F.col("first") + F.col("row")).alias("offset"), "timestamp")


# --------------------------------------------------------------------------- the stream source


def per_partition_cap(records_per_s: int, interval_s: int) -> int:
    """The most records that a batch takes from one partition (0: no cap)."""
    return max(0, int(records_per_s)) * max(1, int(interval_s)) if records_per_s else 0


class Range(InputPartition):
    """What one task reads: (path, first row, last row + 1, first row's offset) pieces of one topic partition."""

    def __init__(self, topic: str, partition: int, pieces: list[tuple[str, int, int, int]]):
        super().__init__((topic, partition))
        self.topic, self.partition, self.pieces = topic, partition, pieces


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class TopicLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.cap = per_partition_cap(int(options.get("rateperpartition", 0)), int(options.get("interval", 1)))
        self.start = options.get("startingoffsets", "latest")
        self.checkpoint = options.get("checkpoint")
        self.task_rows = int(options.get("taskrows", 1_000_000))
        self.min_tasks = int(options.get("mintasks", 1))
        self.position: dict | None = None
        self.waves: list[dict] = []
        self.files: dict[tuple[str, str], list[dict]] = {}

    def _refresh(self) -> None:
        """Take over manifests that are new; those read before don't change."""
        fs, path = _system(f"{self.root}/waves")
        while True:
            info = fs.get_file_info(f"{path}/{_name(len(self.waves))}")
            if info.type == pafs.FileType.NotFound:
                return
            with fs.open_input_stream(info.path) as f:
                wave = json.loads(f.read())
            self.waves.append(wave)
            for x in wave["files"]:
                self.files.setdefault((x["topic"], str(x["partition"])), []).append(x)

    def _ends(self) -> dict:
        self._refresh()
        return self.waves[-1]["ends"] if self.waves else {}

    def initialOffset(self) -> dict:
        ends = self._ends()
        if self.start == "latest":
            return {t: dict(p) for t, p in ends.items()}
        if self.start == "earliest":
            return {t: {k: 0 for k in p} for t, p in ends.items()}
        given = json.loads(self.start)  # per topic and partition; -1: latest, -2 or not given: earliest
        at = {t: {k: given.get(t, {}).get(k, -2) for k in p} for t, p in ends.items()}
        return {t: {k: ends[t][k] if v == -1 else max(0, min(int(v), ends[t][k])) for k, v in p.items()} for t, p in at.items()}

    def _checkpointed(self) -> dict | None:
        """The offsets that the query's checkpoint planned last."""
        if not self.checkpoint:
            return None
        fs, path = _system(f"{self.checkpoint.rstrip('/')}/offsets")
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        names = [i.path for i in fs.get_file_info(pafs.FileSelector(path)) if i.base_name.isdigit()]
        if not names:
            return None
        with fs.open_input_stream(max(names, key=lambda n: int(n.rsplit("/", 1)[-1]))) as f:
            return json.loads(f.read().decode().splitlines()[2])

    def latestOffset(self) -> dict:
        ends = self._ends()
        if self.position is None:
            self.position = self._checkpointed() or self.initialOffset()
        at = self.position
        most = lambda t, k, end: min(end, at.get(t, {}).get(k, 0) + self.cap) if self.cap else end
        return {t: {k: max(at.get(t, {}).get(k, 0), most(t, k, end)) for k, end in p.items()} for t, p in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self._refresh()
        self.position = end
        total = sum(max(0, int(until) - int(start.get(t, {}).get(k, 0))) for t, p in end.items() for k, until in p.items())
        task_rows = min(self.task_rows, max(MIN_TASK_ROWS, -(-total // self.min_tasks)))
        out = []
        for t, p in end.items():
            for k, until in p.items():
                at, files = int(start.get(t, {}).get(k, 0)), self.files.get((t, k), [])
                firsts = [f["first"] for f in files]
                pieces, rows = [], 0
                i = max(0, bisect_right(firsts, at) - 1)
                while at < until and i < len(files):
                    f = files[i]
                    n = min(until, f["first"] + f["n"]) - at
                    n = min(n, task_rows - rows)
                    if n > 0:
                        pieces.append((f"{self.root}/{f['path']}", at - f["first"], at - f["first"] + n, at))
                        at, rows = at + n, rows + n
                    if rows >= task_rows:
                        out.append(Range(t, int(k), pieces))
                        pieces, rows = [], 0
                    if at >= f["first"] + f["n"]:
                        i += 1
                if at < until:
                    raise ValueError(f"offsets {at} to {until} of {t}-{k} are not in the log")
                if pieces:
                    out.append(Range(t, int(k), pieces))
        return out

    def read(self, partition: Range):
        for path, lo, hi, offset in partition.pieces:
            fs, inner = _system(path)
            with fs.open_input_file(inner) as f:
                file, at = pq.ParquetFile(f), 0
                for g in range(file.metadata.num_row_groups):
                    n = file.metadata.row_group(g).num_rows
                    a, b = max(lo, at), min(hi, at + n)
                    if a < b:
                        done = at
                        for rows in file.iter_batches(row_groups=[g], columns=["key", "value", "timestamp"]):
                            if done >= b:
                                break
                            x, y = max(a, done), min(b, done + rows.num_rows)
                            if x < y:
                                part = rows.slice(x - done, y - x)
                                offsets = pa.array(range(offset + x - lo, offset + y - lo), pa.int64())
                                time = pc.cast(part.column(2), pa.timestamp("us", "UTC"))
                                cols = [part.column(0), part.column(1), pa.repeat(partition.topic, y - x), pa.repeat(pa.scalar(partition.partition, pa.int32()), y - x), offsets, time]
                                yield pa.RecordBatch.from_arrays(cols, ["key", "value", "topic", "partition", "offset", "timestamp"])
                            done += rows.num_rows
                    at += n


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return KAFKA_RECORD

    def streamReader(self, schema) -> TopicLogReader:
        return TopicLogReader({k.lower(): v for k, v in self.options.items()})


def stream_topic(
    spark: SparkSession, root: str, starting_offsets: str = "latest", records_per_s: int = 0, interval_s: int = 1, checkpoint: str | None = None, task_rows: int = 1_000_000
) -> DataFrame:
    """The log as a stream. ``checkpoint`` is the query's checkpoint folder: with a cap it is needed to go on after a restart.

    ``starting_offsets``: ``latest``, ``earliest`` or JSON ``{topic: {partition: offset}}`` (-1: latest, -2: earliest), for
    a query without a checkpoint. Partitions that appear later are read from their first record. An ``availableNow`` run
    takes one capped batch. Tasks read ``task_rows`` rows at most, and fewer if that leaves cores idle.
    The folders are read through Arrow's file systems (local, S3, GCS, HDFS with libhdfs).
    """
    if records_per_s and not checkpoint:
        raise ValueError("a capped topic log needs the query's checkpoint folder to find its position after a restart")
    spark.dataSource.register(TopicLogSource)
    options = {"path": root, "startingOffsets": starting_offsets, "ratePerPartition": str(int(records_per_s)), "interval": str(int(interval_s)), "taskRows": str(int(task_rows)), "minTasks": str(spark.sparkContext.defaultParallelism)}
    if checkpoint:
        options["checkpoint"] = checkpoint
    return spark.readStream.format(FORMAT).options(**options).load()


def caught_up(spark: SparkSession, root: str, checkpoint: str) -> bool:
    """Whether a query's checkpoint has planned all that the log holds."""
    reader = TopicLogReader({"path": root, "checkpoint": checkpoint})
    return (reader._checkpointed() or {}) == reader._ends()
