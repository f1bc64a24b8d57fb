"""Movie vectors on disk: bucketed tables that join in place, kept in versions by content.

A table is written hash-partitioned and sorted by movie (Spark's bucketing), with a small description beside its
files. A session opens it by entering it in its own catalog, so also a restarted job joins to it without moving a
vector: the bucketed scan is already partitioned as the join needs it.

A store keeps one table per content of the tag scores. The content's fingerprint doesn't depend on the order or the
files of the scores. Before each batch the store looks at the files' names, sizes and times; only if they changed
it reads them for the fingerprint, and only a new fingerprint builds a table, beside the one in use. Which version
a batch uses is written down before the batch starts, so a batch that is run again uses the same
vectors, whatever has changed since; the next new batch uses the new ones.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import tag_score_rejects, vector_bytes
from ..session import create_text, file_stamps, list_names, path_exists, read_text, remove_folder, replace_text
from ..sources.files import scan_tag_scores
from . import pipeline as pl

DESCRIPTION = "_vectors.json"


#: Bytes of vectors that a bucket is meant to hold in memory.
BUCKET_BYTES = 8 << 20


def bucket_count(spark: SparkSession, n: int, dim: int) -> int:
    """Buckets for ``n`` vectors: as many as their size needs, and one per core at least.

    Every batch runs a task per bucket, most of them with a Python worker and a shuffle file each, so
    buckets that hold next to nothing cost each batch as much as the work itself.
    """
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(1, least, -(-n * vector_bytes(dim) // BUCKET_BYTES))


def write_bucketed(spark: SparkSession, vectors: DataFrame, path: str, dim: int, buckets: int | None = None) -> None:
    """Write vectors in files by ``movie_id``, sorted within; complete once the description is there.

    Without ``buckets`` their number follows from the vectors' (:func:`bucket_count`), which are made once for both.
    """
    path = path.rstrip("/")
    name = f"writing_{uuid.uuid4().hex}"
    made = vectors if buckets else vectors.persist(StorageLevel.DISK_ONLY)
    try:
        buckets = buckets or bucket_count(spark, made.count(), dim)
        dealt = made.repartition(buckets, "movie_id")
        dealt.write.mode("overwrite").bucketBy(buckets, "movie_id").sortBy("movie_id").option("path", path).format("parquet").saveAsTable(name)
    finally:
        if made.is_cached:
            made.unpersist()
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    replace_text(spark, f"{path}/{DESCRIPTION}", json.dumps({"buckets": buckets, "columns": columns}))


def open_bucketed(spark: SparkSession, path: str) -> tuple[DataFrame, int] | None:
    """The table and its number of buckets, or None if the folder holds none (or an unfinished one)."""
    path = path.rstrip("/")
    text = read_text(spark, f"{path}/{DESCRIPTION}")
    if text is None:
        return None
    d = json.loads(text)
    # In this session's catalog under a name that follows from the folder.
    name = f"vectors_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({d['columns']}) USING parquet "
        f"CLUSTERED BY (movie_id) SORTED BY (movie_id) INTO {int(d['buckets'])} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name), int(d["buckets"])


def content_fingerprint(scores: DataFrame) -> str:
    """A digest of a table's rows as a multiset: the same for any order, files or partitioning."""
    row = F.struct(*[F.col(c) for c in scores.columns])
    hashes = [F.xxhash64(F.lit(seed), F.to_json(row)).cast("decimal(38,0)") for seed in (1, 2)]
    r = scores.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(hashes)]).first()
    return hashlib.sha256(f"{r.n}:{r.h0}:{r.h1}".encode()).hexdigest()[:16]


class VectorStore:
    """Versions of the vectors of one tag-score file (or folder) under ``root``."""

    def __init__(self, spark: SparkSession, root: str, tag_scores_path: str, dim: int, on_error: str = "quarantine"):
        self.spark, self.root, self.source, self.dim, self.on_error = spark, root.rstrip("/"), tag_scores_path, dim, on_error
        self.opened: dict[str, pl.VectorTable] = {}
        self.stamp: str | None = None
        self.version: str | None = None

    def _scores(self) -> DataFrame:
        return scan_tag_scores(self.spark, self.source)

    def _stamp(self) -> str:
        return hashlib.sha256(json.dumps(file_stamps(self.spark, self._scores().inputFiles())).encode()).hexdigest()

    def path(self, version: str) -> str:
        return f"{self.root}/version={version}"

    def refresh(self) -> str:
        """The version of the scores as they are now; built if it is new."""
        stamp = self._stamp()
        if stamp == self.stamp:
            return self.version
        known = read_text(self.spark, f"{self.root}/stamps/{stamp}")  # a restarted job needn't read the scores again
        version = known or content_fingerprint(self._scores())
        if not self._complete(version):
            scores = self._scores()
            tag_score_rejects(scores, self.dim).write.mode("overwrite").parquet(f"{self.root}/rejects/version={version}")
            vectors = pl.movie_vectors(scores, self.dim, self.on_error)
            write_bucketed(self.spark, vectors, self.path(version), self.dim)
        if known is None and self._stamp() == stamp:  # the files didn't change while they were read
            create_text(self.spark, f"{self.root}/stamps/{stamp}", version)
        self.stamp, self.version = stamp, version
        return version

    def _complete(self, version: str) -> bool:
        return path_exists(self.spark, f"{self.path(version)}/{DESCRIPTION}")

    def open(self, version: str) -> pl.VectorTable:
        if version not in self.opened:
            if not self._complete(version):
                raise RuntimeError(f"vectors of version {version} are not under {self.root}")
            for t in self.opened.values():  # one version's vectors are cached at a time
                t.unpersist()
            self.opened = {version: pl.materialize_vectors(self.spark, None, self.dim, self.path(version))}
            self.opened[version].version = version
        return self.opened[version]

    def current(self) -> pl.VectorTable:
        return self.open(self.refresh())

    def for_batch(self, batch_id: int, run_root: str) -> pl.VectorTable:
        """The vectors of a batch: those it was begun with, or the current ones, which are then its own."""
        chosen = f"{run_root.rstrip('/')}/vectors_chosen/{int(batch_id)}"
        version = read_text(self.spark, chosen)
        if version is None:
            version = self.refresh()
            if not create_text(self.spark, chosen, version):
                version = read_text(self.spark, chosen)
            for n in list_names(self.spark, f"{run_root.rstrip('/')}/vectors_chosen"):  # earlier batches are done
                if re.fullmatch(r"-?\d+", n) and int(n) < batch_id - 1:
                    remove_folder(self.spark, f"{run_root.rstrip('/')}/vectors_chosen/{n}")
        return self.open(version)


__all__ = ["VectorStore", "bucket_count", "content_fingerprint", "open_bucketed", "write_bucketed"]
