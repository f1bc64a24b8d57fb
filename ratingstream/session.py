"""Session helpers: a local session for tests and the shared scratch folder.

Intermediate tables (model state, movie vectors, fixtures) are written under
the folder the cluster names in ``spark.checkpoint.dir``. We read that setting
from the session; only when it is unset and the master is local (tests, bench)
do we pick our own folder.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", app: str = "ratingstream", **conf) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` (or a directory set with ``setCheckpointDir``) wins.
    When neither is set we only make our own folder in local mode; on a
    cluster a machine-local folder would not be seen by the executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder all executors share"
            )
        root = tempfile.mkdtemp(prefix="ratingstream-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (not created)."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "ratingstream", *parts])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder for one run."""
    return scratch_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def publish_folder(spark: SparkSession, src: str, dst: str) -> None:
    """Move a finished folder into place in one rename, so a file stream never sees half of it."""
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise RuntimeError(f"could not move {src} to {dst}")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, or None if there is no such file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that readers see the old content or the new, never a part.

    Written beside its place, then renamed over it in one step. (On an object store, where a
    rename is a copy, the put of the finished object is what replaces it in one step.)
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    beside = _written_beside(spark, fs, target, text)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, how)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file in one step; False, and nothing changes, if there is one already."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    if fs.exists(target):
        return False
    beside = _written_beside(spark, fs, target, text)
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, how)
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        fs.delete(beside, False)
        return False
    return True


def _written_beside(spark: SparkSession, fs, target, text: str):
    """A hidden file with the text in the target's folder."""
    fs.mkdirs(target.getParent())
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return beside


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (hidden ones left out); none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(n for st in fs.listStatus(p) if not (n := st.getPath().getName()).startswith((".", "_")))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def file_stamps(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of files, sorted."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        st = p.getFileSystem(conf).getFileStatus(p)
        out.append((path, int(st.getLen()), int(st.getModificationTime())))
    return sorted(out)


def folder_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def is_complete(spark: SparkSession, path: str) -> bool:
    """A table folder counts as written once its ``_SUCCESS`` marker exists."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


__all__ = [
    "local_session",
    "checkpoint_root",
    "scratch_path",
    "fresh_path",
    "path_exists",
    "is_complete",
    "publish_folder",
    "read_text",
    "create_text",
    "list_names",
    "replace_text",
    "remove_folder",
    "folder_bytes",
    "file_stamps",
    "touch",
]
