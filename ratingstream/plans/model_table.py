"""The model as a table keyed by batch id: ``<root>/batch_id=N`` with K rows each.

A batch counts once :mod:`ratingstream.plans.model_log` names it, which happens after
all of its outputs are written. A batch that is redone starts from the state of the batch before it
and overwrites any partial output.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MODEL_STATE
from ..session import is_complete

#: Stands for the model before the first batch; its folder is ``<root>/seed``, outside the batch ids.
SEED = None
_DIR = re.compile(r"batch_id=(-?\d+)$")


def write_state(state: DataFrame, path: str) -> None:
    state.select("cluster", "center", "weight").coalesce(1).write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_STATE).parquet(path)


def batch_path(root: str, batch_id: int | None) -> str:
    if batch_id is None:
        return f"{root.rstrip('/')}/seed"
    return f"{root.rstrip('/')}/batch_id={int(batch_id)}"


def has_batch(spark: SparkSession, root: str, batch_id: int | None) -> bool:
    return is_complete(spark, batch_path(root, batch_id))


def complete_batches(spark: SparkSession, root: str, mark: str = "_SUCCESS") -> list[int]:
    """Batch ids with a complete state folder: one pattern listing, no call per folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch_id=*/{mark}" if mark else f"{root.rstrip('/')}/batch_id=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    names = ((st.getPath().getParent() if mark else st.getPath()).getName() for st in found)
    return sorted(int(m.group(1)) for m in map(_DIR.search, names) if m)


def write_seed(spark: SparkSession, root: str, state0: DataFrame) -> None:
    if not has_batch(spark, root, SEED):
        write_state(state0, batch_path(root, SEED))


def read_batch(spark: SparkSession, root: str, batch_id: int | None) -> DataFrame:
    return read_state(spark, batch_path(root, batch_id))


def write_batch(state: DataFrame, root: str, batch_id: int | None) -> None:
    write_state(state, batch_path(root, batch_id))

