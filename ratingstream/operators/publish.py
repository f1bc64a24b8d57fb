"""Shaping rating file lines into keyed topic records, and the publish summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import drop_last_field, encode_int_key
from .parse import reject_bad_lines, user_parity_key


def _summary_columns():
    return [
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(F.col("rejected")).alias("n_rejected"),
        F.count_if(~F.col("rejected")).alias("n_published"),
    ]


def publish_ratings(
    lines: DataFrame,
    topic: str,
    partitions: int = 2,
    value_col: str = "value",
    observation: Observation | None = None,
) -> DataFrame:
    """``key BINARY, value STRING, topic STRING, partition INT`` ready for the Kafka sink.

    Lines whose user id does not parse are left out (see :func:`publish_summary`);
    the last field (the timestamp) is dropped; key and partition are the user
    id modulo ``partitions``; the key is written as 4 big-endian bytes. With an
    ``observation``, the read / rejected / published counts are gathered by
    the same pass that writes the records (see :func:`observed_summary`).
    """
    checked = reject_bad_lines(lines, value_col)
    if observation is not None:
        checked = checked.observe(observation, *_summary_columns())
    part = user_parity_key("user_id", partitions)
    return checked.where(~F.col("rejected")).select(
        encode_int_key(part).alias("key"),
        drop_last_field(value_col).alias("value"),
        F.lit(topic).alias("topic"),
        part.alias("partition"),
    )


def publish_summary(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: lines read, rejected, published and the published percentage."""
    checked = reject_bad_lines(lines, value_col)
    agg = checked.agg(*_summary_columns())
    return agg.withColumn(
        "pct_published", F.try_divide(F.col("n_published") * F.lit(100.0), F.col("n_read"))
    )


def publish_progress(steps: DataFrame, n_lines: int, step_col: str = "step") -> DataFrame:
    """How far a wave has come: a row per step with the sums so far, and a last one with what is missing.

    ``steps`` has the observed counts (``n_read, n_rejected, n_published``) of each publishing step; there are as
    many rows as micro-batches. ``pct_published`` and ``n_missing`` are of the wave's ``n_lines``. ``kind``: ``progress``
    per step, then ``sent`` if nothing is missing or else ``shortfall`` (its ``step`` is null).
    """
    so_far = Window.orderBy(step_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = ("n_read", "n_rejected", "n_published")
    rows = steps.select(F.col(step_col).cast("long").alias("step"), *[F.sum(c).over(so_far).alias(c) for c in counts])
    last = steps.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    missing = F.lit(int(n_lines)) - F.col("n_published")
    end = F.when(missing > 0, "shortfall").otherwise("sent")
    both = rows.withColumn("kind", F.lit("progress")).unionByName(last.select(F.lit(None).cast("long").alias("step"), *counts, end.alias("kind")))
    return both.withColumn("pct_published", F.try_divide(F.col("n_published") * F.lit(100.0), F.lit(int(n_lines)))).withColumn("n_missing", missing)


def observed_summary(observation: Observation) -> dict:
    """The publish summary from an observation, once the writing action has run."""
    m = dict(observation.get)
    m["pct_published"] = 100.0 * m["n_published"] / m["n_read"] if m.get("n_read") else None
    return m
