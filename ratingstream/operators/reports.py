"""Per-batch reports: model centres as text, sampled predictions, offset ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import format_vector


def model_report(state: DataFrame) -> DataFrame:
    """One text line per centre (elements joined by commas), ordered by cluster, dated."""
    return state.select(
        F.current_timestamp().alias("reported_at"), "cluster", format_vector("center").alias("line")
    ).orderBy("cluster")


def prediction_report(
    preds: DataFrame,
    cluster_col: str = "cluster",
    order_col: str | None = None,
    span: int = 1_000_000,
    group_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Sampled predictions joined by commas, a line for every ``span`` values of ``order_col``.

    A line holds the predictions whose ``order_col`` (an offset, say) lies in its range, in
    that order; ``line_no`` is the range's number, so lines sort like the messages whatever
    their number, and a line has ``span`` entries at most. ``group_cols`` (the topic partition)
    number their messages on their own. Without ``order_col`` the entries are spread over
    64 lines by a hash of the row and have no order.
    """
    if order_col:
        line_no = F.floor(F.col(order_col) / F.lit(span)).cast("long")
        entry = F.struct(F.col(order_col).alias("k"), F.col(cluster_col).alias("c"))
    else:
        line_no = F.pmod(F.xxhash64(*[F.col(c) for c in preds.columns]), F.lit(64)).cast("long")
        entry = F.struct(F.col(cluster_col).alias("c"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["c"].cast("string")), ",")
    return preds.groupBy(*group_cols, line_no.alias("line_no")).agg(
        F.count(F.lit(1)).alias("n"), line.alias("line")
    ).withColumn("reported_at", F.current_timestamp())


def offset_ranges(records: DataFrame) -> DataFrame:
    """Per topic partition: first offset, one past the last offset, and record count.

    Given parsed records (a ``reject_reason`` column), also the number of
    records set aside, so the table doubles as the batch's intake log.
    """
    keys = [c for c in ("topic", "partition") if c in records.columns]
    aggs = [
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"),
    ]
    if "reject_reason" in records.columns:
        aggs.append(F.count("reject_reason").alias("n_rejected"))
    return records.groupBy(*keys).agg(*aggs)
