"""A stored Katz model of any order: count and backoff tables by context hash, evaluated recursively by joins.

``P(w | c) = disc(n(c, w)) / n(c)`` if the gram was seen in training, else ``alpha(c) * P(w | c')``,
with ``c'`` the context without its first word; the empty context leaves ``unknown`` to one type for
all unknown words. ``alpha(c)`` is what c's discounts leave over the shorter context's mass of the words never
seen after c, so every context sums to one. A context never seen leaves all to the shorter one. Each
text begins after ``order - 1`` end tokens and ends with one.

``fit`` writes, under one folder, ``grams/order=m/part=p`` (context, shorter context, word, count, log10
probability) and ``backoff/order=m/part=p`` (context, log10 alpha). Words and contexts are 64-bit hashes; a
context's lowest three bits are its order. A part is a range of context hashes, and a hot context's
rows are several files of its part. ``load`` opens a stored model, and ``evaluate`` scores texts that ``fit`` never
saw: tokens meet the longest context's grams by a join, those not found take its alpha and go on to the next shorter one.

Counting combines per batch of texts, then by (context, word), so a hot context is spread over all tasks;
sums per context are partial aggregates. In the joins both sides are scans shuffled for the join alone,
which lets AQE split hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingstream.session import fresh_path

from .common import batches, kept, texts_of, words_of, written
from .katz import END, _Hashes, _mix, discounts

#: The largest order: a context's order is kept in three bits.
MAX_ORDER = 7

GRAMS = "c long, shorter long, w long, n long, logp double, part long"
BACKOFF = "c long, alpha double, part long"


@dataclass(frozen=True)
class Model:
    """Where the tables are, the order, and the mass of unknown words (1 without training text)."""

    path: str
    order: int
    unknown: float

    def grams(self, spark: SparkSession, m: int) -> DataFrame:
        return spark.read.schema(GRAMS).parquet(f"{self.path}/grams/order={m}")

    def backoff(self, spark: SparkSession, m: int) -> DataFrame:
        return spark.read.schema(BACKOFF).parquet(f"{self.path}/backoff/order={m}")


def contexts(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """Context hashes of orders 1 to ``order`` for each token of a text (token hashes with its end)."""
    padded = np.concatenate([np.full(order - 1, END, np.uint64), tokens])
    out, c, low = [], np.full(len(tokens), 0x51ED270B, np.uint64), np.uint64(7)
    for m in range(1, order + 1):
        if m > 1:
            at = order - m  # the word m - 1 places before each token
            with np.errstate(over="ignore"):
                c = _mix(c * np.uint64(0xD6E8FEB86659FD93) + padded[at : at + len(tokens)])
        out.append((c & ~low) | np.uint64(m))
    return out


def _tokens(text: str | None, hashes: _Hashes) -> np.ndarray:
    ws = words_of(text)
    return np.fromiter([*map(hashes.__getitem__, ws), END], np.uint64, len(ws) + 1)


def _counted(docs: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """``c, shorter, w, n``: the grams of all orders, with their counts per block of texts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("katz", 0, _Hashes)
        for b in batches(it, "text", block_bytes):
            texts = [_tokens(t, hashes) for t in texts_of(b, "text")]
            cs = [np.concatenate(level) for level in zip(*(contexts(t, order) for t in texts))]
            w = np.concatenate(texts)
            for m, c in enumerate(cs):
                by = np.lexsort((w, c))
                first = np.flatnonzero(np.concatenate([[True], (np.diff(c[by]) != 0) | (np.diff(w[by]) != 0)]))
                at, n = by[first], np.diff(np.append(first, len(by)))
                shorter = cs[m - 1][at] if m else np.zeros(len(at), np.uint64)
                cols = [c[at].view(np.int64), shorter.view(np.int64), w[at].view(np.int64), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["c", "shorter", "w", "n"])

    return docs.mapInArrow(run, "c long, shorter long, w long, n long")


def _discounted(n: Column, d: np.ndarray, tail: float) -> Column:
    low = F.element_at(F.array(*[F.lit(float(x * (i + 1))) for i, x in enumerate(d)]), F.least(n, F.lit(len(d))).cast("int"))
    return F.when(n <= len(d), low).otherwise(n - F.lit(tail))


def _store(df: DataFrame, path: str, parts: int) -> None:
    """By ranges of (part, context, word): a hot context's part is written by several tasks."""
    keys = [c for c in ("part", "c", "w") if c in ("part", *df.columns)]
    df = df.withColumn("part", F.pmod(F.shiftright("c", 3), F.lit(parts)))
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("part").parquet(path)


def fit(
    spark: SparkSession, docs: DataFrame, text: str = "text", order: int = 3, k: int = 5, tail: float = 0.1,
    parts: int = 64, path: str | None = None, block_bytes: int = 8 << 20,
) -> Model:
    """Learn from every row of ``docs`` and store the tables under ``path`` (a new folder; else one in the shared folder).

    Null and empty texts are their end token alone; repeated rows count as often as they come. Without
    rows the tables are empty and every word has the unknown type's probability, one. Discounts are
    Katz's, per order, as in ``katz.discounts``; counts above ``k`` lose ``tail``.
    """
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"order must be 1 to {MAX_ORDER}")
    path = path or fresh_path(spark, "katz_model")
    src = docs.select(F.col(text).cast("string").alias("text"))
    counts = _counted(src, order, block_bytes).groupBy("c", "w").agg(F.sum("n").alias("n"), F.min("shorter").alias("shorter"))
    counts = written(spark, counts.withColumn("m", F.col("c").bitwiseAND(F.lit(7)).cast("int")), "katz_grams")
    # At most order * (k + 2) rows.
    sizes = counts.groupBy("m", F.least("n", F.lit(k + 2)).alias("r")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect()
    unknown = 1.0
    for m in range(1, order + 1):
        of = {int(r.r): r for r in sizes if r.m == m}
        d = discounts(np.array([of[r].types if r in of else 0 for r in range(1, k + 2)]), k)
        grams = counts.where(F.col("m") == m)
        kept_mass = _discounted(F.col("n"), d, tail)
        if m == 1:
            total = sum(r.n for r in of.values())
            lost = sum(of[r].n * (1 - d[r - 1]) for r in of if r <= k) + tail * sum(of[r].types for r in of if r > k)
            unknown = float(lost / total) if total else 1.0
            done = grams.select("c", "shorter", "w", "n", F.log10(kept_mass / F.lit(float(total or 1))).alias("logp"))
            _store(done, f"{path}/grams/order=1", parts)
            continue
        # Every gram's shorter gram was seen too, so its probability is in the table below.
        below = Model(path, order, unknown).grams(spark, m - 1).select(F.col("c").alias("shorter"), "w", F.pow(F.lit(10.0), "logp").alias("p"))
        sums = (
            grams.join(below, ["shorter", "w"])
            .groupBy("c")
            .agg(F.sum("n").alias("total"), F.sum(F.col("n") - kept_mass).alias("lost"), F.sum("p").alias("mass"))
        )
        sums = written(spark, sums, "katz_contexts")
        rest = F.greatest(1 - F.col("mass"), F.lit(1e-300))
        _store(sums.select("c", (F.log10(F.col("lost") / F.col("total")) - F.log10(rest)).alias("alpha")), f"{path}/backoff/order={m}", parts)
        done = grams.join(sums.select("c", "total"), "c").select("c", "shorter", "w", "n", F.log10(kept_mass / F.col("total")).alias("logp"))
        _store(done, f"{path}/grams/order={m}", parts)
    spark.createDataFrame([(order, unknown)], "order int, unknown double").coalesce(1).write.parquet(f"{path}/model")
    return Model(path, order, unknown)


def load(spark: SparkSession, path: str) -> Model:
    r = spark.read.parquet(f"{path}/model").first()
    return Model(path, r.order, r.unknown)


def evaluate(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_tokens, score`` (log10 probability of the whole text with its end), one row per input row.

    Ids are integers or null and may repeat. Null and empty texts are their end token alone. An empty table gives none.
    """
    order = model.order

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, row = kept("katz", 0, _Hashes), TaskContext.get().partitionId() << 33
        for b in batches(it, "text", 1 << 20):
            for i, t in zip(b.column(0).to_pylist(), texts_of(b, "text")):
                w = _tokens(t, hashes)
                cs = contexts(w, order)
                _, first, n = np.unique(np.stack([cs[-1], w]), axis=1, return_index=True, return_counts=True)
                cols = [np.full(len(first), row), n.astype(np.int64), w[first].view(np.int64), *[c[first].view(np.int64) for c in cs]]
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(first), pa.int64()), *[pa.array(c, pa.int64()) for c in cols]], names)
                row += 1

    levels = [f"c{m}" for m in range(1, order + 1)]
    names = ["id", "row", "n", "w", *levels]
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    todo = src.mapInArrow(run, ", ".join(f"{c} long" for c in names)).withColumn("acc", F.lit(0.0))
    found = []
    for m in range(order, 0, -1):
        grams = model.grams(spark, m).select(F.col("c").alias(f"c{m}"), "w", "logp")
        level = written(spark, todo.join(grams, [f"c{m}", "w"], "left"), "katz_level")
        found.append(level.where("logp IS NOT NULL").select("id", "row", "n", (F.col("acc") + F.col("logp")).alias("acc")))
        todo = level.where("logp IS NULL").drop("logp")
        if m > 1:
            alpha = model.backoff(spark, m).select(F.col("c").alias(f"c{m}"), "alpha")
            todo = todo.join(alpha, f"c{m}", "left").withColumn("acc", F.col("acc") + F.coalesce("alpha", F.lit(0.0))).drop("alpha", f"c{m}")
    lost = float(np.log10(model.unknown)) if model.unknown > 0 else float("-inf")
    found.append(todo.select("id", "row", "n", (F.col("acc") + F.lit(lost)).alias("acc")))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    sums = every.groupBy("row", "id").agg(F.sum("n").alias("n_tokens"), F.sum(F.col("n") * F.col("acc")).alias("score"))
    return sums.select(F.col("id").alias(id_col), "n_tokens", "score")
