"""Nearest neighbours by shifted space-filling curves.

Nearness is the inner product, which orders by direction only among rows of like norm. Rows are therefore put
into shells by norm (each ``SHELL`` times the next; the last of ``SHELLS`` holds all shorter ones), and
every shell is ordered on its own. Each of several curves projects the rows' directions to a few dimensions (a
random rotation, of its own, of the principal components of a bounded sample), shifts and quantises them to a grid, and
orders the rows of a shell by their place on the Hilbert curve through that grid. Rows are
range-partitioned by that place and numbered. A query has a place in every shell; its candidates there are
the rows up to the shell's window before and after it. The candidates of all curves and shells are merged and
ranked by the measure itself, in double precision on the original vectors.

The windows are found rather than given: for a bounded sample of queries the true nearest rows are computed over
the whole table, and windows are those of least total length within which the wanted share of them lies
(``recall``); none is shorter than ``k``. Vectors without structure in few dimensions need windows that are a fixed
share of the table; clustered ones, and ones of very different norms, need far less.

Rows are numbered in bounded slices. A slice of rows meets a bounded batch of the queries whose windows
reach it in one task, which returns each query's best there. Vectors travel in the type that they are stored in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import matrix, usable_rows


def hilbert_index(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid points (rows; unsigned integers under 2**bits), as int64.

    The coordinates are turned to the curve's transposed form (undoing excess rotations bit by
    bit, then Gray-coding) and their bits interleaved.
    """
    x = [grid[:, i].astype(np.int64).copy() for i in range(grid.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(len(grid), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros(len(grid), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ t) >> b) & 1)
    return out


#: Ratio of a shell's norms, and how many shells there are at most.
SHELL, SHELLS = 1.5, 12


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, shell numbers counted from norm 1) of non-zero rows; no square over- or underflows."""
    top = np.abs(x).max(axis=1)
    y = x / top[:, None]
    length = np.linalg.norm(y, axis=1)
    return y / length[:, None], np.floor((np.log(top) + np.log(length)) / np.log(SHELL) + 1e-6).astype(np.int64)


class Curves:
    """The curves' projections and shifts, from a sample of unit vectors."""

    def __init__(self, count: int, sample: np.ndarray, low: int, bits: int, principal: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        _, _, axes = np.linalg.svd(sample - self.mean, full_matrices=False)
        axes = axes[: max(1, principal)]
        low = min(low, len(axes))
        self.bits = bits
        self.bases = [axes.T @ np.linalg.qr(rng.standard_normal((len(axes), len(axes))))[0][:, :low] for _ in range(count)]
        self.shifts = [rng.uniform(0, 0.5, low) for _ in range(count)]
        self.spread = float(np.std((sample - self.mean) @ self.bases[0])) or 1.0

    def places(self, unit: np.ndarray, curve: int) -> np.ndarray:
        y = ((unit - self.mean) @ self.bases[curve]) / (6 * self.spread) + 0.25 + self.shifts[curve]
        grid = np.clip(np.floor(y * (1 << self.bits)), 0, (1 << self.bits) - 1).astype(np.int64)
        return hilbert_index(grid, self.bits)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, each summed in the same order whatever rows are beside it: equal vectors tie exactly."""
    return np.multiply(q, x).sum(axis=1)


def best(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """Per query its k best rows: (query number, row number, score); ties to the smaller id. ``own``: the queries' ids."""
    out_q, out_r, out_s = [], [], []
    for i in range(0, len(q), 128):
        s = q[i : i + 128] @ x.T
        s[own[i : i + 128, None] == ids[None, :]] = -np.inf
        if allowed is not None:
            s[~allowed[i : i + 128]] = -np.inf
        # All rows that may be among the best once summed exactly.
        least = np.partition(s, max(0, s.shape[1] - k), axis=1)[:, max(0, s.shape[1] - k)]
        r, c = np.nonzero((s >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & np.isfinite(s))
        e = np.empty(len(r))
        for j in range(0, len(r), 20_000):
            e[j : j + 20_000] = exact_scores(q[i + r[j : j + 20_000]], x[c[j : j + 20_000]])
        order = np.lexsort((ids[c], -e, r))
        r, c, e = r[order], c[order], e[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        top = rank < k
        out_q.append(r[top] + i)
        out_r.append(c[top])
        out_s.append(e[top])
    cat = lambda v, t: np.concatenate(v) if v else np.zeros(0, t)
    return cat(out_q, np.int64), cat(out_r, np.int64), cat(out_s, np.float64)


def _shells(rows: DataFrame) -> dict[int, int]:
    """Rows per shell (a few numbers: the logarithm of a double's range bounds them)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            shell, n = np.unique(directions(matrix(b.column(1)))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shell), pa.array(n.astype(np.int64))], ["shell", "n"])

    return {r.shell: r.n for r in rows.mapInArrow(run, "shell long, n long").groupBy("shell").agg(F.sum("n").alias("n")).collect()}


def _numbered(spark: SparkSession, rows: DataFrame, curves: Curves, count: int, shells: list[int], every: int, parts: int) -> DataFrame:
    """``line, asked, pos, num, vec_id, embedding``: a line is one shell on one curve.

    A row has its number ``pos`` (and ``num``) on its shell's lines. A query stands on the lines of all shells besides
    (``asked``): ``pos`` counts the rows before it, ``num`` the queries.
    """
    shared = spark.sparkContext.broadcast(curves)
    known = np.array(sorted(shells))
    vector = rows.schema["embedding"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            unit, shell = directions(matrix(b.column(1)))
            own = np.searchsorted(known, np.maximum(shell, known[0]))
            queries = np.flatnonzero(b.column(0).to_numpy() % every == 0)
            asking = b.take(pa.array(queries))
            for c in range(count):
                place = shared.value.places(unit, c)
                sides = [(b, c * len(known) + own, False, place)]
                sides += [(asking, np.full(len(queries), c * len(known) + s), True, place[queries]) for s in range(len(known))]
                for side, line, asked, at in sides:
                    cols = [pa.array(line.astype(np.int32)), pa.array(np.full(len(at), asked)), pa.array(at)]
                    yield pa.RecordBatch.from_arrays([*side.columns, *cols], ["vec_id", "embedding", "line", "asked", "place"])

    placed = rows.mapInArrow(run, f"vec_id long, embedding {vector}, line int, asked boolean, place long")
    # The id settles ties, so rows of one place spread over partitions too.
    order = ["line", "place", "vec_id", "asked"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    lines = count * len(known)

    def number(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, asked_before = TaskContext.get().partitionId(), np.zeros(lines, np.int64), np.zeros(lines, np.int64)
        for b in it:
            line, asked = b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
            pos, num = np.empty(len(line), np.int64), np.empty(len(line), np.int64)
            for c in np.unique(line):
                m = np.flatnonzero(line == c)
                q = asked[m]
                pos[m] = seen[c] + np.cumsum(~q) - ~q
                num[m] = np.where(q, asked_before[c] + np.cumsum(q) - q, pos[m])
                seen[c] += int((~q).sum())
                asked_before[c] += int(q.sum())
            part_of = pa.array(np.full(len(line), part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], part_of, pa.array(pos), pa.array(num)], ["vec_id", "embedding", "line", "asked", "part", "pos", "num"]
            )

    local = ordered.mapInArrow(number, f"vec_id long, embedding {vector}, line int, asked boolean, part int, pos long, num long")
    local = written(spark, local, "curve_rows")
    # A row per partition and line comes to the driver: the rows and queries before each.
    sizes = local.groupBy("line", "part").agg(F.count_if(~F.col("asked")).alias("n"), F.count_if("asked").alias("q")).collect()
    starts, rows_before, queries_before, last = [], 0, 0, None
    for r in sorted(sizes, key=lambda r: (r.line, r.part)):
        if r.line != last:
            rows_before = queries_before = 0
        starts.append((r.line, r.part, rows_before, queries_before))
        rows_before, queries_before, last = rows_before + r.n, queries_before + r.q, r.line
    first = spark.createDataFrame(starts, "line int, part int, first long, first_asked long")
    num = F.col("num") + F.when(F.col("asked"), F.col("first_asked")).otherwise(F.col("first"))
    return local.join(F.broadcast(first), ["line", "part"]).select(
        "line", "asked", (F.col("first") + F.col("pos")).alias("pos"), num.alias("num"), "vec_id", "embedding"
    )


def away(row: Column, query: Column) -> Column:
    """How far a window must reach from the query to hold the row: 0 for the two rows beside it."""
    return F.greatest(row - query, query - 1 - row)


def choose_windows(gaps: np.ndarray, shell: np.ndarray, sizes: list[int], recall: float, least: int) -> list[int]:
    """A window per shell (at least ``least``) so that ``recall`` of the gaps lie within, of about the least total length.

    For a price per row of a window every shell takes the window that finds most beside its price; the
    highest price at which enough are found is told by halving.
    """
    by_shell = [np.sort(gaps[shell == s]) for s in range(len(sizes))]

    def at(price: float) -> tuple[int, list[int]]:
        found, windows = 0, []
        for g, n in zip(by_shell, sizes):
            worth = np.arange(1, len(g) + 1) - price * np.minimum(2.0 * (g + 1), n)
            best_ = int(worth.argmax()) if len(g) else -1
            w = int(g[best_]) if len(g) and worth[best_] > 0 else 0
            w = max(w, least)
            found += int((g <= w).sum())
            windows.append(w)
        return found, windows

    low, high = 0.0, 1.0 * max(1, len(gaps))
    for _ in range(60):
        price = (low + high) / 2
        low, high = (price, high) if at(price)[0] >= recall * len(gaps) else (low, price)
    return at(low)[1]


def _truth(spark: SparkSession, rows: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The true nearest rows of a few queries (bounded: they are broadcast): (query id, vec_id)."""
    shared = spark.sparkContext.broadcast((ids, q))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, qs = shared.value
        for b in it:
            x, v = matrix(b.column(1)), b.column(0).to_numpy()
            a, r, s = best(qs, own, x, v, k)
            yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(v[r]), pa.array(s)], ["query_id", "vec_id", "score"])

    found = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return [(r.query_id, r.vec_id) for r in found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).collect()]


def nearest(
    spark: SparkSession,
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    every: int = 20,
    curves: int = 6,
    low: int = 8,
    bits: int = 7,
    recall: float = 0.97,
    sample: int = 128,
    fit_rows: int = 4096,
    slice_rows: int = 8192,
    batch_rows: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``.

    Nearness is the largest inner product; equal scores go to the smaller id. A row isn't its
    own neighbour; rows that repeat its id aren't either. Vectors that are null, zero, empty or hold null or
    non-finite components take no part, nor do rows without an id; vectors of another length than
    the most common one (the longer of equally common) take no part either. With ``k`` or fewer
    candidates all are returned. Repeated rows are returned once per id. The projections are fitted on
    ``fit_rows`` rows at most, the windows on ``sample`` queries; every row is placed and numbered.
    """
    good = written(spark, usable_rows(df, id_col, vector), "ann_rows")
    dims = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], result)
    dim, n = dims[0]["d"], dims[0]["count"]
    rows = good.where(F.size("embedding") == dim)

    def drawn(of: DataFrame, seed: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        got = of.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(most).collect()
        return np.array([r.vec_id for r in got], np.int64), np.array([r.embedding for r in got], np.float64).reshape(len(got), dim)

    ids, q = drawn(rows.where(F.col("vec_id") % every == 0), 3, sample)
    if not len(ids):
        return spark.createDataFrame([], result)
    shape = Curves(curves, directions(drawn(rows, 5, fit_rows)[1])[0], low, bits)
    count = _shells(rows)
    shells = [s for s in sorted(count) if s > max(count) - SHELLS]
    sizes = [sum(c for s, c in count.items() if s <= shells[0])] + [count[s] for s in shells[1:]]
    numbered = _numbered(spark, rows, shape, curves, shells, every, max(1, -(-n * curves // 50_000)))
    numbered = written(spark, numbered, "curve_order")

    # The windows: how far from the sample's queries their true nearest rows lie, on the nearest curve.
    truth = spark.createDataFrame(_truth(spark, rows, ids, q, k) or [(0, 0)], "query_id long, vec_id long").distinct()
    pos = numbered.select("line", "asked", "pos", "vec_id")
    wanted = truth.select(F.col("query_id").alias("vec_id")).distinct()
    own = pos.where("asked").join(F.broadcast(wanted), "vec_id").groupBy("line", F.col("vec_id").alias("query_id")).agg(F.min("pos").alias("own"))
    gap = (
        pos.where(~F.col("asked"))
        .join(F.broadcast(truth), "vec_id")
        .join(F.broadcast(own), ["line", "query_id"])
        .groupBy("query_id", "vec_id", (F.col("line") % len(shells)).alias("shell"))
        .agg(F.min(away(F.col("pos"), F.col("own"))).alias("gap"))
    ).collect()  # at most sample * k numbers
    windows = choose_windows(np.array([r.gap for r in gap], np.int64), np.array([r.shell for r in gap], np.int64), sizes, recall, k)
    reach = spark.createDataFrame(
        [(c * len(shells) + s, windows[s], sizes[s]) for c in range(curves) for s in range(len(shells))], "line int, window long, n long"
    )

    # Slices of rows meet the queries whose windows reach them, which come in batches.
    near = F.sequence(
        F.floor(F.greatest(F.col("pos") - 1 - F.col("window"), F.lit(0)) / slice_rows),
        F.floor(F.least(F.col("pos") + F.col("window"), F.col("n") - 1) / slice_rows),
    )
    asked = numbered.where("asked").join(F.broadcast(reach), "line")
    sides = asked.select("line", F.explode(near).alias("slice"), F.floor(F.col("num") / batch_rows).alias("batch"), "pos", "window", "vec_id", "embedding")
    batches_of = sides.select("line", "slice", "batch").distinct()  # few rows: a slice's query batches
    data = numbered.where(~F.col("asked")).withColumn("slice", F.floor(F.col("pos") / slice_rows)).join(batches_of, ["line", "slice"])
    # Both sides come from one table: the columns of one get names of their own.
    data = data.select(*[F.col(c).alias(f"r_{c}") for c in ("line", "slice", "batch", "pos", "vec_id", "embedding")])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(left) or not len(right):
            return empty
        qs, x = matrix(left["embedding"]), matrix(right["r_embedding"])
        own_ids, v = left["vec_id"].to_numpy(), right["r_vec_id"].to_numpy()
        qp, xp, window = left["pos"].to_numpy(), right["r_pos"].to_numpy(), left["window"][0].as_py()
        gap = xp[None, :] - qp[:, None]
        a, r, s = best(qs, own_ids, x, v, k, (gap <= window) & (gap >= -1 - window))
        return pa.table({"query_id": own_ids[a], "vec_id": v[r], "score": s})

    key = ["line", "slice", "batch"]
    found = sides.groupBy(*key).cogroup(data.groupBy(*[f"r_{c}" for c in key])).applyInArrow(search, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
