"""Near-duplicate vectors by quantised tile products.

Unit vectors are quantised to int8 with a scale each; the length of what the quantisation
loses (``err``) is kept. For x and y with quantised forms x', y':
``|x.y - x'.y'| <= err_x + (1 + err_x) * err_y``, so a pair whose quantised product plus that
bound is under the threshold can't reach it. Only the other pairs are computed again from the
original vectors in double precision, which decides.

Before that, distances in a few dimensions tell most pairs of a tile apart: between projections
of two vectors they are never longer than between the vectors.

Equal vectors are one row with a count. They are packed to bytes (in single precision where that
is exact), put into cells by their nearest pivot (pivots: a bounded sample), ordered by cell and
cut into tiles of bounded size. Two tiles whose pivots lie further apart than both tiles' radii and
the threshold's angle can't hold a link, so they never meet. All other pairs of tiles meet in a
product of the table of tiles with itself: each task reads one part of it twice over from the shared folder, so no
vector is shuffled or kept more than once for that, however many tiles there are. A pair of
tiles returns a row per linked vector: how many it is linked to, and the smallest vector that it is
connected to in there; pairs are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .components import components
from .vectors import matrix, tame, usable, usable_rows

TILE = "no long, cell int, dim int, n int, far double, ids binary, copies binary, vectors binary"
#: Dimensions of the projections; vectors of fewer than twice as many are not projected.
FEW = 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values as float32, scale, err) per row; ``err`` bounds the length of unit - scale * values."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    err = np.linalg.norm(unit - scale[:, None] * q, axis=1) * (1 + 1e-9)
    return q.astype(np.int8).astype(np.float32), scale, err


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row connected to each row by pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def projections(ux: np.ndarray, uy: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Single-precision rows whose products are -d*d/2, d the distance of two unit vectors' projections; None if they have too few dimensions.

    The vectors are projected to the directions in which those of one matrix vary most (any would do).
    """
    if ux.shape[1] < 2 * FEW:
        return None
    axes = np.linalg.eigh(ux.T @ ux)[1][:, -FEW:]
    px, py = ux @ axes, uy @ axes
    half = [-(p * p).sum(axis=1, keepdims=True) / 2 for p in (px, py)]
    return np.hstack([px, half[0], np.ones_like(half[0])]).astype(np.float32), np.hstack([py, np.ones_like(half[1]), half[1]]).astype(np.float32)


def pair_blocks(x: np.ndarray, y: np.ndarray | None, threshold: float, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of two matrices with cosine >= threshold, at most ``most`` at once; of one matrix (``y`` None), each i < j once.

    Where the projections leave few pairs, these are computed in full precision. Elsewhere the int8 product and the
    error bounds of its rows and columns tell most pairs for certain, above or below, and only those between are.
    """
    ux = x / np.linalg.norm(x, axis=1)[:, None]
    uy = ux if y is None else y / np.linalg.norm(y, axis=1)[:, None]
    few = projections(ux, uy)
    quantised = None
    p, q = (x, x) if y is None else (x, y)

    def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cos = np.einsum("ij,ij->i", p[a], q[b]) / (np.linalg.norm(p[a], axis=1) * np.linalg.norm(q[b], axis=1))
        return a[cos >= threshold], b[cos >= threshold]

    # float32 sums of int8 products are exact up to 2^24 (dimensions to 1040), else their rounding is in the slack.
    slack = 1e-6 + len(x[0]) * 2.0**-24
    high, wide = 128, len(uy)
    if few is not None:  # the blocks' buffers are used again: new ones would take longer to get than to fill
        products, closes = np.empty((high, wide), np.float32), np.empty((high, wide), bool)
    for i in range(0, len(x), high):
        if few is not None:
            part = few[0][i : i + high]
            product = np.matmul(part, few[1].T, out=products[: len(part)])
            close = np.greater_equal(product, np.float32(threshold - 1 - 1e-5), out=closes[: len(part)])
            if np.count_nonzero(close) <= close.size >> 6:
                rows, cols = np.divmod(np.flatnonzero(close), wide)
                rows += i
                if y is None:
                    rows, cols = rows[rows < cols], cols[rows < cols]
                for k in range(0, len(rows), min(most, 50_000)):
                    a, b = exact(rows[k : k + min(most, 50_000)], cols[k : k + min(most, 50_000)])
                    if len(a):
                        yield a, b
                continue
        if quantised is None:
            quantised = quantise(ux), quantise(uy)
        (qx, sx, ex), (qy, sy, ey) = quantised
        est = (qx[i : i + high] @ qy.T) * (sx[i : i + high, None] * sy[None, :]).astype(np.float32)
        bound = (threshold - slack) - (ex[i : i + high, None] + (1 + ex[i : i + high, None]) * ey[None, :])
        r, c = np.nonzero(est >= bound.astype(np.float32))
        if y is None:
            upper = r + i < c
            r, c = r[upper], c[upper]
        sure = est[r, c] >= threshold + slack + ex[r + i] + (1 + ex[r + i]) * ey[c]
        r += i
        for known, there in ((True, sure), (False, ~sure)):
            rows, cols = r[there], c[there]
            step = most if known else 50_000
            for k in range(0, len(rows), step):
                a, b = rows[k : k + step], cols[k : k + step]
                if not known:
                    a, b = exact(a, b)
                if len(a):
                    yield a, b


def pairs_above(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of :func:`pair_blocks` (in no order)."""
    found = list(pair_blocks(x, y, threshold))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def linked(ids: np.ndarray, copies: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(links, smallest id reached) per row; blocks of pairs are counted and merged as they come, none is kept."""
    links = np.zeros(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")  # labels by rank of id, so that the smallest id wins
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    label = np.arange(len(ids))
    for a, b in blocks:
        links += (np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))).astype(np.int64)
        ra, rb = label[rank[a]], label[rank[b]]
        apart = ra != rb
        if apart.any():
            code = np.unique(np.minimum(ra, rb)[apart] * len(ids) + np.maximum(ra, rb)[apart])
            label = _labels(len(ids), code // len(ids), code % len(ids))[label]
    return links, ids[order][label][rank]


def _packed(rows: DataFrame) -> DataFrame:
    """``rows(vec_id, embedding)`` as ``vec_id, dim, key``: a vector's bytes, the same for equal vectors.

    Single precision where it holds every value exactly, else double (``_vectors`` tells by the length).
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            size = np.diff(b.column(1).offsets.to_numpy())
            for d in np.unique(size).tolist():
                at = pa.array(np.flatnonzero(size == d))
                x = matrix(b.column(1).take(at)) + 0.0  # no negative zeros
                with np.errstate(over="ignore"):
                    narrow = x.astype(np.float32)
                key = [(n if same else v).tobytes() for n, v, same in zip(narrow, x, (narrow == x).all(axis=1).tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([d] * len(key), pa.int32()), pa.array(key, pa.binary())], ["vec_id", "dim", "key"])

    return rows.select("vec_id", "embedding").mapInArrow(run, "vec_id long, dim int, key binary")


def _vectors(data: bytes, n: int, dim: int) -> np.ndarray:
    """Packed vectors in double precision, whichever precision they travelled in."""
    return tame(np.frombuffer(data, np.float32 if len(data) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64))


def _place(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds each packed vector's cell, its nearest pivot, and the angle to it; -1 if it has another length than they."""
    dim = pivots.shape[1]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            keys, dims = b.column(2).to_pylist(), b.column(1).to_numpy()
            cell, angle = np.full(len(keys), -1, np.int32), np.full(len(keys), np.pi)
            wide = np.fromiter(map(len, keys), np.int64, len(keys))
            for w in (4 * dim, 8 * dim):
                at = np.flatnonzero((dims == dim) & (wide == w))
                if len(at):
                    x = _vectors(b"".join(keys[i] for i in at.tolist()), len(at), dim)
                    cos = (x / np.linalg.norm(x, axis=1)[:, None]) @ pivots.T
                    cell[at] = cos.argmax(axis=1)
                    angle[at] = np.arccos(np.clip(cos.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angle)], [*b.schema.names, "cell", "angle"])

    return rows.select("vec_id", "dim", "key", "copies").mapInArrow(run, "vec_id long, dim int, key binary, copies long, cell int, angle double")


def _tiles(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` of :func:`_place` packed into tiles of at most ``most`` vectors (and 4 MB, or one vector) of a cell and length, ``far`` the largest angle."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}  # a tile's vectors are of one precision
        count = TaskContext.get().partitionId() << 32

        def out(key: tuple[int, int, int], block: list) -> pa.RecordBatch:
            nonlocal count
            count += 1
            ids, copies, angles, vectors = zip(*block)
            cols = [[count], [key[0]], [key[1]], [len(ids)], [max(angles)]]
            blobs = [np.array(ids, np.int64).tobytes(), np.array(copies, np.int64).tobytes(), b"".join(vectors)]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)] + [pa.array([x], pa.binary()) for x in blobs],
                ["no", "cell", "dim", "n", "far", "ids", "copies", "vectors"],
            )

        for b in it:
            ids, dims, keys, copies, cells, angles = (c.to_pylist() for c in b.columns)
            for c, d, i, n, angle, v in zip(cells, dims, ids, copies, angles, keys):
                block = held.setdefault((c, d, len(v)), [])
                block.append((i, n, angle, v))
                if len(block) >= min(most, max(1, (4 << 20) // len(v))):
                    yield out((c, d, len(v)), held.pop((c, d, len(v))))
        for key, block in held.items():
            yield out(key, block)

    return rows.mapInArrow(run, TILE)


LINKS = pa.schema([(c, pa.int64()) for c in ("vec_id", "links", "root")])


def _compare(threshold: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                ids, copies = (np.frombuffer(r[c], np.int64) for c in ("ids", "copies"))
                x = _vectors(r["vectors"], r["n"], r["dim"])
                if r["no"] == r["no2"]:
                    blocks = pair_blocks(x, None, threshold)
                else:
                    first = len(ids)
                    blocks = ((a, b + first) for a, b in pair_blocks(x, _vectors(r["vectors2"], r["n2"], r["dim"]), threshold))
                    ids, copies = (np.concatenate([v, np.frombuffer(r[c], np.int64)]) for v, c in ((ids, "ids2"), (copies, "copies2")))
                links, root = linked(ids, copies, blocks)
                hit = links > 0
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(v[hit]) for v in (ids, links, root)], schema=LINKS)

    return run


def _met(tiles: DataFrame, partners: DataFrame) -> DataFrame:
    """Every pair of tiles of near cells (``partners``) and each tile with itself, once: a product of the stored table with itself, without a shuffle."""
    left = tiles.join(F.broadcast(partners), ["cell", "dim"]).withColumn("coin", F.xxhash64("no") % 2)
    right = tiles.select(*[F.col(c).alias(f"{c}2") for c in tiles.columns]).withColumn("coin2", F.xxhash64("no2") % 2)
    # Of the two orders in which a pair comes up one is taken, either one as often, so that tasks have equal shares.
    once = (F.col("no") == F.col("no2")) | ((F.col("no") < F.col("no2")) == (F.col("coin") == F.col("coin2"))) & (F.col("no") != F.col("no2"))
    near = (F.col("dim") == F.col("dim2")) & F.array_contains("others", F.col("cell2"))
    met = left.hint("shuffle_replicate_nl").join(right, near & once)
    return met.select("no", "no2", "dim", "n", "n2", "ids", "ids2", "copies", "copies2", "vectors", "vectors2")


def near_duplicates(
    spark: SparkSession,
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    tile: int = 1024,
    per_group: int = 8,
    max_pivots: int = 256,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, zero, empty or hold null or non-finite components link with
    nothing, and neither do vectors of different lengths. A row without an id takes no part:
    no links, null component, not kept. Repeated rows are linked like any others.
    A tile has ``tile * per_group`` vectors at most. ``df`` is read three times.
    """
    src = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    good = _packed(usable_rows(src, "vec_id", "embedding"))
    distinct = good.groupBy("dim", "key").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    distinct = written(spark, distinct.select("vec_id", "dim", "key", "copies"), "distinct_vectors")
    n = distinct.count()
    ok = F.coalesce(usable("embedding"), F.lit(False))
    rest = src.where(F.col("vec_id").isNull() | ~ok)
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    if not n:
        return alone.withColumn("kept", kept)
    sample = distinct.orderBy(F.xxhash64("vec_id")).limit(min(max_pivots, max(1, n // 8192))).select("dim", "key").collect()
    dim = sample[0].dim
    pivots = np.concatenate([_vectors(bytes(r.key), 1, dim) for r in sample if r.dim == dim])
    pivots = pivots / np.linalg.norm(pivots, axis=1)[:, None]
    placed = _place(distinct, pivots).repartitionByRange("cell", F.xxhash64("vec_id"))
    tiles = written(spark, _tiles(placed, tile * per_group), "tiles")
    radius = {(r.cell, r.dim): r.r for r in tiles.groupBy("cell", "dim").agg(F.max("far").alias("r")).collect()}  # one row per pivot or length
    reach = np.arccos(threshold) + 1e-9 if threshold < 1 else 1e-9

    def near(c: int, o: int, r: float) -> bool:
        return -1 in (c, o) or float(np.arccos(np.clip(pivots[c] @ pivots[o], -1, 1))) <= r + reach

    others = [(c, d, [o for (o, e), s in radius.items() if d == e and near(c, o, r + s)]) for (c, d), r in radius.items()]
    met = _met(tiles, spark.createDataFrame(others, "cell int, dim int, others array<int>"))
    found = written(spark, met.mapInArrow(_compare(threshold), "vec_id long, links long, root long"), "vector_links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    root = components(spark, found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    # Rows find their vector's links by its SHA-256, so that vectors aren't moved again.
    digest = F.unhex(F.sha2("key", 256)).alias("digest")
    of = (
        distinct.select("vec_id", "dim", digest, "copies")
        .join(links, "vec_id", "left")
        .join(root.select(F.col("a").alias("vec_id"), F.col("b").alias("root")), "vec_id", "left")
        .select("dim", "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    )
    linked = good.select("vec_id", "dim", digest).join(of, ["dim", "digest"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", kept)
