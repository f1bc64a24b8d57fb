"""Exact weighted sums of vectors per group: the same bits for any order, partitioning or retry.

A double is cut into digits on a fixed grid of ``WIDTH`` bits per level: a digit is the number rounded to a
multiple of the level's unit, the rest (exact) goes to the levels below. Digits times counts are integers that
doubles add without rounding, as long as a slice's counts stay under ``MOST``; so a matrix product per level sums a
whole slice exactly, in any order. Every task keeps integer digits per group, level and element; Spark adds these
(partial and final aggregates of longs), and the total is rounded once, to the nearest double, as ``math.fsum``
does.

Infinite and NaN elements are counted beside the digits and give what floating-point addition gives.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Python workers get these functions by value, so they need not find the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 24
#: Counts of a slice in all: a digit (under 2**24) times these stays under 2**53.
MOST = 1 << 28
#: Levels whose grid constants are doubles; elements beyond them are cut with whole numbers.
LOW, HIGH = -40, 38
#: Kinds of rows besides levels; ``LAST`` marks a vector's last element.
COUNT, NAN, PLUS, MINUS, LAST = 1000, 1001, 1002, 1003, 1004
PARTS = "cluster int, level int, pos int, digit long"


def cut(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(level, digits) of finite numbers, highest level first; digits are whole and at most 2**(WIDTH - 1) below the first."""
    rest = x
    top = float(np.abs(x).max(initial=0.0))
    while top > 0.0:
        level = (int(np.frexp(top)[1]) - 1) // WIDTH
        unit = 2.0 ** (WIDTH * level)
        far = 1.5 * 2.0**52 * unit
        whole = (rest + far) - far  # the nearest multiple of the unit
        rest = rest - whole
        yield level, whole / unit
        top = float(np.abs(rest).max(initial=0.0))


class Sums:
    """Digits per group and level of one task, as arrays over the vectors' elements."""

    def __init__(self):
        self.digits: dict[int, dict[int, np.ndarray]] = {}
        self.other: dict[tuple[int, int], np.ndarray] = {}  # (group, kind) → how often, per element
        self.n: dict[int, int] = {}
        self.dim = 0

    def add(self, groups: np.ndarray, x: np.ndarray, counts: np.ndarray) -> None:
        """Rows of ``x`` (row per element, column per vector), each counted ``counts`` times in its group."""
        for start, end in _slices(counts):
            self._add(groups[start:end], x[:, start:end], counts[start:end])

    def _add(self, groups: np.ndarray, x: np.ndarray, counts: np.ndarray) -> None:
        self.dim = len(x)
        own, which = np.unique(groups, return_inverse=True)
        for g, n in zip(own.tolist(), np.bincount(which, counts).tolist()):
            self.n[g] = self.n.get(g, 0) + int(n)
        weights = np.zeros((len(groups), len(own)))
        weights[np.arange(len(groups)), which] = counts
        odd = ~np.isfinite(x)
        if odd.any():
            for kind, there in ((NAN, np.isnan(x)), (PLUS, x == np.inf), (MINUS, x == -np.inf)):
                self._count(kind, own, there @ weights)
            x = np.where(odd, 0.0, x)
        size = np.abs(x)
        beyond = (size >= 2.0 ** (WIDTH * HIGH)) | ((size < 2.0 ** (WIDTH * LOW + 60)) & (size > 0))
        if beyond.any():
            for e, r in np.argwhere(beyond).tolist():
                self._whole(int(groups[r]), e, float(x[e, r]), int(counts[r]), len(x))
            x = np.where(beyond, 0.0, x)
        for level, digits in cut(x):
            total = digits @ weights
            for j, g in enumerate(own.tolist()):
                self._level(g, level, len(x))[:] += total[:, j].astype(np.int64)
        self._carry(own.tolist())

    def _level(self, group: int, level: int, dim: int) -> np.ndarray:
        return self.digits.setdefault(group, {}).setdefault(level, np.zeros(dim, np.int64))

    def _count(self, kind: int, own: np.ndarray, found: np.ndarray) -> None:
        for j, g in enumerate(own.tolist()):
            if found[:, j].any():
                held = self.other.setdefault((g, kind), np.zeros(len(found), np.int64))
                held += (found[:, j] > 0).astype(np.int64)

    def _whole(self, group: int, element: int, x: float, n: int, dim: int) -> None:
        a, b = x.as_integer_ratio()
        level = -(-(b.bit_length() - 1) // WIDTH)  # of the last bit, below the point
        value = n * a << (WIDTH * level - (b.bit_length() - 1))
        at = -level
        sign, value = (-1, -value) if value < 0 else (1, value)
        while value:
            self._level(group, at, dim)[element] += sign * (value & (1 << WIDTH) - 1)
            value >>= WIDTH
            at += 1

    def _carry(self, groups: list[int]) -> None:
        """Digits stay within a level's width, so sums over any number of slices and tasks fit a long."""
        half = 1 << (WIDTH - 1)
        for g in groups:
            levels = self.digits.get(g, {})
            level = min(levels, default=0)
            while levels and level <= max(levels):
                d = levels.get(level)
                if d is not None:
                    up = (d + half) >> WIDTH
                    if up.any():
                        d -= up << WIDTH
                        self._level(g, level + 1, len(d))[:] += up
                level += 1

    def rows(self) -> pa.RecordBatch:
        cluster, level, pos, digit = [], [], [], []

        def put(g: int, kind: int, values: np.ndarray) -> None:
            at = np.flatnonzero(values)
            cluster.append(np.full(len(at), g, np.int32))
            level.append(np.full(len(at), kind, np.int32))
            pos.append(at.astype(np.int32))
            digit.append(values[at])

        for g, levels in self.digits.items():
            for k, d in levels.items():
                put(g, k, d)
        for (g, kind), d in self.other.items():
            put(g, kind, d)
        for g, n in self.n.items():
            put(g, COUNT, np.array([n], np.int64))
            if self.dim:
                put(g, LAST, np.arange(self.dim) // max(1, self.dim - 1) if self.dim > 1 else np.ones(1, np.int64))
        if not cluster:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())], ["cluster", "level", "pos", "digit"])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (cluster, level, pos, digit)], ["cluster", "level", "pos", "digit"])


def _slices(counts: np.ndarray, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Runs of rows whose counts stay under ``MOST`` in all."""
    start, total = 0, 0
    for i, n in enumerate(counts.tolist()):
        if i > start and (total + n > MOST or i - start >= rows):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(counts):
        yield start, len(counts)


def rounded(digits: dict[int, int]) -> float:
    """The nearest double (ties to even) of a sum of digits by level."""
    if not digits:
        return 0.0
    low = min(digits)
    value = sum(d << (WIDTH * (k - low)) for k, d in digits.items())
    try:
        return float(value << (WIDTH * low)) if low >= 0 else value / (1 << (-WIDTH * low))
    except OverflowError:
        return float("inf") if value > 0 else float("-inf")


def _totals(entries: pa.Array) -> pa.Array:
    """Arrow lists of (level, pos, digit) of a group → its vector's sum."""
    if isinstance(entries, pa.ChunkedArray):
        entries = entries.combine_chunks()
    return pa.array([_total(rows) for rows in entries.to_pylist()], pa.list_(pa.float64()))


def _total(rows: list[dict]) -> list[float]:
    """A vector's sum from its entries (level, pos, digit)."""
    dim = max((r["pos"] + 1 for r in rows if r["level"] != COUNT), default=0)
    by: list[dict[int, int]] = [{} for _ in range(dim)]
    odd: dict[int, set] = {}
    for r in rows:
        if r["level"] < COUNT:
            by[r["pos"]][r["level"]] = r["digit"]
        elif r["level"] in (NAN, PLUS, MINUS):
            odd.setdefault(r["pos"], set()).add(r["level"])
    total = [rounded(d) for d in by]
    for p, kinds in odd.items():
        total[p] = float("nan") if NAN in kinds or len(kinds) > 1 else float("inf") if PLUS in kinds else float("-inf")
    return total


def partial_digits(points: DataFrame, group: Callable[[pa.RecordBatch, np.ndarray], np.ndarray], features: str, weight_col: str | None) -> DataFrame:
    """``cluster, level, pos, digit``: what each task adds to the sums (see :func:`weighted_sums`)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for b in it:
            if not b.num_rows:
                continue
            f = b.column(b.schema.get_field_index(features))
            x = f.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(b.num_rows, -1).T
            n = np.ones(b.num_rows) if weight_col is None else b.column(b.schema.get_field_index(weight_col)).to_numpy(zero_copy_only=False).astype(np.float64)
            if (n != np.floor(n)).any() or (n < 0).any() or (n > MOST).any():
                _split_counts(sums, group(b, x), x, n)
            else:
                sums.add(group(b, x), x, n)
        yield sums.rows()

    return points.mapInArrow(run, PARTS)


def _added(parts: DataFrame) -> DataFrame:
    # Digits of a level are added as longs: at most 2**24 from a task.
    return parts.groupBy("cluster", "level", "pos").agg(F.sum("digit").alias("digit"))


def sums_on_driver(points: DataFrame, group: Callable[[pa.RecordBatch, np.ndarray], np.ndarray], features: str, weight_col: str | None, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`weighted_sums` for groups 0 to ``k`` - 1 as arrays on the driver: a few digits per group and element come there."""
    n, entries = np.zeros(k), [[] for _ in range(k)]
    for r in _added(partial_digits(points, group, features, weight_col)).collect():
        if r.level == COUNT:
            n[r.cluster] = r.digit
        else:
            entries[r.cluster].append({"level": r.level, "pos": r.pos, "digit": r.digit})
    total = np.zeros((k, dim))
    for j, found in enumerate(entries):
        if found:
            total[j] = _total(found)
    return n, total


def weighted_sums(points: DataFrame, group: Callable[[pa.RecordBatch, np.ndarray], np.ndarray], features: str, weight_col: str | None) -> DataFrame:
    """``cluster, n, total``: per group the count and the exact sum of its vectors.

    ``points`` has the array column ``features`` (equally long, without nulls) and, if named, whole counts in
    ``weight_col``. ``group`` gives the rows' groups from an Arrow batch and its vectors (a row per element).
    """
    added = _added(partial_digits(points, group, features, weight_col))
    entry = F.struct("level", "pos", "digit")
    one = added.groupBy("cluster").agg(F.sum(F.when(F.col("level") == COUNT, F.col("digit"))).alias("n"), F.collect_list(entry).alias("entries"))
    total = F.arrow_udf(_totals, "array<double>")
    return one.select("cluster", F.col("n").cast("double").alias("n"), total("entries").alias("total"))


def _split_counts(sums: Sums, groups: np.ndarray, x: np.ndarray, n: np.ndarray) -> None:
    """Counts of over ``MOST`` are added in parts; counts that aren't whole are refused."""
    if (n != np.floor(n)).any() or (n < 0).any():
        raise ValueError("weights must be counts: whole numbers from 0 on")
    left = n.copy()
    while (left > 0).any():
        part = np.minimum(left, MOST)
        at = np.flatnonzero(part > 0)
        sums.add(groups[at], x[:, at], part[at])
        left -= part
