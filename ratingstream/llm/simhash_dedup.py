"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A text's fingerprint has a bit set if more than half of its shingles' 64-bit hashes have
it. Fingerprints at ``max_bits`` (0 to 2) or fewer differing bits are linked; a document's
class is the set reachable by links.

Search. The 64 bits are cut into three segments of 22, 21 and 21 bits. With two wrong bits
in all, some two segments hold one wrong bit at most between them (leave out the segment
with the most). A segment is decoded with the perfect binary Golay code (23, 12, 7): the
index of its nearest codeword (distance <= 3, unique) is its *index key*; the indices of all
codewords within distance 4 are its *probe keys*. If two segments differ in one bit, the
probe keys of each hold the index key of the other. So each fingerprint is stored under one
cell per pair of segments (nearest codewords) and looks up the cells that one wrong bit in
either segment can lead to; the join's candidates are verified by counting differing bits.

Skew. Equal fingerprints are one row (the members keep the class of the row). A cell with
more than ``hot_cell`` different fingerprints (a group of near copies) isn't joined. Its
stored fingerprints and those that look it up go the exact linear way: each puts itself and
its 64 one-bit neighbours down as meeting points, and those that meet at a point are linked
to the smallest there. Two fingerprints that meet differ in two bits at most, and all that
differ in two bits at most meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, texts_of, unbroadcast, with_columns, words_of, written
from .components import components

#: Fixed value: a generator polynomial of the binary Golay code (23, 12, 7).
GOLAY_POLYNOMIAL = 0b101011100011

#: The segments: (first bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text; 0 if it has no word."""
    w = words_of(text)
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    h64 = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = np.array([h64(b" ".join(w[i : i + shingle]), seed) for i in range(k, min(n, k + (1 << 16)))], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` without ``text``, plus the fingerprint as a signed long in ``out``.

    Null, empty and blank texts get 0. A column of the input named like ``out`` is replaced.
    """
    keep = [c for c in docs.columns if c not in (text, out)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("\x01text"))
    schema = src.drop("\x01text").withColumn(out, F.lit(0).cast("long")).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "\x01text", 4 << 20):
            fp = np.array([fingerprint(t, shingle, seed) for t in texts_of(b, "\x01text")], np.uint64).view(np.int64)
            arrow = pa.schema([b.schema.field(c) for c in keep] + [pa.field(out, pa.int64())])
            yield with_columns(b, arrow, **{out: pa.array(fp)})

    return src.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a 23-bit word: its nearest codeword's index, and by syndrome the flips to codewords within distance 4.

    Returns (syndrome of each 23-bit word's value by bit, flips by syndrome padded with -1, index by message).
    A word w has the probe codewords ``w ^ flip``; a codeword's index is its top 12 bits (the code is systematic).
    """
    unit = np.zeros(23, np.int64)
    for i in range(23):  # x^i mod g
        r = 1 << i
        for k in range(i, 10, -1):
            if r >> k & 1:
                r ^= GOLAY_POLYNOMIAL << (k - 11)
        unit[i] = r
    lists: list[list[int]] = [[] for _ in range(2048)]
    near = np.zeros(2048, np.int64)
    from itertools import combinations

    for weight in range(5):
        for c in combinations(range(23), weight):
            s = f = 0
            for i in c:
                s ^= int(unit[i])
                f |= 1 << i
            if weight <= 3:
                near[s] = f
                lists[s].append(f)
            elif near[s].bit_count() == 3:  # nearer codewords can't be missed by one more wrong bit
                lists[s].append(f)
    width = max(map(len, lists))
    flips = np.full((2048, width), -1, np.int64)
    for s, v in enumerate(lists):
        flips[s, : len(v)] = v
    return unit, near, flips


def _syndrome(w: np.ndarray, unit: np.ndarray) -> np.ndarray:
    s = np.zeros(len(w), np.int64)
    for i in range(23):
        s ^= np.where(w >> i & 1, unit[i], 0)
    return s


def golay_keys(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: the index of the nearest codeword, and a matrix of probe indices (-1: none; column 0 is the nearest)."""
    unit, near, flips = golay_tables()
    w = w.astype(np.int64)
    s = _syndrome(w, unit)
    f = flips[s]
    return (w ^ near[s]) >> 11, np.where(f < 0, -1, (w[:, None] ^ f) >> 11)


def cells(fp: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row number, cell) of the cells that each fingerprint is stored under, or looks up if ``probe``."""
    u = fp.view(np.uint64)
    index, probes = [], []
    for first, bits in SEGMENTS:
        seg = (u >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        i, p = golay_keys(seg.view(np.int64))
        index.append(i)
        probes.append(p)
    rows, keys = [], []
    n = np.arange(len(fp))
    for k, (a, b) in enumerate(PAIRS):
        base = k << 24
        if not probe:
            rows.append(n)
            keys.append(base | index[a] << 12 | index[b])
            continue
        for x, other, shift_x, shift_o in ((a, b, 12, 0), (b, a, 0, 12)):
            p = probes[x] if x == a else probes[x][:, 1:]  # the nearest pair once
            r, c = np.nonzero(p >= 0)
            rows.append(r)
            keys.append(base | p[r, c] << shift_x | index[other][r] << shift_o)
    return np.concatenate(rows), np.concatenate(keys)


def _cells_of(fps: DataFrame, probe: bool) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(0, b.num_rows, 4096):
                fp = b.column(0).slice(i, 4096).to_numpy().copy()
                r, k = cells(fp, probe)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp[r])], ["cell", "fp"])

    return fps.select("fp").mapInArrow(run, "cell long, fp long")


def _meeting_points(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints at ``max_bits`` or fewer bits, by meeting at a common one-bit neighbour (see above)."""
    flips = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))]).astype(np.uint64).view(np.int64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(0, b.num_rows, 4096):
                fp = b.column(0).slice(i, 4096).to_numpy()
                at = (fp[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.repeat(fp, 65))], ["at", "fp"])

    if max_bits == 1:
        # One wrong bit: a one-bit neighbour that is itself a fingerprint.
        met = fps.mapInArrow(run, "at long, fp long")
        return unbroadcast(met).join(fps.select(F.col("fp").alias("at")), "at").select(F.col("fp").alias("a"), F.col("at").alias("b"))
    met = fps.mapInArrow(run, "at long, fp long")
    first = met.groupBy("at").agg(F.min("fp").alias("b"), F.max("fp").alias("m")).where("b < m").drop("m")
    return unbroadcast(met).join(first, "at").where("fp <> b").select(F.col("fp").alias("a"), "b")


def fingerprint_links(spark: SparkSession, fps: DataFrame, max_bits: int = 2, hot_cell: int = 64) -> DataFrame:
    """``fps(fp)``, distinct → ``links(a, b)`` that connect all fingerprints at ``max_bits`` or fewer bits.

    Members of a hot cell are linked to the smallest at each meeting point rather than to each other.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2: the segments allow two wrong bits")
    if max_bits == 0:
        return spark.createDataFrame([], "a long, b long")
    store = written(spark, _cells_of(fps, probe=False), "cells")
    hot = written(spark, store.groupBy("cell").count().where(F.col("count") > hot_cell).select("cell"), "hot_cells")
    look = _cells_of(fps, probe=True)
    s, p = store.alias("s"), look.alias("p")
    cold = store.join(hot, "cell", "left_anti").withColumnRenamed("fp", "b")
    pairs = unbroadcast(look.withColumnRenamed("fp", "a")).join(cold, "cell").where("a <> b")
    found = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    del s, p
    warm = look.join(hot, "cell", "left_semi").select("fp").distinct()
    return found.unionByName(_meeting_points(warm, max_bits))


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    hot_cell: int = 64,
) -> DataFrame:
    """One row per input row: ``id_col, fingerprint (16 hex digits), component_id``.

    ``component_id`` is the smallest id reachable by links of ``max_bits`` or fewer bits.
    Repeated rows stay repeated. A null id takes part in links but is never smallest; a
    component of null ids only has a null ``component_id``. Null, empty and blank texts have
    fingerprint zero, which is linked like any other. An empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    fp = written(spark, fingerprints(src, "text", "fp", shingle), "fingerprints")
    least = written(spark, fp.groupBy("fp").agg(F.min("id").alias("least")), "distinct_fingerprints")
    links = fingerprint_links(spark, least.select("fp"), max_bits, hot_cell)
    root = components(spark, links).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    by_fp = least.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    by_root = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    # Only fingerprints in a component of several need their root's id; a hot root (a large class) is one row per fingerprint.
    classes = by_fp.join(by_root, "root").select("fp", "component_id")
    return fp.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
