"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingstream.session import fresh_path

#: The variable is read when a worker's tokenizer library loads; Spark owns the parallelism.
os.environ["TOKENIZERS_PARALLELISM"] = "false"


#: The folder that holds the library.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    env = spark.sparkContext.environment  # what Python workers get: they must find the library as the driver does
    if HOME not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: cuts the lineage."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unbroadcast(df: DataFrame) -> DataFrame:
    """One side of a join that is made by sorting both sides, none of which is broadcast.

    For rows that a Python step makes many of each: Spark sizes its output by the number of rows that
    go in, and so may take a hundred times what the driver can hold for a small table. Also for words
    read from files, which take several times a file's bytes there.
    """
    return df.hint("merge")


def crc_mod(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def held_out(id_col: str, n: int, r: int) -> Column:
    """True if the id's remainder is ``r``; a null id is never held out."""
    return F.coalesce(crc_mod(id_col, n) == F.lit(r), F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at blanks, tabs and line ends (0x20, 0x09-0x0D); a null text has no words."""
    return text.encode("utf-8").lower().split() if text else []


def texts_of(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def with_columns(batch: pa.RecordBatch, schema: pa.Schema, **cols) -> pa.RecordBatch:
    """The batch's columns named in ``schema`` plus the given new ones, in the schema's order."""
    arrays = []
    for f in schema:
        v = cols[f.name] if f.name in cols else batch.column(batch.schema.get_field_index(f.name))
        arrays.append(v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_KEPT: list = [None, None]


def kept(kind: str, key: object, make):
    """What ``make()`` gave for this kind and key the last time in this worker process, if it was the last asked for.

    Reused workers so keep their word tables, one at a time. The tables hold many small
    objects without cycles, so cycle collection runs seldom.
    """
    gc.set_threshold(1_000_000, 100, 1000)
    if _KEPT[0] != (kind, key):
        _KEPT[:] = [None, None]  # gone before the next one grows
        _KEPT[:] = [(kind, key), make()]
    return _KEPT[1]


def batches(it: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``max_bytes`` each (one row at least)."""
    for b in it:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(column))
        size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
            yield b.slice(start, end - start)
            start = end


class WordTable:
    """Rows of numbers per distinct word, computed once per worker for whole batches of new words.

    ``score(words)`` gives an array with one row per word. At ``limit`` words the table
    starts again, which bounds memory and changes no result.
    """

    def __init__(self, score, width: int, limit: int = 300_000):
        self.score, self.width, self.limit = score, width, limit
        self.place: dict[bytes, int] = {}
        self.rows = np.zeros((1024, width))

    def lookup(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(rows' positions of all words in order, number of words per document)."""
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        new = [w for w in set().union(*docs) if w not in self.place]
        if len(self.place) + len(new) > self.limit:
            self.place.clear()
            new = list(set().union(*docs))
        if new:
            n, m = len(self.place), len(new)
            if n + m > len(self.rows):
                self.rows = np.concatenate([self.rows[:n], np.zeros((max(m, n), self.width))])
            self.rows[n : n + m] = self.score(new)
            self.place.update(zip(new, range(n, n + m)))
        get = self.place.__getitem__
        at = np.fromiter(map(get, chain.from_iterable(docs)), np.int64, int(sizes.sum()))
        return at, sizes

    def sums(self, docs: list[list[bytes]]) -> np.ndarray:
        """Per document the sum of its words' rows (zeros if it has no word)."""
        at, sizes = self.lookup(docs)
        doc = np.repeat(np.arange(len(docs)), sizes)
        return np.stack([np.bincount(doc, self.rows[at, k], len(docs)) for k in range(self.width)], axis=1)


def labelled_sample(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, id_col: str, text: str, folds: int, per_class: int, max_chars: int
) -> list[tuple[str, int]]:
    """A bounded training sample: up to ``per_class`` texts of each label (0 and 1), outside fold 0 of ``folds``.

    Rows are drawn by a hash of the id, so the sample doesn't follow the order of the
    table, and only among labelled rows whose text is there and fits: first the ids (no text is
    moved for that), then their texts. At most ``2 * per_class`` texts of ``max_chars`` characters
    come to the driver; longer and empty texts are not drawn (scoring reads every text whole).
    Of different texts with one id the first in order counts.
    """
    lab = labels.where(crc_mod(id_col, folds) != 0).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    lab = lab.where("y IN (0, 1)").distinct()
    fits = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.length("text").between(1, max_chars))
    able = written(spark, lab.join(fits.select("id"), "id", "left_semi"), "labelled_ids")
    ids = []
    for y in (0, 1):
        ids += able.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(17), "id"), "id").limit(per_class).collect()
    drawn = spark.createDataFrame([(int(r.id), int(r.y)) for r in ids], "id long, y int")
    texts = fits.join(F.broadcast(drawn.select("id").distinct()), "id").groupBy("id").agg(F.min("text").alias("text")).collect()
    found = {r.id: r.text for r in texts}
    return [(found[r.id], r.y) for r in ids]


class PieceTable:
    """Token ids per distinct text piece, computed once per worker; ``encode(pieces)`` gives a list of id lists."""

    def __init__(self, encode, limit: int = 800_000):
        self.encode, self.limit = encode, limit
        self.place: dict = {}
        self.start, self.size, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def _add(self, new: list) -> None:
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            ids = self.encode(part)
            n = len(self.place)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(sizes.sum())
            self.start, self.size = self._room(self.start, n + len(part)), self._room(self.size, n + len(part))
            self.flat = self._room(self.flat, self.used + total)
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
            self.size[n : n + len(part)] = sizes
            self.start[n : n + len(part)] = self.used + np.cumsum(sizes) - sizes
            self.used += total
            self.place.update(zip(part, range(n, n + len(part))))

    def ids(self, docs: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, number of ids per document)."""
        pieces = set().union(*docs)
        new = [w for w in pieces if w not in self.place]
        if len(self.place) + len(new) > self.limit:
            self.place.clear()
            self.used = 0
            new = list(pieces)
        self._add(new)
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(docs)), np.int64, int(n.sum()))
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[at] - (ends - size), size) + np.arange(total)]
        bound = np.concatenate([[0], ends])[np.cumsum(np.concatenate([[0], n]))]
        return ids, np.diff(bound)


def binary_column(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows are consecutive runs (of ``sizes`` elements) of a flat array."""
    width = flat.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * width
    data = pa.py_buffer(np.ascontiguousarray(flat).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())
