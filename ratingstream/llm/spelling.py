"""Spelling variants found through reduced alphabets.

Letters are hashed to a few symbols, which turns each word of the vocabulary into a reduced word. If two
words are one edit apart, so are their reduced words, or they are equal. Each word therefore generates the
full one-edit neighbourhood of its reduced word (deletions, replacements, insertions and the reduced word
itself) and looks these up among the reduced vocabulary; what it finds is verified on the original strings.
A looked-up length has an alphabet of its own, with just so many symbols that reduced words of that length
outnumber the vocabulary's words of it, so a reduced word stands for few words at every size.

Reduced words are 64-bit hashes (equal ones only add candidates), computed for whole batches in numpy. The
pairs carry numbers, not strings, and a mask with the parity of each letter's count: one edit changes two bits
at most, which drops nearly all false candidates inside the join.

Skew. A reduced word that stands for more than ``hot`` words isn't joined. Those words, and the words that look
it up, meet again under the full alphabet, where a reduced word is the word itself: a word then generates some
90 neighbours per position, however large the group, and no pairs within it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, texts_of, unbroadcast, written

#: In Latin-1 a code point is a byte: A-Z lower-cased, a-z and U+00C0 to U+00FF stay, all else parts runs.
RUNS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Numbers of the letters: a-z, then U+00C0 to U+00FF.
LETTERS = np.zeros(256, np.int64)
LETTERS[97:123] = np.arange(26)
LETTERS[0xC0:] = np.arange(26, 90)
FULL = 90
SIZES = (3, 4, 6, 8, 12, 16, 24, 32, 48, FULL)
#: Reduced words per word of a length, at least; and from which length on the fewest symbols are enough for any vocabulary.
ROOM, LONG = 16, 32
BASE = np.uint64(0x9E3779B97F4A7C15)


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters, a byte per code point."""
    return text.encode("latin-1", "replace").translate(RUNS).split() if text else []


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 5, every: int = 97) -> DataFrame:
    """``word, n``, not yet summed: words of ``least`` or more letters with how often they occur in a slice of documents.

    With h = crc32 of ``<id>:<run>``, a run whose h is divisible by ``every`` loses its letter number h % length.
    """
    src = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc32 = zlib.crc32
        for b in batches(it, "text", 4 << 20):
            total: Counter = Counter()
            for name, t in zip(texts_of(b, "id"), texts_of(b, "text")):
                own = Counter([w for w in runs(t) if len(w) >= least])
                prefix = crc32(f"{name}:".encode())
                for w in list(own):
                    h = crc32(w if w.isascii() else w.decode("latin-1").encode(), prefix)
                    if h % every == 0:
                        n, k = own.pop(w), h % len(w)
                        if len(w) > least:
                            total[w[:k] + w[k + 1 :]] += n
                total.update(own)
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

    return src.mapInArrow(run, "word string, n long")


def symbols(size: int) -> np.ndarray:
    """The symbol (from 1) of each letter in an alphabet of ``size`` symbols; with ``FULL``, one of its own."""
    if size >= FULL:
        return np.arange(1, FULL + 1, dtype=np.uint64)
    return np.array([xxhash.xxh32_intdigest(bytes([i]), 7) % size + 1 for i in range(FULL)], np.uint64)


def alphabets(counts: dict[int, int]) -> dict[int, int]:
    """Alphabet size per word length (up to ``LONG``) from the number of words of each length."""
    return {m: next((s for s in SIZES if s**m >= ROOM * counts.get(m, 0)), FULL) for m in range(LONG + 1)}


class Reducer:
    """Hashes of reduced words and of their neighbourhoods, for words of one length at a time."""

    def __init__(self, sizes: dict[int, int]):
        self.sizes = sizes
        self.tables = {s: symbols(s) for s in SIZES}

    def size(self, length: int) -> int:
        return self.sizes.get(length, SIZES[0])

    def reduced(self, codes: np.ndarray, length: int) -> np.ndarray:
        """Symbols of a matrix of letters under the alphabet of words of ``length``."""
        return self.tables[self.size(length)][codes]

    def key(self, codes: np.ndarray) -> np.ndarray:
        """The words' own reduced hashes."""
        m = codes.shape[1]
        return _sealed((self.reduced(codes, m) * _powers(m)).sum(1, dtype=np.uint64), m)

    def neighbours(self, codes: np.ndarray, block: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, hash) of every different reduced word within one edit, in parts."""
        n, m = codes.shape
        p = _powers(m + 1)
        zero = np.zeros((n, 1), np.uint64)
        # The same length: the reduced word itself, and every other symbol at every position.
        x = self.reduced(codes, m)
        whole = (x * p[:m]).sum(1, dtype=np.uint64)
        yield np.arange(n), _sealed(whole, m)
        step = max(1, block // n)
        for c in range(1, self.size(m) + 1):
            for i in range(0, m, step):
                part = x[:, i : i + step]
                row, col = np.nonzero(part != c)
                yield row, _sealed(whole[row] + (np.uint64(c) - part[row, col]) * p[i + col], m)
        # One letter less: of equal neighbouring symbols one is left out.
        if m > 1:
            y = self.reduced(codes, m - 1)
            before = np.concatenate([zero, np.cumsum(y * p[:m], axis=1, dtype=np.uint64)], axis=1)
            shifted = np.concatenate([zero, np.cumsum(y[:, 1:] * p[: m - 1], axis=1, dtype=np.uint64)], axis=1)  # each symbol one place down
            new = np.concatenate([np.ones((n, 1), bool), y[:, 1:] != y[:, :-1]], axis=1)
            for i in range(0, m, step):
                row, col = np.nonzero(new[:, i : i + step])
                col += i
                yield row, _sealed(before[row, col] + shifted[row, -1] - shifted[row, col], m - 1)
        # One letter more: a symbol goes before another one, or to the end.
        z = self.reduced(codes, m + 1)
        before = np.concatenate([zero, np.cumsum(z * p[:m], axis=1, dtype=np.uint64)], axis=1)
        after = np.concatenate([zero, np.cumsum(z * p[1 : m + 1], axis=1, dtype=np.uint64)], axis=1)  # each symbol one place up
        for c in range(1, self.size(m + 1) + 1):
            for i in range(0, m, step):
                row, col = np.nonzero(z[:, i : i + step] != c)
                col += i
                yield row, _sealed(before[row, col] + np.uint64(c) * p[col] + after[row, -1] - after[row, col], m + 1)
            yield np.arange(n), _sealed(before[:, m] + np.uint64(c) * p[m : m + 1], m + 1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sealed(h: np.ndarray, length: int) -> np.ndarray:
    """The hash mixed with the reduced word's length."""
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64(length * 0x165667B19E3779F9 & (1 << 64) - 1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(29))


def parities(codes: np.ndarray) -> np.ndarray:
    """A bit per letter (accented ones share some): whether it occurs an odd number of times."""
    bit = np.left_shift(np.uint64(1), np.concatenate([np.arange(26), 26 + np.arange(64) % 38]).astype(np.uint64))
    return np.bitwise_xor.reduce(bit[codes], axis=1)


def _by_length(words: list[str], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their letters as a matrix) for words of equal length, at most ``most`` letters at once."""
    raw = [w.encode("latin-1") for w in words]
    length = np.array([len(w) for w in raw], np.int64)
    for m in np.unique(length).tolist():
        rows = np.flatnonzero(length == m)
        step = max(1, most // m)
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            yield part, LETTERS[np.frombuffer(b"".join(raw[r] for r in part), np.uint8)].reshape(len(part), m)


def _stored(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``words(id, word, n)`` → ``key, v, v_word, v_n, v_mask``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(sizes)
        for b in it:
            key, mask = np.zeros(b.num_rows, np.uint64), np.zeros(b.num_rows, np.uint64)
            for rows, codes in _by_length(texts_of(b, "word"), 1 << 20):
                key[rows], mask[rows] = reducer.key(codes), parities(codes)
            arrays = [pa.array(key.view(np.int64)), b.column(0), b.column(1), b.column(2), pa.array(mask.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "v", "v_word", "v_n", "v_mask"])

    return words.select("id", "word", "n").mapInArrow(run, "key long, v long, v_word string, v_n long, v_mask long")


def _looked_up(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``words(id, word)`` → ``key, u, u_mask``: a row per reduced word within one edit."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(sizes)
        for b in it:
            ids = b.column(0).to_numpy()
            for rows, codes in _by_length(texts_of(b, "word"), 1 << 16):
                mask, own = parities(codes).view(np.int64), ids[rows]
                held, n = [], 0
                for row, key in reducer.neighbours(codes):
                    held.append((key.view(np.int64), own[row], mask[row]))
                    n += len(row)
                    if n >= 400_000:
                        yield _columns(held)
                        held, n = [], 0
                if held:
                    yield _columns(held)

    return words.select("id", "word").mapInArrow(run, "key long, u long, u_mask long")


def _columns(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["key", "u", "u_mask"])


def near_pairs(spark: SparkSession, words: DataFrame, hot: int = 64) -> DataFrame:
    """``words(id, word, n)``, distinct and written → ``u, v, v_word, v_n`` for all words one edit apart, both ways."""
    length = F.length("word")
    counted = words.where(length <= LONG).groupBy(length.alias("m")).count().collect()  # at most LONG rows
    sizes = alphabets({r.m: r["count"] for r in counted})
    store = written(spark, _stored(words, sizes), "reduced_words")
    many = written(spark, store.groupBy("key").count().where(F.col("count") > hot).select("key"), "hot_reduced_words")
    look = _looked_up(words, sizes)
    verified = lambda found: (
        found.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u_mask").bitwiseXOR(F.col("v_mask"))) <= 2))
        .select("u", "v", "v_word", "v_n")
        .join(unbroadcast(words.select(F.col("id").alias("u"), F.col("word").alias("u_word"))), "u")
        .where(F.levenshtein("u_word", "v_word", 1) == 1)
        .drop("u_word")
    )
    pairs = verified(unbroadcast(look).join(store.join(many, "key", "left_anti"), "key"))
    if many.isEmpty():
        return pairs
    whole = {m: FULL for m in range(LONG + 1)}
    crowd = store.join(many, "key", "left_semi").select(F.col("v").alias("id"), F.col("v_word").alias("word"), F.col("v_n").alias("n"))
    asking = look.join(many, "key", "left_semi").select(F.col("u").alias("id")).distinct()
    asking = words.join(asking, "id", "left_semi")
    return pairs.unionByName(verified(unbroadcast(_looked_up(asking, whole)).join(_stored(crowd, whole), "key")))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``forms(id, root, root_word)``, one step each → the last word reached; counts at least double at each step, so chains are short."""
    at = written(spark, forms, "spelling_roots")
    while True:
        on = at.select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("root_word").alias("next_word"))
        far = at.join(unbroadcast(on), "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.coalesce("next_word", "root_word").alias("root_word"), F.col("next").isNotNull().alias("moved")
        )
        at = written(spark, far, "spelling_roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")


def variants(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_letters: int = 5, least_count: int = 3,
    every: int = 97, ratio: int = 2, hot: int = 64,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``least_letters`` or more that occurs ``least_count`` times or more.

    Words: runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased; see ``word_counts`` for the letters that
    are left out on purpose. ``n_near``: words one inserted, deleted or replaced code point away. ``form``: the most
    frequent of these (ties: the first in code-point order) if it is ``ratio`` times as frequent as the word, else null;
    ``form_n`` its count. ``root``: where forms lead in the end, the word itself if it has none. Repeated rows count as
    often as they come, a null id reads as an empty text, null and empty texts have no words, an empty table gives an
    empty result. Whole texts are read; other columns are ignored.
    """
    counts = word_counts(docs, id_col, text, least_letters, every).groupBy("word").agg(F.sum("n").alias("n"))
    words = counts.where(F.col("n") >= least_count).withColumn("id", F.monotonically_increasing_id())
    words = written(spark, words.select("id", "word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("v_n")).alias("less"), F.col("v_word").alias("word"), F.col("v").alias("id"))).alias("best")
    near = near_pairs(spark, words, hot).groupBy("u").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, words["id"] == near["u"], "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    joined = joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, F.col("best.id")).alias("form_id"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    joined = written(spark, joined, "spelling_forms")
    roots = _roots(spark, joined.where("form IS NOT NULL").select("id", F.col("form_id").alias("root"), F.col("form").alias("root_word")))
    return joined.join(unbroadcast(roots), "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
