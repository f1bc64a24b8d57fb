"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs n + n*n / ``quadratic`` (feed-forward work grows with n, attention
inside a document with its square). Within a block of documents, pieces go, longest first,
to the sequence of least cost that has room; what doesn't fit is cut off and goes on to the
next. A block's sequences have just the tokens it needs: full ones, and for what is left
over sequences whose lengths are powers of two, which need no padding. So no sequence is
padded, and any task packs its own documents: nothing is shuffled, and a task that is run
again gives the same rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .byte_bpe import byte_of_character
from .common import batches, kept

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SCHEMA = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"
)


def split(text: str | None) -> list:
    """Runs without ASCII blanks. The vocabulary's rules drop white space and never join across it.

    ASCII texts are lower-cased here (the rules do it anyway), so fewer pieces differ.
    """
    if not text:
        return []
    data = text.encode("utf-8")
    return (data.lower() if data.isascii() else data).split()


def split_column(texts: pa.Array) -> pa.ListArray:
    """Per text its runs without ASCII blanks (beside a leading or trailing blank an empty one); a null text is empty."""
    return pc.ascii_split_whitespace(pc.fill_null(texts, ""))


class _Numbers(dict):
    """Numbers units in the order they are first asked for; ``new`` holds those that have no ids yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


class WordIds:
    """Token ids per distinct piece of a word, computed once per worker, by a few library calls per batch.

    Arrow tells a batch's distinct words apart. The file's normaliser runs over all of them at once and
    its pattern splits them into pieces, whose ids are kept; the BPE model runs once over all new
    pieces. A piece's last token is one that the vocabulary marks as ending a word, which tells the
    pieces apart again. Words beyond ``_LATIN`` are pieces of their own, encoded by the library. At
    ``limit`` pieces the table starts again.
    """

    def __init__(self, path: str, limit: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        vocabulary, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.characters = {b: c for c, b in byte_of_character().items() if b != 32}
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.place = _Numbers()
        self.start, self.size, self.flat = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint32))
        self.known = self.used = 0

    def _merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, number of ids per piece)."""
        text = " ".join(pieces)
        mapped = text if text.isascii() and text.isprintable() else text.encode("utf-8").decode("latin-1").translate(self.characters)
        ids = np.array(self.model.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces) or ends[-1] != len(ids):
            raise ValueError("the vocabulary doesn't mark every piece's end")
        return ids, np.diff(ends, prepend=0)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of whole words, by the library's own rules."""
        done = [self.whole.encode(w, add_special_tokens=False).ids for w in words]
        return np.fromiter(chain.from_iterable(done), np.uint32), np.fromiter(map(len, done), np.int64, len(done))

    def _numbers(self, units: list[str], ids_of) -> np.ndarray:
        """The units' numbers; ``ids_of`` encodes those that are new."""
        at = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))
        new, self.place.new = self.place.new, []
        if new:
            ids, sizes = ids_of(new)
            n, self.known = self.known, len(self.place)
            self.start, self.size = (_room(a, self.known) for a in (self.start, self.size))
            self.flat = _room(self.flat, self.used + len(ids))
            self.flat[self.used : self.used + len(ids)] = ids
            self.size[n : self.known] = sizes
            self.start[n : self.known] = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
        return at

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """(numbers of all pieces in order, number of pieces per word); none if the pattern leaves something out."""
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        low = (text if text.isascii() else self.whole.normalizer.normalize_str(text)).lower()
        parts, pieces = low.split(" "), self.find(low)
        word_ends, piece_ends = (np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in (parts, pieces))
        if len(parts) != len(words) or word_ends[-1] != (piece_ends[-1] if pieces else 0):
            return None
        return self._numbers(pieces, self._merge), np.diff(np.searchsorted(piece_ends, word_ends, "right"), prepend=0)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's begin, how many it has) of distinct words."""
        plain = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        other = pc.match_substring_regex(words, _OTHER).to_numpy(zero_copy_only=False)
        order, at, n = [], [], []
        for group in (plain, ~plain & ~other, other):
            where = np.flatnonzero(group)
            for i in range(0, len(where), 100_000):
                part = words.take(pa.array(where[i : i + 100_000])).cast(pa.string())
                found = None if group is other else self._pieces(part)
                if found is None:  # the library's character classes and these may differ
                    found = self._numbers(part.to_pylist(), self._encode), np.ones(len(part), np.int64)
                order.append(where[i : i + 100_000])
                at.append(found[0])
                n.append(found[1])
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if not order:
            return np.zeros(0, np.uint32), start, size
        order, at, n = map(np.concatenate, (order, at, n))
        sizes = self.size[at]
        bound = _bounds(sizes)[_bounds(n)]
        start[order], size[order] = bound[:-1], np.diff(bound)
        return self.flat[_runs(self.start[at], sizes)], start, size

    def ids(self, docs: pa.ListArray | list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, number of ids per document) of documents given as lists of words."""
        if len(self.place) > self.limit:
            self.clear()
        docs = docs if isinstance(docs, pa.Array) else pa.array(docs, pa.list_(pa.string()))
        words = docs.flatten().dictionary_encode()
        flat, start, size = self.encode(words.dictionary)
        at = words.indices.to_numpy()
        bound = _bounds(size[at])
        ids = np.empty(bound[-1], np.uint32)
        for i in range(0, len(at), 1 << 19):
            part = at[i : i + (1 << 19)]
            ids[bound[i] : bound[i + len(part)]] = flat[_runs(start[part], size[part])]
        return ids, np.diff(bound[_bounds(pc.list_value_length(docs).to_numpy())])


#: Within these the library's character classes and those of ``regex`` agree, and no blank but the ASCII ones occurs.
_LATIN = r"\x00-\x7f\xa1-\x{24f}"
_OTHER = f"[^{_LATIN}]"


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def _bounds(size: np.ndarray) -> np.ndarray:
    """Where consecutive runs begin, and the end of the last."""
    return np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of consecutive runs laid end to end."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def capacities(tokens: int, length: int) -> list[int]:
    """Sequence lengths that hold ``tokens`` exactly: full ones, then the binary digits of the rest."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def assign(sizes: np.ndarray, length: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) per piece; ties go to the earlier document and sequence."""
    room = capacities(int(sizes.sum()), length)
    used = [0] * len(room)
    heap = [(0.0, s) for s in range(len(room))]
    out = []
    for d in np.argsort(-sizes, kind="stable"):
        start, left = 0, int(sizes[d])
        while left:
            cost, s = heapq.heappop(heap)
            n = min(left, room[s] - used[s])
            out.append((int(d), start, n, s, used[s]))
            used[s] += n
            start += n
            left -= n
            if used[s] < room[s]:
                heapq.heappush(heap, (cost + n + n * n / quadratic, s))
    return out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = 4096,
    quadratic: float = 4096.0,
    block_tokens: int = 1 << 20,
    end_id: int = END_ID,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: the id, ``start`` (its document's ids before it), ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` there, ``cost``.

    ``length`` is a power of two. A null or empty text is a document of its end id alone.
    Repeated rows are packed as often as they come. Sequence ids are unique, not gapless: the
    task's number in the upper half, a count in the lower. A block closes when it holds
    ``block_tokens``, which bounds memory; a document is at most one block.
    """
    if length & (length - 1):
        raise ValueError("length is a power of two")
    path = path or public_tokenizers.path(VOCABULARY)
    src = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept("word_bpe", path, lambda: WordIds(path))
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        names: list = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal sequence
            sizes = np.array([len(p) for p in parts], np.int64)
            rows = assign(sizes, length, quadratic)
            d, start, n, s, off = (np.array(c, np.int64) for c in zip(*rows))
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in d], id_type),
                    pa.array(start),
                    pa.array(n),
                    pa.array([parts[i][a : a + k].tobytes() for i, a, k in zip(d, start, n)], pa.binary()),
                    pa.array(sizes[d]),
                    pa.array(s + sequence),
                    pa.array(off),
                    pa.array(n + n * n / quadratic),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"],
            )
            sequence += int(s.max()) + 1
            names.clear()
            parts.clear()
            return batch

        held = 0
        for b in batches(it, "text", 16 << 20):
            id_type = b.schema.field("id").type
            ids, sizes = table.ids(split_column(b.column(b.schema.get_field_index("text"))))
            bound = np.cumsum(sizes)
            for name, lo, hi in zip(b.column(0).to_pylist(), bound - sizes, bound):
                parts.append(np.append(ids[lo:hi], np.uint32(end_id)).astype("<u4"))
                names.append(name)
                held += int(hi - lo) + 1
                if held >= block_tokens:
                    yield close()
                    held = 0
        if parts:
            yield close()

    return src.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def ids_crc32(col: str = "ids") -> Column:
    return F.crc32(F.col(col))

