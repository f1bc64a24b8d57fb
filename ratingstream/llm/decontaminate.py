"""Benchmark decontamination with suffix arrays of the training text.

Every slice of documents is a shard. Its words become numbers (0: no benchmark word, or a
document's end), and its suffixes are sorted by prefix doubling into a suffix array. Every suffix of
every benchmark item is binary-searched in it, one word deeper at a time for all suffixes at once:
the depth at which its interval in the array empties is its longest verbatim match in the shard, the
interval before that holds the locations, and the interval at a window's length all the window's
occurrences.

A window has only benchmark words, so stretches of fewer such words than the shortest window are
left out of the array, which loses no occurrence. Nothing is shuffled. The benchmark
goes to the tasks as a broadcast; if its texts exceed ``block_bytes``, it is dealt into blocks by
hash and searched in one pass per block, so the broadcast stays bounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, kept, texts_of, with_columns, written

#: A-Z lower-cased; a-z, 0-9 and all bytes from 0x80 on belong to words; the rest parts them.
WORDS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
#: Bytes of text whose words are held as objects at once, and words of a shard's suffix array.
CHUNK, SHARD = 4 << 20, 4 << 20


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(WORDS).split() if text else []


@dataclass
class Tests:
    """The suffixes of a block of benchmark items."""

    vocabulary: dict[bytes, int]  # numbers from 1
    flat: np.ndarray  # all items' words, a 0 after each item
    start: np.ndarray  # per suffix its place in ``flat``
    left: np.ndarray  # and its number of words
    window: np.ndarray  # the length of the window that begins there, or 0
    item: np.ndarray  # its item's number
    names: list[str | None]
    shortest: int

    @property
    def longest(self) -> int:
        return int(self.left.max(initial=0))


def tests_of(items: list[tuple[str | None, str | None]], window: int) -> Tests:
    """The suffixes of (item id, text) pairs. An item of fewer words than ``window``, but not none, is one window."""
    vocabulary: dict[bytes, int] = {}
    flat, start, left, win, item, names = [], [], [], [], [], []
    number: dict[str | None, int] = {}
    for name, text in items:
        ws = words(text)
        w = min(window, len(ws))
        for o in range(len(ws)):
            start.append(len(flat) + o)
            left.append(len(ws) - o)
            win.append(w if o + w <= len(ws) else 0)
            item.append(number.setdefault(name, len(number)))
        flat += [vocabulary.setdefault(x, len(vocabulary) + 1) for x in ws] + [0]
    names = list(number)
    a = [np.array(x, np.int64) for x in (start, left, win, item)]
    return Tests(vocabulary, np.array(flat, np.int64), *a, names, int(a[2][a[2] > 0].min(initial=window)))


def numbers(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """A text's words as numbers; very long texts are split in parts, cut between words."""
    data = text.encode("utf-8").translate(WORDS) if text else b""
    out, at = [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= CHUNK else data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        ws = data[at:end].split()
        out.append(np.fromiter(map(vocabulary.get, ws, repeat(0)), np.int32, len(ws)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def without_short_runs(ids: np.ndarray, least: int) -> np.ndarray:
    """``ids`` with runs of fewer than ``least`` numbers above 0 set to 0."""
    edge = np.flatnonzero(np.diff((ids > 0).astype(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= least
    step = np.zeros(len(ids) + 1, np.int64)
    step[begin[long]] = 1
    step[end[long]] = -1
    return np.where(np.cumsum(step[:-1]) > 0, ids, 0)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes that begin with a number above 0, in order of their first ``depth`` numbers up to the first 0."""
    at = np.flatnonzero(ids)
    padded = np.concatenate([ids, np.zeros(64, ids.dtype)]).astype(np.uint64)
    bits = int(ids.max(initial=1)).bit_length()
    h = max(1, min(64 // bits, depth))
    key, alive = np.zeros(len(at), np.uint64), np.ones(len(at), bool)
    for j in range(h):
        w = padded[at + j]
        alive &= w > 0
        key = key << np.uint64(bits) | np.where(alive, w, np.uint64(0))
    while True:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        rank = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])[: len(at)]).astype(np.uint64)
        if h >= depth or not len(at) or int(rank[-1]) == len(at):
            return at
        all_ranks = np.zeros(len(ids) + h + 1, np.uint64)
        all_ranks[at] = rank
        key = rank * np.uint64(len(at) + 1) + all_ranks[at + h]
        h *= 2


def _bound(sa: np.ndarray, padded: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int, word: np.ndarray, after: bool) -> np.ndarray:
    """Per query the first place in [lo, hi) whose word at depth ``d`` is at least (or above) ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        w = padded[sa[mid] + d]
        below = w <= word[open_] if after else w < word[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]


def search(sa: np.ndarray, ids: np.ndarray, t: Tests) -> tuple[np.ndarray, ...]:
    """For every test suffix: its longest match (words), the match's interval in the array, and its window's interval."""
    n = len(t.start)
    padded = np.concatenate([ids, np.zeros(t.longest + 1, ids.dtype)])
    lo, hi = np.zeros(n, np.int64), np.full(n, len(sa))
    length, best_lo, best_hi = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    win_lo, win_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.flatnonzero(lo < hi)
    d = 0
    while len(live):
        live = live[t.left[live] > d]
        word = t.flat[t.start[live] + d]
        new_lo = _bound(sa, padded, lo[live], hi[live], d, word, False)
        new_hi = _bound(sa, padded, new_lo, hi[live], d, word, True)
        d += 1
        there = new_lo < new_hi
        live, new_lo, new_hi = live[there], new_lo[there], new_hi[there]
        lo[live], hi[live] = new_lo, new_hi
        length[live], best_lo[live], best_hi[live] = d, new_lo, new_hi
        full = t.window[live] == d
        win_lo[live[full]], win_hi[live[full]] = new_lo[full], new_hi[full]
    return length, best_lo, best_hi, win_lo, win_hi


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval's number, place) of all places in intervals."""
    n = hi - lo
    ends = np.cumsum(n)
    return np.repeat(np.arange(len(n)), n), np.repeat(lo - (ends - n), n) + np.arange(int(n.sum()))


def _shards(docs: list[np.ndarray], overlap: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(numbers, first document, first word): documents joined by a 0; a longer one as parts that overlap by ``overlap``."""
    if len(docs) == 1 and len(docs[0]) > SHARD + overlap:
        for k in range(0, len(docs[0]) - overlap, SHARD):
            yield docs[0][k : k + SHARD + overlap], 0, k
        return
    yield np.concatenate([np.append(d, np.int32(0)) for d in docs]) if docs else np.zeros(0, np.int32), 0, 0


def hits(texts: list[str | None], t: Tests) -> tuple[list[int], list[np.ndarray], list[list[str | None]]]:
    """Per text its number of words, the merged word ranges [start, end) inside occurrences, and the items that occur."""
    docs = [numbers(x, t.vocabulary) for x in texts]
    n_words = [len(d) for d in docs]
    spans: list[np.ndarray] = [np.zeros((0, 2), np.int64)] * len(docs)
    items: list[set] = [set() for _ in docs]
    first = np.concatenate([[0], np.cumsum(np.array(n_words, np.int64) + 1)])
    cover = np.zeros(int(first[-1]) + 1, np.int64) if len(t.start) else np.zeros(0, np.int64)
    if not len(t.start):
        return n_words, spans, [[] for _ in docs]
    overlap = int(t.window.max()) - 1
    for ids, _, at in _shards(docs, overlap):
        ids = without_short_runs(ids, t.shortest)
        sa = suffix_array(ids, t.longest)
        if not len(sa):
            continue
        *_, lo, hi = search(sa, ids, t)
        found = np.flatnonzero(lo < hi)
        # Equal windows have equal intervals: each interval's places are read once.
        key = np.stack([lo[found], hi[found], t.window[found]], axis=1)
        each, which = np.unique(key, axis=0, return_inverse=True)
        which = which.ravel()
        interval, place = _spread(each[:, 0], each[:, 1])
        p = sa[place] + at
        np.add.at(cover, p, 1)
        np.add.at(cover, p + each[interval, 2], -1)
        doc = np.searchsorted(first, p, side="right") - 1
        held: list[set] = [set() for _ in each]
        for w, i in zip(which.tolist(), t.item[found].tolist()):
            held[w].add(i)
        for code in np.unique(doc * len(each) + interval).tolist():
            items[code // len(each)] |= held[code % len(each)]
    inside = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    owner = np.searchsorted(first, edge[:, 0], side="right") - 1
    for d in np.unique(owner).tolist():
        spans[d] = edge[owner == d] - first[d]
    names = [[t.names[i] for i in s] for s in items]
    return n_words, spans, [sorted((x for x in s if x is not None)) + [None] * (None in s) for s in names]


def _blocks(spark: SparkSession, benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> Iterator[Tests]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time on the driver."""
    src = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("length(text) > 0")
    total = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        rows = src if n == 1 else src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        yield tests_of([(r.item, r.text) for r in rows.collect()], window)


#: Names for columns within a pass, which no input column has.
TEXT, SPANS, ITEMS, N = "\x01text", "\x01spans", "\x01items", "\x01n"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two lists of ranges, as disjoint ranges in order."""
    both = np.concatenate([a, b])
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    new = np.concatenate([[True], both[1:, 0] > reach[:-1]])[: len(both)]
    last = np.append(new[1:], True)[: len(both)]
    return np.stack([both[new, 0], reach[last]], axis=1)


def scan(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` without ``text``, plus ``n_words``, ``n_hit``, ``n_items``, ``items``, ``spans``, ``contaminated``.

    ``spans``: disjoint word ranges [start, end) that lie inside occurrences of windows, in order;
    ``n_hit`` counts their words; ``items``: ids (as strings, sorted) of the items with an occurring
    window. One row in, one row out. Null and empty texts have no words. Repeated item ids are one item
    with the windows of all its rows; items without an id are searched, count as one item together and
    are not named in ``items``. An empty benchmark hits nothing. Input columns with the new names are
    replaced.
    """
    new = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated"]
    keep = [c for c in docs.columns if c not in (text, *new)]
    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(TEXT))
    out = out.withColumns({N: F.lit(0).cast("long"), SPANS: F.expr("CAST(array() AS array<struct<start:long,end:long>>)"), ITEMS: F.expr("CAST(array() AS array<string>)")})
    for i, t in enumerate(_blocks(spark, benchmark, item_id, item_text, window, block_bytes)):
        if i:  # one pass per block, one block in a worker
            out = written(spark, out, "decontamination")
        out = _pass(spark, out, t)
    spans, items = F.col(SPANS), F.col(ITEMS)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(N).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.filter(items, lambda x: x.isNotNull()).alias("items"),
        spans.alias("spans"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def _pass(spark: SparkSession, docs: DataFrame, tests: Tests) -> DataFrame:
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, tests))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, value = shared.value
        t = kept("decontamination", key, lambda: value)
        for b in batches(it, TEXT, CHUNK):
            n, spans, items = hits(texts_of(b, TEXT), t)
            had = [b.column(b.schema.get_field_index(c)).to_pylist() for c in (SPANS, ITEMS)]
            spans = [_merge(np.array([(s["start"], s["end"]) for s in a], np.int64).reshape(-1, 2), s) if a else s for a, s in zip(had[0], spans)]
            items = [sorted({*a, *s} - {None}) + [None] * (None in a or None in s) if a else s for a, s in zip(had[1], items)]
            cols = {
                N: pa.array(n, pa.int64()),
                SPANS: pa.array([[{"start": x, "end": y} for x, y in s.tolist()] for s in spans], _SPAN),
                ITEMS: pa.array(items, pa.list_(pa.string())),
            }
            yield with_columns(b, pa.schema([f.with_type(cols[f.name].type) if f.name in cols else f for f in b.schema]), **cols)

    return docs.mapInArrow(run, docs.schema)


def remove(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, block_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) without an occurrence of any window."""
    copy = docs.withColumn("\x01doc", F.col(f"`{text}`"))
    names = {c: f"\x01c{i}" for i, c in enumerate(docs.columns)}  # the scan's new columns replace none of the input's
    hidden = copy.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], "\x01doc")
    clean = scan(spark, hidden, benchmark, "\x01doc", item_id, item_text, window, block_bytes).where("NOT contaminated")
    return clean.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def matches(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, block_bytes: int = 8 << 20,
) -> DataFrame:
    """Longest verbatim matches and their locations: ``id_col, doc_start, item_id (string), item_start, n_words``.

    A row per item suffix, document place and shard: the suffix matches ``n_words`` words there (at least its
    item's window), no place in the shard (a slice of documents) matches more, and the word before isn't part of
    the match. Parts of a text of over 4 million words are shards of their own.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = None
    for t in _blocks(spark, benchmark, item_id, item_text, window, block_bytes):
        shared = spark.sparkContext.broadcast(t)

        def run(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            t = shared.value
            for b in batches(it, "text", CHUNK):
                ds = [numbers(x, t.vocabulary) for x in texts_of(b, "text")]
                first = np.concatenate([[0], np.cumsum([len(d) + 1 for d in ds])])
                for ids, _, at in _shards(ds, int(t.window.max(initial=1)) - 1):
                    ids = without_short_runs(ids, t.shortest)
                    sa = suffix_array(ids, t.longest)
                    if not len(sa) or not len(t.start):
                        continue
                    length, lo, hi, *_ = search(sa, ids, t)
                    least = np.where(t.window > 0, t.window, np.iinfo(np.int64).max)
                    s = np.flatnonzero(length >= least)
                    which, place = _spread(lo[s], hi[s])
                    s, p = s[which], sa[place]
                    before = np.where(t.start[s] > 0, t.flat[t.start[s] - 1], 0)
                    whole = (before == 0) | (p == 0) | (ids[p - 1] != before)
                    s, p = s[whole], p[whole]
                    d = np.searchsorted(first, p + at, side="right") - 1
                    ends = np.flatnonzero(t.flat == 0)
                    item_start = t.start[s] - np.concatenate([[0], ends + 1])[np.searchsorted(ends, t.start[s])]
                    names = b.column(0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(d)), pa.array(p + at - first[d]), pa.array([t.names[i] for i in t.item[s]], pa.string()),
                            pa.array(item_start), pa.array(length[s]),
                        ],
                        ["id", "doc_start", "item", "item_start", "n_words"],
                    )

        part = src.mapInArrow(run, f"id {kind}, doc_start long, item string, item_start long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(id_col), "doc_start", F.col("item").alias("item_id"), "item_start", "n_words")


def sql() -> str:
    """DuckDB SQL of the query: windows by length, joined to the documents' word sequences of that length."""
    words_of = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH item AS (SELECT item_id, {words_of.format(t="text")} AS w FROM benchmark),
    sized AS (SELECT *, least(10, len(w)) AS k FROM item WHERE len(w) > 0),
    win AS (SELECT DISTINCT item_id, k, array_to_string(w[o : o + k - 1], ' ') AS s
            FROM sized, unnest(range(1, len(w) - k + 2)) AS u(o)),
    doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({words_of.format(t="text")}, []) AS w FROM documents),
    lengths AS (SELECT DISTINCT k FROM win),
    seq AS (SELECT r, k, o, array_to_string(w[o : o + k - 1], ' ') AS s FROM doc, lengths, unnest(range(1, len(w) - k + 2)) AS u(o)),
    hit AS (SELECT seq.r, seq.o, seq.k, win.item_id FROM seq JOIN win ON seq.k = win.k AND seq.s = win.s),
    cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(o, o + k)) AS p FROM (SELECT DISTINCT r, o, k FROM hit)) GROUP BY r),
    found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN cover USING (r) LEFT JOIN found USING (r)"""
