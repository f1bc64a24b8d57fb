"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on toxic, one on ordinary text. Both begin
with the same background (trained on ordinary text), so that what they share cancels out.
A window of text is compressed with each; it is nearer to toxic text the more bytes the
toxic dictionary saves beside the ordinary one. A window is one word (a run of letters, A-Z
lower-cased) between a fixed carrier, which both dictionaries hold, and a fixed end:
the lengths of longer windows vary by more than one word saves, and each different
word needs compressing only once per worker. Runs of over ``WINDOW`` bytes (scripts without
blanks) are several windows that overlap and cover the whole run.

Training text is chosen by contrast on a bounded sample of labelled rows: words of toxic
documents that are, or hold a letter sequence, much more common in toxic than in ordinary
documents. The ordinary dictionary also gets the ordinary words that the toxic one would shorten,
twice over. A logistic layer with few inputs (the largest saving, how many windows
save how much, their share) is calibrated on sample documents held back from the dictionaries.
"""

from __future__ import annotations

import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordTable, batches, kept, labelled_sample, texts_of, with_columns

#: Letters stay (A-Z lower-cased, bytes of other scripts as they are); all else parts words.
LETTERS = bytes((c | 32 if 65 <= c <= 90 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Blanks, marks without width and punctuation outside ASCII part windows too.
APART = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c)[0] in "ZP" or c in "\x85\u200b\u2060\ufeff")
#: Bytes of a window at most; two windows of a run share half of them.
WINDOW = 64
END = b" 01234567"
#: Savings of this many bytes are counted.
STEPS = (2, 3, 4)


@dataclass(frozen=True)
class ToxicityParams:
    background: int = 8192
    toxic: int = 1536
    ordinary: int = 1536
    negatives: int = 6144
    segment: int = 12
    grams: tuple[int, ...] = (6, 8)
    #: Share of the toxic documents that must hold a letter sequence or word for it to count as
    #: toxic, and how many times the ordinary documents' share that must be.
    share: float = 0.012
    ratio: float = 15.0
    #: The bound of the training sample, per class, and the longest text drawn.
    per_class: int = 1500
    max_chars: int = 32_768
    folds: int = 5


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    carrier: bytes
    weights: np.ndarray
    prior: float


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(LETTERS).split() if text else []


def windows(text: str | None) -> list[bytes]:
    """The words; a longer run of letters as overlapping windows that cover it, each of its parts of up to WINDOW / 2 bytes whole in one."""
    if not text:
        return []
    for c in () if text.isascii() else APART.intersection(text):
        text = text.replace(c, " ")
    ws = words(text)
    if max(map(len, ws), default=0) <= WINDOW:
        return ws
    half = WINDOW // 2
    return [w[i : i + WINDOW] for w in ws for i in range(0, max(1, len(w) - half), half)]


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters(
        strategy=zstd.STRATEGY_BTLAZY2, min_match=4, search_log=6, target_length=32, window_log=17, hash_log=15, chain_log=16,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=d, compression_params=params)


def _lengths(c: zstd.ZstdCompressor, framed: list[bytes]) -> np.ndarray:
    out = np.empty(len(framed))
    for i in range(0, len(framed), 20_000):
        part = c.multi_compress_to_buffer(framed[i : i + 20_000], threads=1)
        out[i : i + len(part)] = [len(part[k]) for k in range(len(part))]
    return out


def savings(model: ToxicityModel, tox: zstd.ZstdCompressor, ordn: zstd.ZstdCompressor, ws: list[bytes]) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each word's window beside the ordinary one."""
    if not ws:
        return np.zeros(0)
    framed = [model.carrier + b" " + w + END for w in ws]
    return _lengths(ordn, framed) - _lengths(tox, framed)


def _cover(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary trained on the samples; the samples themselves if they are too few to train on."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstd.train_dictionary(size + 512, samples, k=segment, d=6).as_bytes()[-size:]
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _grams(ws: set[bytes], sizes: tuple[int, ...]) -> set[bytes]:
    """The words (blanks at their ends) and their letter sequences of the given sizes."""
    ends = [b" " + w + b" " for w in ws]
    return {x[i : i + n] for x in ends for n in sizes for i in range(len(x) - n + 1)}.union(ends)


def _features(place: np.ndarray, sizes: np.ndarray, saved: np.ndarray) -> np.ndarray:
    """Per document: a constant, the largest saving, counts and shares of windows that save STEPS bytes."""
    n = len(sizes)
    doc = np.repeat(np.arange(n), sizes)
    s = saved[place]
    top = np.zeros(n)
    np.maximum.at(top, doc, s)
    cols = [np.ones(n), np.minimum(top, 8) / 4]
    for k in STEPS:
        c = np.bincount(doc[s >= k], minlength=n)
        cols += [np.log1p(c), np.minimum(50 * c / np.maximum(sizes, 1), 3)]
    return np.stack(cols, axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    eye = ridge * np.eye(len(w))
    eye[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + eye @ w
        h = (x * (p * (1 - p))[:, None]).T @ x + eye
        w -= np.linalg.solve(h, g)
    return w


def _differing(docs: list[list[bytes]]) -> list[list[bytes]]:
    """Without copies and near copies: the first of the texts that agree in four independent minimum hashes of their words."""
    first = {}
    for d in docs:
        h = np.array([xxhash.xxh64_intdigest(w) for w in set(d)] or [0], np.uint64)
        with np.errstate(over="ignore"):
            key = tuple(int((h * np.uint64(m)).min()) for m in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
        first.setdefault(key, d)
    return list(first.values())


def train(sample: list[tuple[str, int]], p: ToxicityParams) -> ToxicityModel:
    """Fit on (text, label) pairs. With one class only, every score is that class's share; with none, 0."""
    docs = {y: _differing([windows(t) for t, k in sample if k == y]) for y in (0, 1)}
    if not docs[0] or not docs[1]:
        return ToxicityModel(b"", b"", b"", np.zeros(0), float(bool(docs[1])))
    # A third of each class is held back for calibration.
    learn = {y: [set(d) for i, d in enumerate(v) if i % 3 or len(v) < 3] for y, v in docs.items()}
    rest = {y: [d for i, d in enumerate(v) if i % 3 == 0] for y, v in docs.items()}
    half = len(learn[0]) * 2 // 3
    seen = Counter(g for s in learn[0][:half] for g in _grams(s, p.grams))

    def contrast(group: list[set[bytes]]) -> list[bytes]:
        count = Counter(g for s in group for g in _grams(s, p.grams))
        least, share = max(2, p.share * len(group)), p.ratio * len(group) / max(1, half)
        often = {g for g, n in count.items() if n >= least and n >= share * (seen[g] + 1)}
        chosen = ([w for w in sorted(s) if not often.isdisjoint(_grams({w}, p.grams))] for s in group)
        return [b" " + b" ".join(ws) + b" " for ws in chosen if ws]

    plain = [b" " + b" ".join(d[i : i + 10]) + b" " for d in rest[0][:400] + [sorted(s) for s in learn[0][:400]] for i in range(0, len(d), 10)]
    base = _cover(plain[:40_000], p.background, 64)
    carrier = base[-32:]
    toxic = base + _cover(contrast(learn[1]), p.toxic, p.segment)
    extra = _cover(contrast(learn[0][half:]), p.ordinary, p.segment)  # as near the window as the toxic text is
    count = Counter(w for s in learn[0] for w in s)
    vocabulary = sorted(count)
    negatives = b""
    for _ in range(2):
        model = ToxicityModel(toxic, negatives + base + extra, carrier, np.zeros(0), 0.0)
        saved = savings(model, _compressor(model.toxic), _compressor(model.ordinary), vocabulary)
        wrong = sorted((w for w, s in zip(vocabulary, saved) if s >= 2), key=lambda w: (-count[w], w))
        negatives = (negatives + b" " + b" ".join(wrong))[: p.negatives] if wrong else negatives
    model = ToxicityModel(toxic, negatives + base + extra, carrier, np.zeros(0), 0.0)
    table = word_table(model)
    both = rest[0] + rest[1]
    place, sizes = table.lookup(both)
    x = _features(place, sizes, table.rows[:, 0])
    y = np.concatenate([np.zeros(len(rest[0])), np.ones(len(rest[1]))])
    return ToxicityModel(model.toxic, model.ordinary, carrier, _logistic(x, y), 0.0)


def word_table(model: ToxicityModel) -> WordTable:
    tox, ordn = _compressor(model.toxic), _compressor(model.ordinary)
    return WordTable(lambda ws: savings(model, tox, ordn, ws)[:, None], 1, 500_000)


def score_texts(model: ToxicityModel, texts: list[str | None], table: WordTable | None) -> np.ndarray:
    """Class-1 probability per text; texts without letters have the constant's."""
    if table is None:
        return np.full(len(texts), model.prior)
    place, sizes = table.lookup([windows(t) for t in texts])
    return 1 / (1 + np.exp(-np.clip(_features(place, sizes, table.rows[:, 0]) @ model.weights, -500, 500)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text", params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    p = params
    return train(labelled_sample(spark, docs, labels, label, id_col, text, p.folds, p.per_class, p.max_chars), p)


def score(spark: SparkSession, docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score", threshold: float = 0.5, predicted: str = "predicted") -> DataFrame:
    """``docs`` with ``out`` (double, 0 to 1) and ``predicted`` (1 if ``out`` >= threshold; the argument names the column) added.

    Whole texts are read. Null and empty texts get the constant's probability. Columns of the
    input with those names are replaced; one row in, one row out, no shuffle.
    """
    keep = [c for c in docs.columns if c not in (out, predicted)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = src.withColumn(out, F.lit(0.0)).withColumn(predicted, F.lit(0)).schema
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, m = shared.value
        words_kept = kept("toxicity", key, lambda: word_table(m)) if len(m.weights) else None
        for b in batches(it, text, 4 << 20):
            s = score_texts(m, texts_of(b, text), words_kept)
            arrow = pa.schema([*b.schema, pa.field(out, pa.float64()), pa.field(predicted, pa.int32())])
            yield with_columns(b, arrow, **{out: s, predicted: (s >= threshold).astype(np.int32)})

    return src.mapInArrow(run, schema)
