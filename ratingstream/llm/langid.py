"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary (byte pieces of
up to ``max_piece`` bytes, all single bytes among them). A word's probability is the sum over
all its segmentations into pieces, by a forward algorithm; a text's is the product over its
words (runs of letters, A-Z lower-cased, with the blank before them, so no piece crosses
words). The piece probabilities are learned by expectation maximisation (forward-backward
counts over all segmentations) on a bounded sample of labelled rows.
"""

from __future__ import annotations

import base64
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WordTable, batches, crc_mod, kept, texts_of, with_columns
from .toxicity import words

VOCABULARY = "byte_bpe_50k.tiktoken"
PRIME = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class LangParams:
    max_piece: int = 8
    rounds: int = 3
    smoothing: float = 0.05
    #: The bound of the training sample, per language, and the longest text drawn.
    per_language: int = 150
    max_chars: int = 32_768
    folds: int = 5


@dataclass(frozen=True)
class LangModel:
    """``probs[piece, language]``; its last row (zeros) stands for byte strings that are no piece."""

    langs: tuple[str, ...]
    probs: np.ndarray
    path: str
    max_piece: int


@lru_cache(maxsize=2)
def _pieces(path: str, max_piece: int) -> list[bytes]:
    with open(path, "rb") as f:
        all_pieces = (base64.b64decode(line.split()[0]) for line in f if line.strip())
        # Texts are lower-cased and hold letters and blanks only: other pieces never match.
        return [p for p in all_pieces if len(p) <= max_piece and (len(p) == 1 or p == p.lower())]


def _hashes(x: np.ndarray, max_piece: int) -> list[np.ndarray]:
    """For each length k, the hash of the k bytes from each position of the rows of ``x``."""
    out, h = [], np.zeros(x.shape, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, max_piece + 1):
            n = x.shape[1] - k + 1
            if n <= 0:
                break
            h = (h[:, :n] + x[:, k - 1 : k - 1 + n] + np.uint64(k)) * PRIME
            h = h ^ (h >> np.uint64(31))
            out.append(h)
    return out


class PieceIndex:
    """Finds pieces by hash: two possible slots each (a piece goes to its second if the first is taken)."""

    BITS = 20

    def __init__(self, pieces: list[bytes], max_piece: int):
        self.missing = len(pieces)
        self.key = np.zeros(1 << self.BITS, np.uint64)
        self.id = np.full(1 << self.BITS, self.missing, np.int64)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_size.setdefault(len(p), []).append(i)
        for size, at in by_size.items():
            x = np.frombuffer(b"".join(pieces[i] for i in at), np.uint8).reshape(-1, size).astype(np.uint64)
            h = _hashes(x, max_piece)[size - 1][:, 0]
            for i, one, slots in zip(at, h, zip(*(v.tolist() for v in self._slots(h)))):
                s = slots[0]
                for _ in range(100):
                    i, one, self.id[s], self.key[s] = int(self.id[s]), self.key[s], i, one
                    if i == self.missing:
                        break
                    # The piece that was here goes to its other slot.
                    first, second = (int(v[0]) for v in self._slots(np.array([one])))
                    s = second if s == first else first
                else:
                    raise RuntimeError("piece hashes clash")

    def _slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            shift = np.uint64(64 - self.BITS)
            return (h >> shift).astype(np.int64), ((h * OTHER) >> shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        a, b = self._slots(h)
        first = np.where(self.key[a] == h, self.id[a], self.missing)
        return np.where(first == self.missing, np.where(self.key[b] == h, self.id[b], self.missing), first)


@lru_cache(maxsize=1)
def _index(path: str, max_piece: int) -> PieceIndex:
    return PieceIndex(_pieces(path, max_piece), max_piece)


def _groups(ws: list[bytes], size: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, lengths, bytes padded with 0) of words of like length; each has the blank before it."""
    n = np.fromiter(map(len, ws), np.int64, len(ws)) + 1
    order = np.argsort(n, kind="stable")
    i = 0
    while i < len(order):
        # Few at a time if the words are very long, so memory stays bounded.
        at = order[i : i + size]
        while len(at) > 1 and int(n[at[-1]]) * len(at) > 1 << 18:
            at = at[: len(at) // 2]
        m = int(n[at[-1]])
        x = np.frombuffer(b"".join((b" " + ws[k]).ljust(m, b"\0") for k in at), np.uint8).reshape(len(at), m)
        yield at, n[at], x.astype(np.uint64)
        i += len(at)


def _forward(ids: list[np.ndarray], probs: np.ndarray, rows: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """alpha[j] (probability mass of the first j bytes, all segmentations) with its logarithmic scale per word and step."""
    langs = probs.shape[1]
    alpha = np.zeros((m + 1, rows, langs))
    alpha[0] = 1.0
    scale = np.zeros((m + 1, rows, langs))
    log = np.zeros((rows, langs))
    for j in range(1, m + 1):
        total = np.zeros((rows, langs))
        for k in range(1, min(j, len(ids)) + 1):
            total += alpha[j - k] * probs[ids[k - 1][:, j - k]]
        alpha[j] = total
        # Rescaled before numbers get too small: the last pieces' masses share one scale.
        if j % 16 == 0:
            top = np.maximum(alpha[max(0, j - len(ids) + 1) : j + 1].max(axis=0), 1e-300)
            alpha[max(0, j - len(ids) + 1) : j + 1] /= top
            log = log + np.log(top)
        scale[j] = log
    return alpha, scale


def word_scores(ws: list[bytes], model: LangModel) -> np.ndarray:
    """Natural logarithm of each word's probability, all segmentations summed, per language."""
    index = _index(model.path, model.max_piece)
    out = np.zeros((len(ws), len(model.langs)))
    for at, n, x in _groups(ws):
        ids = [index.find(h) for h in _hashes(x, model.max_piece)]
        alpha, scale = _forward(ids, model.probs, len(at), x.shape[1])
        r = np.arange(len(at))
        # A rescale between a word's end and the row's touches earlier masses too: take the value at its own end.
        out[at] = np.log(np.maximum(alpha[n, r], 1e-300)) + _scale_at(scale, n, r, len(ids))
    return out


def _scale_at(scale: np.ndarray, n: np.ndarray, r: np.ndarray, back: int) -> np.ndarray:
    """The scale that the stored mass at byte n has: rescales up to ``back - 1`` bytes later include it."""
    last = np.minimum(((n + back - 1) // 16) * 16, scale.shape[0] - 1)
    last = np.where(last >= n, last, n)
    return scale[last, r]


def train(counts: dict[str, Counter], path: str, p: LangParams) -> LangModel:
    """Expectation maximisation on word counts per language; no language: a model that knows none."""
    langs = tuple(sorted(counts))
    pieces = _pieces(path, p.max_piece)
    index = _index(path, p.max_piece)
    v = len(pieces)
    if not langs:
        return LangModel((), np.zeros((v + 1, 0)), path, p.max_piece)
    cols = []
    for lang in langs:
        ws = sorted(counts[lang])
        weight = np.array([counts[lang][w] for w in ws], float)
        prob = None
        for _ in range(p.rounds):
            got = np.zeros(v + 1)
            for at, n, x in _groups(ws):
                ids = [index.find(h) for h in _hashes(x, p.max_piece)]
                w, m = weight[at], x.shape[1]
                inside = [np.arange(i.shape[1])[None, :] + k + 1 <= n[:, None] for k, i in enumerate(ids)]
                if prob is None:  # start from how often a piece occurs
                    for k, i in enumerate(ids):
                        got += np.bincount(i[inside[k]], np.broadcast_to(w[:, None], i.shape)[inside[k]] * (k + 1), v + 1)
                    continue
                # Logarithms, so sums over words of any length neither vanish nor overflow.
                alpha, beta = _log_forward(ids, prob, len(at), m), _log_backward(ids, prob, n, m)
                for k, i in enumerate(ids):
                    size = k + 1
                    post = np.exp(alpha[: m + 1 - size] + beta[size:] - beta[0]).T * prob[i] * w[:, None]
                    got += np.bincount(i[inside[k]], post[inside[k]], v + 1)
            got[v] = 0
            prob = (got + p.smoothing) / (got[:v].sum() + p.smoothing * v)
            prob[v] = 0
        cols.append(prob)
    return LangModel(langs, np.stack(cols, axis=1), path, p.max_piece)


def _log_forward(ids: list[np.ndarray], prob: np.ndarray, rows: int, m: int) -> np.ndarray:
    """Logarithm of the probability mass of the first j bytes. Every byte is a piece, so no mass is 0."""
    alpha = np.zeros((m + 1, rows))
    for j in range(1, m + 1):
        total = np.zeros(rows)
        for k in range(1, min(j, len(ids)) + 1):
            total += np.exp(alpha[j - k] - alpha[j - 1]) * prob[ids[k - 1][:, j - k]]
        alpha[j] = alpha[j - 1] + np.log(total)
    return alpha


def _log_backward(ids: list[np.ndarray], prob: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
    """Logarithm of the probability mass from byte j to the word's end at n; none past it."""
    beta = np.full((m + 1, len(n)), -np.inf)
    beta[n, np.arange(len(n))] = 0
    for j in range(m - 1, -1, -1):
        r = np.flatnonzero(j < n)
        total = np.zeros(len(r))
        for k in range(1, min(m - j, len(ids)) + 1):
            total += np.exp(beta[j + k, r] - beta[j + 1, r]) * prob[ids[k - 1][r, j]]
        beta[j, r] = beta[j + 1, r] + np.log(total)
    return beta


def fit(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", path: str | None = None, params: LangParams = LangParams()) -> LangModel:
    """Learn from documents outside fold 0. At most ``per_language`` texts of ``max_chars`` come to the driver per language.

    Languages are counted first; the draw then keeps about three times the bound per
    language by a hash of the id, and ranks those few.
    """
    p = params
    src = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.length("text").between(1, p.max_chars) & (crc_mod("id", p.folds) != 0)
    )
    counts = src.groupBy("lang").count()
    h = F.pmod(F.xxhash64(F.lit(23), "id"), F.lit(1 << 30))
    drawn = (
        src.withColumn("h", h)
        .join(F.broadcast(counts), "lang")
        .where(F.col("h") * F.col("count") < F.lit(3.0 * p.per_language * (1 << 30)) + F.col("count"))
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "text")))
        .where(F.col("r") <= p.per_language)
    )
    found: dict[str, Counter] = {}
    for r in drawn.select("lang", "text").toLocalIterator():
        found.setdefault(r.lang, Counter()).update(words(r.text))
    return train({k: c for k, c in found.items() if c}, path or public_tokenizers.path(VOCABULARY), p)


def predict(spark: SparkSession, docs: DataFrame, model: LangModel, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with ``out`` (a learned language, or ``und``) and ``score`` (its probability among the learned) added.

    ``und`` with score 0 for null texts, texts without a letter, and if nothing was learned.
    Equal probabilities go to the first language by name. Input columns with those names are
    replaced. One row in, one row out, no shuffle; whole texts are read.
    """
    keep = [c for c in docs.columns if c not in (out, score)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = src.withColumn(out, F.lit("")).withColumn(score, F.lit(0.0)).schema
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, m = shared.value
        table = kept("langid", key, lambda: WordTable(lambda ws: word_scores(ws, m), max(1, len(m.langs))))
        for b in batches(it, text, 4 << 20):
            texts = texts_of(b, text)
            known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts]) & bool(m.langs)
            if m.langs:
                s = table.sums([words(t) if k else [] for t, k in zip(texts, known)])
                best = s.argmax(axis=1)
                prob = 1 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
                lang = [m.langs[i] if k else "und" for i, k in zip(best, known)]
            else:
                prob, lang = np.zeros(len(texts)), ["und"] * len(texts)
            arrow = pa.schema([*b.schema, pa.field(out, pa.string()), pa.field(score, pa.float64())])
            yield with_columns(b, arrow, **{out: lang, score: np.where(known, prob, 0.0)})

    return src.mapInArrow(run, schema)
