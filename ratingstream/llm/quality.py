"""Quality classifier: supervised subword embeddings.

Every word stands for its own hashed bucket and those of its character n-grams (blanks
mark its ends). Of the word bigrams, those that repeat a word share one bucket of their own
(bucket 0), so that runs of any word are learned as such. A document is the mean of its buckets' learned vectors; a softmax layer
gives the class. The vectors and the layer are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled documents.

For scoring, a bucket's vector matters only through its product with the difference of the
two classes' weights, so the trained model is folded to one number per bucket
(``buckets`` floats, a fixed size that is broadcast); that changes no score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordTable, batches, kept, labelled_sample, texts_of, with_columns


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 1 << 18
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 4.0
    #: The bound of the training sample, per class, and the longest text drawn.
    per_class: int = 1200
    max_chars: int = 32_768
    folds: int = 5
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    """``weight[bucket]`` and ``bias``: the log-odds of class 1 is bias + the mean weight of a text's buckets."""

    weight: np.ndarray
    bias: float
    ngrams: tuple[int, ...]


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def buckets_of(words: list[bytes], ngrams: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the words: the whole word and each n-gram of `` word ``."""
    buf = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    blank = np.flatnonzero(buf == 32)
    word_at = np.cumsum(buf == 32) - 1  # the word that follows the last blank
    start, end = blank[:-1] + 1, blank[1:]
    with np.errstate(over="ignore"):
        # Whole words: a polynomial prefix hash over each word's bytes.
        prime = np.uint64(0x100000001B3)
        power = np.full(int((end - start).max()) + 1, prime, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        place = np.arange(len(buf)) - np.concatenate([[0], start])[word_at.clip(0, len(words) - 1) + 1]
        mask = buf != 32
        term = np.where(mask, (buf + np.uint64(1)) * power[place.clip(0, len(power) - 1)], 0)
        whole = np.add.reduceat(term, start) if len(start) else np.zeros(0, np.uint64)
        rows, hashes = [np.arange(len(words))], [whole * np.uint64(31)]
        for n in ngrams:
            if len(buf) < n:
                continue
            h = np.full(len(buf) - n + 1, n, np.uint64)
            for k in range(n):
                h = h * prime + buf[k : len(buf) - n + 1 + k]
            inner = np.zeros(len(h), bool)
            for k in range(1, n - 1):
                inner |= buf[k : len(h) + k] == 32
            # A gram may begin with the blank before its word or end with the one after it.
            at = np.flatnonzero(~inner & (buf[1 : len(h) + 1] != 32))
            rows.append(word_at[at])
            hashes.append(h[at])
        h = np.concatenate(hashes)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.concatenate(rows), (h % np.uint64(buckets - 1)).astype(np.int64) + 1


def train(sample: list[tuple[str, int]], p: QualityParams) -> QualityModel:
    """Fit on (text, label) pairs. With one class only, every score is that class's; with none, 0.5."""
    ys = np.array([y for _, y in sample])
    if len(set(ys.tolist())) < 2:
        share = 0.0 if not len(ys) else (20.0 if ys[0] else -20.0)
        return QualityModel(np.zeros(p.buckets, np.float32), share, p.ngrams)
    docs = []
    for text, y in sample:
        words = split(text)
        if not words:
            continue
        _, b = buckets_of(words, p.ngrams, p.buckets)
        again = sum(a == b for a, b in zip(words, words[1:]))
        ids, n = np.unique(np.concatenate([b, np.zeros(again, np.int64)]), return_counts=True)
        docs.append((ids, (n / n.sum()).astype(np.float32), y))
    rng = np.random.default_rng(p.seed)
    vec = rng.uniform(-1 / p.dim, 1 / p.dim, (p.buckets, p.dim)).astype(np.float32)
    out, bias = np.zeros((p.dim, 2), np.float32), np.zeros(2, np.float32)
    share = np.bincount(ys, minlength=2) / len(ys)
    total, step = p.epochs * len(docs), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(docs)):
            ids, w, y = docs[i]
            rate = p.rate * (1 - step / total)
            hidden = w @ vec[ids]
            z = hidden @ out + bias
            prob = np.exp(z - z.max())
            prob /= prob.sum()
            g = prob
            g[y] -= 1
            g *= 0.5 / share[y]  # both classes weigh the same
            back = out @ g
            out -= 0.1 * rate * np.outer(hidden, g)
            bias -= 0.02 * rate * g
            # Normalised by the sum of squares, so that a long text moves its score as far as a short one.
            vec[ids] -= (rate * w / (w @ w) * min(1.0, 20 * float(w @ w)))[:, None] * back
            step += 1
    weight = vec @ (out[:, 1] - out[:, 0])
    return QualityModel(weight.astype(np.float32), float(bias[1] - bias[0]), p.ngrams)


def score_texts(model: QualityModel, texts: list[str | None], table: WordTable) -> np.ndarray:
    """Class-1 probability per text; a text without words has the bias's."""
    at, sizes = table.lookup([split(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    again = np.bincount(doc[1:][(at[1:] == at[:-1]) & (doc[1:] == doc[:-1])], minlength=len(texts))
    total = np.bincount(doc, table.rows[at, 0], len(texts)) + again * float(model.weight[0])
    n = np.bincount(doc, table.rows[at, 1], len(texts)) + again
    z = model.bias + total / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def word_table(model: QualityModel) -> WordTable:
    def score(words: list[bytes]) -> np.ndarray:
        out = np.empty((len(words), 2))
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            row, b = buckets_of(part, model.ngrams, len(model.weight))
            out[i : i + 50_000, 0] = np.bincount(row, model.weight[b], len(part))
            out[i : i + 50_000, 1] = np.bincount(row, minlength=len(part))
        return out

    return WordTable(score, 2)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", params: QualityParams = QualityParams()) -> QualityModel:
    p = params
    return train(labelled_sample(spark, docs, labels, label, id_col, text, p.folds, p.per_class, p.max_chars), p)


def score(spark: SparkSession, docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score", threshold: float = 0.3, predicted: str = "predicted") -> DataFrame:
    """``docs`` with ``out`` (double, 0 to 1) and ``predicted`` (1 if ``out`` >= threshold; the argument names the column) added.

    Whole texts are read. Null and empty texts get the model's bias. Columns of the input with
    those names are replaced; one row in, one row out, no shuffle.
    """
    keep = [c for c in docs.columns if c not in (out, predicted)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = src.withColumn(out, F.lit(0.0)).withColumn(predicted, F.lit(0)).schema
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, m = shared.value
        words = kept("quality", key, lambda: word_table(m))
        for b in batches(it, text, 4 << 20):
            s = score_texts(m, texts_of(b, text), words)
            arrow = pa.schema([*b.schema, pa.field(out, pa.float64()), pa.field(predicted, pa.int32())])
            yield with_columns(b, arrow, **{out: s, predicted: (s >= threshold).astype(np.int32)})

    return src.mapInArrow(run, schema)
