import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream.llm import katz as K
from ratingstream.llm.common import words_of
from llm_fixtures import no_docs, odd_docs  # noqa: F401


class Brute:
    """The same model from whole counts in memory."""

    def __init__(self, texts, k=5, tail=0.1):
        toks = [[*words_of(t), b""] for t in texts]
        self.k, self.tail = k, tail
        self.c = Counter(w for t in toks for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter(p for t in toks for p in zip([b"", *t], t))
        of = lambda counts: np.bincount(np.minimum([*counts.values(), 0], k + 2), minlength=k + 3)[1 : k + 2]
        self.d1, self.d2 = K.discounts(of(self.c), k), K.discounts(of(self.pairs), k)
        self.unknown = 1 - sum(self.disc(x, self.d1) for x in self.c.values()) / self.n if self.n else 1.0
        self.after = defaultdict(list)
        for (v, w), x in self.pairs.items():
            self.after[v].append((w, x))

    def disc(self, x, d):
        return x * d[x - 1] if x <= self.k else x - self.tail

    def uni(self, w):
        return self.disc(self.c[w], self.d1) / self.n if self.c[w] else self.unknown

    def alpha(self, v):
        f = self.after.get(v)
        if not f:
            return 1.0
        return (1 - sum(self.disc(x, self.d2) for _, x in f) / self.c[v]) / (1 - sum(self.uni(w) for w, _ in f))

    def prob(self, v, w):
        x = self.pairs[v, w]
        return self.disc(x, self.d2) / self.c[v] if x else self.alpha(v) * self.uni(w)

    def score(self, text):
        t = [*words_of(text), b""]
        return sum(math.log10(self.prob(v, w)) for v, w in zip([b"", *t], t))


SMALL = K.KatzParams(block_bytes=2000, part_words=300, part_pairs=500)


@pytest.mark.parametrize("params", [K.KatzParams(), SMALL])
def test_scores_equal_brute_force(spark, params):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = dict(docs.collect())
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    model = Brute([t for i, t in texts.items() if i not in held])
    rows = K.score(spark, docs, K.trained_on("doc_id", 7, 2), params=params).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        t = [*words_of(texts[r.doc_id]), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(model.c[w] > 0 for w in t), model.n)
        assert math.isclose(r.base_score, sum(math.log10((model.c[w] + 1) / (model.n + model.v + 1)) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, model.score(texts[r.doc_id]), rel_tol=1e-9)
    assert sum(r.score for r in rows if r.doc_id in held) > sum(r.base_score for r in rows if r.doc_id in held)


def test_every_context_sums_to_one():
    model = Brute(["a b c a b", "a b d", "b b b c", "a a a a a a a a a b", ""] * 2)
    for v in model.c:
        assert math.isclose(sum(model.prob(v, w) for w in model.c) + model.alpha(v) * model.unknown, 1, rel_tol=1e-12)
    assert math.isclose(sum(map(model.uni, model.c)) + model.unknown, 1)


def test_a_hot_context_dealt_out_by_pair(spark, monkeypatch):
    """A context that holds most tokens gives the same scores when its pairs lie in many parts."""
    texts = [" ".join(f"the w{(i * 7 + j) % 50}" for j in range(30)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    real = K._deal_pairs
    monkeypatch.setattr(K, "_deal_pairs", lambda uni, first, parts, hot: real(uni, first, parts, 5))
    count = K._count_pairs
    monkeypatch.setattr(K, "_count_pairs", lambda uni, k, tail, hot: count(uni, k, tail, 5))
    rows = K.score(spark, docs, F.col("doc_id") % 4 != 0, params=SMALL).collect()
    model = Brute([t for i, t in enumerate(texts) if i % 4])
    assert all(math.isclose(r.score, model.score(texts[r.doc_id]), rel_tol=1e-9) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = K.score(spark, odd_docs, K.trained_on("doc_id", 7, 2)).collect()
    assert len(rows) == 10 and all(np.isfinite(r.score) for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (2, 3, 4))
    assert K.score(spark, no_docs, F.lit(True)).count() == 0
    untrained = K.score(spark, odd_docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.score == 0 and r.n_known == 0 for r in untrained)


def test_frozen_arrays_come_back():
    arrays = {"a": np.arange(5, dtype=np.uint64) << 40, "b": np.zeros(0, np.uint16), "c": np.array([1.5, -2.0])}
    back = K.thaw(K.freeze(**arrays))
    assert all((back[n] == a).all() and back[n].dtype == a.dtype for n, a in arrays.items())
