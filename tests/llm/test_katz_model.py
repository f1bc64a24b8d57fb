import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratingstream.llm import katz_model as M
from ratingstream.llm.common import words_of
from ratingstream.llm.katz import discounts
from llm_fixtures import no_docs, odd_docs  # noqa: F401


class Brute:
    """The same model from whole counts in memory, evaluated by plain recursion."""

    def __init__(self, texts, order, k=5, tail=0.1):
        self.order, self.k, self.tail = order, k, tail
        self.n = Counter(g[-m:] for t in texts for g in self.tokens(t) for m in range(1, order + 1))
        self.after = defaultdict(list)
        for g in self.n:
            self.after[g[:-1]].append(g)
        self.total = {c: sum(self.n[g] for g in gs) for c, gs in self.after.items()}
        self.d = {}
        for m in range(1, order + 1):
            of = Counter(x for g, x in self.n.items() if len(g) == m)
            self.d[m] = discounts(np.array([of[r] for r in range(1, k + 2)]), k)

    def tokens(self, text):
        """Each token with the ``order - 1`` before it."""
        t = [b""] * (self.order - 1) + [*words_of(text), b""]
        return [tuple(t[i : i + self.order]) for i in range(len(t) - self.order + 1)]

    def disc(self, g):
        x = self.n[g]
        return x * self.d[len(g)][x - 1] if x <= self.k else x - self.tail

    def left(self, c):
        return 1 - sum(map(self.disc, self.after[c])) / self.total[c]

    def prob(self, g):
        if g in self.n:
            return self.disc(g) / self.total[g[:-1]]
        c = g[:-1]
        if not c:
            return self.left(()) if () in self.after else 1.0
        return self.alpha(c) * self.prob(g[1:])

    def alpha(self, c):
        if c not in self.after:
            return 1.0
        return self.left(c) / (1 - sum(self.prob(g[1:]) for g in self.after[c]))

    def score(self, text):
        return sum(math.log10(self.prob(g)) for g in self.tokens(text))


@pytest.mark.parametrize("order", [1, 3])
def test_held_out_and_learned_texts_equal_brute_force(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {i: t for i, t in docs.collect()}
    held = [i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2]
    model = M.fit(spark, docs.where(~docs.doc_id.isin(held)), order=order, parts=5, block_bytes=20_000)
    brute = Brute([t for i, t in texts.items() if i not in set(held)], order)
    rows = M.evaluate(spark, docs, M.load(spark, model.path)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.n_tokens == len(words_of(texts[r.doc_id])) + 1
        assert math.isclose(r.score, brute.score(texts[r.doc_id]), rel_tol=1e-8)


def test_stored_contexts_sum_to_one(spark):
    """From the stored tables alone: a context's seen words and what it backs off with make one."""
    docs = spark.createDataFrame([(t,) for t in ["a b c a b", "a b d", "b b b c", "a a a a a a a a a b", "", "the a the b the c"] * 2], "text string")
    model = M.fit(spark, docs, order=3, parts=3)
    p = {(m, r.c, r.w): 10**r.logp for m in (1, 2, 3) for r in model.grams(spark, m).collect()}
    shorter = {(m, r.c): r.shorter for m in (2, 3) for r in model.grams(spark, m).select("c", "shorter").distinct().collect()}
    alpha = {(m, r.c): 10**r.alpha for m in (2, 3) for r in model.backoff(spark, m).collect()}
    words = {w for m, _, w in p if m == 1}
    empty = next(c for m, c, _ in p if m == 1)

    def prob(m, c, w):
        if (m, c, w) in p:
            return p[m, c, w]
        return alpha[m, c] * prob(m - 1, shorter[m, c], w) if m > 1 else model.unknown

    assert math.isclose(sum(prob(1, empty, w) for w in [*words, None]), 1, rel_tol=1e-9)
    for m, c in shorter:
        assert math.isclose(sum(prob(m, c, w) for w in [*words, None]), 1, rel_tol=1e-9)


def test_a_hot_context_lies_in_several_files_of_its_part(spark):
    texts = [" ".join(f"the w{(i * 7 + j) % 50}" for j in range(30)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = M.fit(spark, docs.where("doc_id % 4 <> 0"), order=2, parts=2, block_bytes=500)
    brute = Brute([t for i, t in enumerate(texts) if i % 4], 2)
    rows = M.evaluate(spark, docs, model).collect()
    assert len(rows) == 40 and all(math.isclose(r.score, brute.score(texts[r.doc_id]), rel_tol=1e-9) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    model = M.fit(spark, odd_docs, order=3, parts=2)
    rows = M.evaluate(spark, odd_docs, model).collect()
    assert len(rows) == 10 and all(np.isfinite(r.score) for r in rows)
    assert M.evaluate(spark, no_docs, model).count() == 0
    untrained = M.evaluate(spark, odd_docs, M.fit(spark, no_docs, order=2, parts=2))
    assert untrained.count() == 10 and untrained.where("score <> 0").count() == 0
    with pytest.raises(ValueError):
        M.fit(spark, odd_docs, order=8)
