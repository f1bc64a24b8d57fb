import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratingstream.llm import spelling as S
from ratingstream.llm.queries import op11_spelling_variants
from llm_fixtures import broadcast_steps, no_docs, odd_docs  # noqa: F401

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(docs):
    n = Counter()
    for i, text in docs:
        for w in RUN.findall(text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(docs):
    """Near words through common one-letter gaps (a gap is a position and the word without it) and deletions."""
    n = brute_counts(docs)
    gaps = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[i, w[:i] + w[i + 1 :]].add(w)
    near = {w: set() for w in n}
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in near:
                near[w].add(short)
                near[short].add(w)
    out = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        out[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while out[root]:
            root = out[root]
        rows.add((w, out[w], root, n[w], len(near[w]), n[out[w]] if out[w] else None))
    return rows


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("size", [3, 8, S.FULL])
@pytest.mark.parametrize("length", [1, 2, 5, 9])
def test_neighbourhoods_are_full_and_distinct(size, length):
    r = np.random.default_rng(size * 100 + length)
    reducer = S.Reducer({m: size for m in range(20)})
    codes = r.integers(0, 90, (20, length))
    codes[0] = codes[0, 0]  # one letter throughout
    got = defaultdict(list)
    for row, key in reducer.neighbours(codes, block=30):
        for i, k in zip(row.tolist(), key.tolist()):
            got[i].append(k)
    table = S.symbols(size)
    letter = {int(s): int(np.flatnonzero(table == s)[0]) for s in np.unique(table)}  # a letter that stands for the symbol
    for i, word in enumerate(codes.tolist()):
        x = [int(table[c]) for c in word]
        want = {tuple(x)}
        for k in range(length + 1):
            for s in range(1, size + 1):
                want.add(tuple(x[:k] + [s] + x[k:]))
                if k < length:
                    want.add(tuple(x[:k] + [s] + x[k + 1 :]))
            if k < length and length > 1:
                want.add(tuple(x[:k] + x[k + 1 :]))
        if set(range(1, size + 1)) == set(letter):
            keys = {int(reducer.key(np.array([[letter[s] for s in w]]))[0]) for w in want}
            assert set(got[i]) == keys
        assert len(got[i]) == len(set(got[i])) == len(want)


def random_docs(r, n, vocabulary):
    return [(r.choice([None, *range(50)]), " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("hot", [64, 2, 0])
def test_variants_against_brute_force(spark, hot):
    r = random.Random(hot)
    base = ["".join(r.choice("abé") for _ in range(r.randint(4, 7))) for _ in range(40)] + ["Strasse", "STRASSE", "Straße", "naïve", "naive", "aaaaaa", "aaaaa"]
    docs = random_docs(r, 80, base)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(S.variants(spark, df, hot=hot)) == brute(docs)


def test_chains_lead_to_the_last_form(spark):
    docs = [(i, " ".join(["abcdef"] * 1 + ["abcdeg"] * 2 + ["abcdhg"] * 5 + ["abckhg"] * 12 + ["alckhg"] * 30)) for i in range(3)]
    got = {w: (f, root) for w, f, root, *_ in result(S.variants(spark, spark.createDataFrame(docs, "doc_id long, text string"), every=10**10))}
    assert got["abcdef"] == ("abcdeg", "alckhg") and got["abckhg"] == ("alckhg", "alckhg") and got["alckhg"] == (None, "alckhg")


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op11_spelling_variants(spark, sf)) == brute(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()] * 3
    assert result(S.variants(spark, odd_docs.union(odd_docs).union(odd_docs))) == brute(docs)
    assert S.variants(spark, no_docs).collect() == []


def test_very_long_runs(spark):
    a = "ab" * 20_000
    docs = [(k, f"{a} {a}x {a[:9999]}é{a[9999:]} {a[:500]}z{a[501:]}") for k in range(3)]
    assert result(S.variants(spark, spark.createDataFrame(docs, "doc_id long, text string"))) == brute_long(docs)


def brute_long(docs):
    """For a few long words: prefixes and suffixes tell pairs that are one edit apart."""
    n = brute_counts(docs)

    def one_edit(x, y):
        if x == y or abs(len(x) - len(y)) > 1:
            return False
        i = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return x[i + (len(x) >= len(y)) :] == y[i + (len(y) >= len(x)) :]

    near = {w: {v for v in n if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    assert all(form[f] is None for f in form.values() if f)
    return {(w, f, f or w, n[w], len(near[w]), n[f] if f else None) for w, f in form.items()}


def test_looked_up_words_are_not_broadcast(spark):
    """A word has a hundred reduced neighbours and more: small by Spark's reckoning, not in the driver's memory."""
    words = [("a" * 4 + chr(97 + i) + chr(97 + j), 3) for i in range(26) for j in range(26)]
    words = S.written(spark, spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(words)], "id long, word string, n long"), "words")
    pairs = S.near_pairs(spark, words, hot=1)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("MapInArrow") >= 3  # the crowd's join is there too
    # Words stored under their own key are one row each: those Spark may broadcast, as it sizes them right.
    assert not [x for x in broadcast_steps(pairs) if x.startswith("MapInArrow") and "u_mask" in x]
