import hashlib
import random
import re

import numpy as np
import pytest

from ratingstream.llm import decontaminate as D
from ratingstream.llm.queries import op12_decontaminate
from llm_fixtures import no_docs, odd_docs  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    """(number of words, hit word places, names of the items that occur)."""
    ws, hit, names = brute_words(text), set(), set()
    for name, t in items:
        iw = brute_words(t)
        w = min(window, len(iw))
        for o in range(len(iw) - w + 1 if w else 0):
            for p in range(len(ws) - w + 1):
                if ws[p : p + w] == iw[o : o + w]:
                    hit.update(range(p, p + w))
                    names.add(name)
    return len(ws), hit, names


def random_case(r, window):
    vocabulary = ["a", "b", "c", "d", "é", "Zz", "9"][: r.randint(2, 7)]
    text = lambda n: r.choice([" ", "-", ". "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(str(r.randint(0, 4)), text(r.randint(0, 9))) for _ in range(r.randint(0, 5))] + [(None, text(4))] * r.randint(0, 1)
    return [text(r.randint(0, 40)) for _ in range(r.randint(1, 6))], items


@pytest.mark.parametrize("shard", [1 << 22, 7])
def test_hits_against_brute_force(monkeypatch, shard):
    monkeypatch.setattr(D, "SHARD", shard)
    monkeypatch.setattr(D, "CHUNK", shard)
    r = random.Random(shard)
    for _ in range(400):
        window = r.randint(1, 6)
        texts, items = random_case(r, window)
        t = D.tests_of(items, window)
        for group in ([texts] if shard > 100 else [[x] for x in texts]):
            n, spans, names = D.hits(group, t)
            for x, k, s, got in zip(group, n, spans, names):
                want = brute(x, items, window)
                places = [p for a, b in s.tolist() for p in range(a, b)]
                assert (k, places, set(got)) == (want[0], sorted(want[1]), want[2])
                assert all(b < a2 for (_, b), (a2, _) in zip(s.tolist(), s.tolist()[1:]))


def test_suffix_array_is_sorted():
    r = np.random.default_rng(4)
    for _ in range(50):
        ids = r.integers(0, 4, r.integers(1, 200)).astype(np.int32)

        def key(p, depth=12):
            out = []
            for x in ids[p : p + depth].tolist():
                if not x:
                    break
                out.append(x)
            return out

        sa = D.suffix_array(ids, 12).tolist()
        assert sorted(sa) == np.flatnonzero(ids).tolist()
        assert [key(p) for p in sa] == sorted(key(p) for p in sa)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_scan_in_one_block_and_in_many(spark, block_bytes):
    r = random.Random(11)
    texts, items = [], []
    for _ in range(4):
        t, i = random_case(r, 3)
        texts += t
        items += i
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = rows(D.scan(spark, docs, bench, window=3, block_bytes=block_bytes))
    dirty = set()
    for i, x in enumerate(texts):
        n, hit, names = brute(x, items, 3)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, len(hit), len(names), bool(hit))
        assert got[i]["items"] == sorted(names - {None})
        assert sorted(hit) == [p for s in got[i].spans for p in range(s.start, s.end)]
        dirty |= {i} if hit else set()
    assert dirty
    left = D.remove(spark, docs, bench, window=3, block_bytes=block_bytes)
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(i, x) for i, x in enumerate(texts) if i not in dirty}


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "x one two three four five y"), (2, "two three four"), (3, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "zero one two three four five six"), (8, "four five y")], "item_id long, text string")
    got = {tuple(r) for r in D.matches(spark, docs.coalesce(1), bench, window=3).collect()}
    # The suffix "one two ..." is longest in document 1 (five words), "four five y" too.
    assert got == {(1, 1, "7", 1, 5), (1, 4, "8", 0, 3)}


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "THE same-text twice"), (2, None), (3, ""), (None, "été à l'école"), (1, "word word"), (None, None)], "item_id long, text string")
    got = D.scan(spark, odd_docs, bench, window=3).orderBy("doc_id").collect()
    assert len(got) == 10 and "score" in got[0].__fields__
    by = {r.doc_id: r for r in got}
    assert (by[1].n_hit, by[1]["items"]) == (4, ["1"]) and sum(r.doc_id == 1 for r in got) == 2
    assert (by[5].n_words, by[5].n_hit, by[5]["items"]) == (30_001, 30_000, ["1"])
    assert (by[6].n_items, by[6]["items"], by[6].contaminated) == (1, [], True)
    assert [by[i].n_words for i in (2, 3, 4)] == [0, 0, 0]
    assert D.scan(spark, no_docs, bench).count() == 0 and D.remove(spark, no_docs, bench).count() == 0
    clean = D.scan(spark, odd_docs, bench.limit(0)).collect()
    assert len(clean) == 10 and not any(r.contaminated for r in clean)
    assert D.remove(spark, odd_docs, bench, window=3).columns == odd_docs.columns
    assert D.matches(spark, odd_docs, bench.limit(0)).count() == 0
    # Columns named like the new ones are replaced.
    odd = odd_docs.withColumnRenamed("score", "spans").withColumnRenamed("fp", "n_hit")
    assert D.scan(spark, odd, bench).columns.count("spans") == 1


def test_query_digest(spark):
    got = rows(op12_decontaminate(spark, "/root/testdata/sf0.001"))
    none = hashlib.sha256(b"").hexdigest()
    assert all((r.items_sha256 == none) == (r.n_items == 0) == (not r.contaminated) for r in got.values())
    assert any(r.contaminated for r in got.values())
