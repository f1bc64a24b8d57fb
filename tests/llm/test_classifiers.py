import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream.llm import langid, quality, toxicity
from ratingstream.llm.common import crc_mod, labelled_sample
from llm_fixtures import labels, no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.1"


def rates(rows, label):
    """Share of right predictions among rows of label 0 and of label 1."""
    return [np.mean([r.predicted == r[label] for r in rows if r[label] == y]) for y in (0, 1)]


# At sf0.1 the toxic sample is small (360 texts in four languages) and some toxic labels have no toxic word.
@pytest.mark.parametrize("query,label,least", [("op1_quality", "quality", (0.97, 0.97)), ("op9_toxicity", "toxic", (0.97, 0.6))])
def test_query_and_held_out_accuracy(spark, query, label, least):
    from ratingstream.llm.queries import registry

    rows = registry()[query](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    got = rates([r for r in rows if r.held_out], label)
    assert got[0] >= least[0] and got[1] >= least[1], got


def test_sample_is_drawn_among_rows_that_are_there(spark, labels):
    """A stage may see few of the labelled rows; the draw isn't spent on the others."""
    lab = labels([(i, 1, i % 2) for i in range(4000)])
    docs = spark.createDataFrame([(i, f"text {i}" if i % 3 else "x" * 200) for i in range(3900, 4000)], "doc_id long, text string")
    got = labelled_sample(spark, docs, lab, "toxic", "doc_id", "text", 5, 10, 100)
    fit = [i for i in range(3900, 4000) if i % 3 and zlib.crc32(str(i).encode()) % 5]
    assert {y for _, y in got} == {0, 1} and len(got) == 20
    assert {t for t, _ in got} <= {f"text {i}" for i in fit}


def test_language_held_out_accuracy(spark):
    from ratingstream.llm.queries import op6_language_id

    rows = op6_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) >= 0.97


def brute_word(model, word, lang):
    """Sum over all segmentations, byte by byte."""
    pieces = {p: i for i, p in enumerate(langid._pieces(model.path, model.max_piece))}
    s = b" " + word
    mass = [1.0] + [0.0] * len(s)
    for j in range(1, len(s) + 1):
        for k in range(1, min(j, model.max_piece) + 1):
            i = pieces.get(s[j - k : j])
            if i is not None:
                mass[j] += mass[j - k] * model.probs[i, lang]
    return np.log(mass[-1])


@pytest.fixture(scope="module")
def lang_model():
    from collections import Counter

    counts = {
        "en": Counter({b"the": 50, b"thing": 9, b"and": 30, b"other": 7}),
        "fr": Counter({b"le": 40, "été".encode(): 9, b"les": 20, b"autre": 8}),
    }
    import public_tokenizers

    return langid.train(counts, public_tokenizers.path(langid.VOCABULARY), langid.LangParams())


def test_forward_sums_all_segmentations(lang_model):
    words = [b"the", b"x", "été".encode(), *(b"abcdefghij"[: 1 + k % 10] * (1 + k // 4) for k in range(60))]
    got = langid.word_scores(words, lang_model)
    want = np.array([[brute_word(lang_model, w, i) for i in range(2)] for w in words])
    assert np.allclose(got, want, rtol=1e-9)


def test_piece_probabilities_sum_to_one(lang_model):
    assert np.allclose(lang_model.probs.sum(axis=0), 1)


def test_very_long_word_stays_finite(lang_model):
    assert np.isfinite(langid.word_scores([b"q" * 60_000], lang_model)).all()


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = langid.fit(spark, odd_docs)
    rows = langid.predict(spark, odd_docs, model).collect()
    assert len(rows) == 10
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1 and (letters or r.score == 0)
    empty = langid.fit(spark, no_docs)
    assert {r.lang_pred for r in langid.predict(spark, odd_docs, empty).collect()} == {"und"}
    assert langid.predict(spark, no_docs, model).count() == 0


@pytest.mark.parametrize("op,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_odd_rows(spark, odd_docs, no_docs, labels, op, label):
    both = labels([(1, 1, 0), (5, 0, 1), (6, 1, 0), (7, 0, 1), (2, 1, 1), (None, 1, 1), (3, None, None)])
    for lab in (both, both.where(f"{label} = 1"), both.limit(0)):
        model = op.fit(spark, odd_docs, lab)
        rows = op.score(spark, odd_docs, model).collect()
        assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
        assert op.score(spark, no_docs, model).count() == 0
    model = op.fit(spark, no_docs, both)
    assert op.score(spark, odd_docs, model, out="other").select("score", "other").count() == 10


def test_sample_is_bounded_and_leaves_out_the_held_out(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    got = labelled_sample(spark, docs, labels, "quality", "doc_id", "text", 5, 50, 100)
    assert [y for _, y in got] == [0] * 50 + [1] * 50
    ids = [int(t.split()[1]) for t, _ in got]
    assert all(zlib.crc32(str(i).encode()) % 5 for i in ids) and len(set(ids)) == 100


def test_repeats_share_a_bucket():
    words = [b"a", b"bb", b"ccc"]
    rows, buckets = quality.buckets_of(words, (3, 4), 1 << 12)
    # The whole word, " a ", " bb", "bb ", " bb ", " cc", "ccc", "cc ", " ccc", "ccc ".
    assert np.bincount(rows).tolist() == [2, 4, 6]
    assert buckets.min() >= 1
