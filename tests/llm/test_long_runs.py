"""Language identification learns from runs of letters of any length."""

import random
from collections import Counter

import numpy as np
import public_tokenizers

from ratingstream.llm import langid


def brute_counts(word, index, prob, max_piece):
    """Expected piece counts of one word, by sums of plain logarithms."""
    s = b" " + word
    x = np.frombuffer(s, np.uint8).reshape(1, -1).astype(np.uint64)
    ids = [index.find(h)[0] for h in langid._hashes(x, max_piece)]
    m = len(s)
    with np.errstate(divide="ignore"):
        log = np.log(prob)
    a, b = [0.0] + [-np.inf] * m, [-np.inf] * m + [0.0]
    for j in range(1, m + 1):
        a[j] = np.logaddexp.reduce([a[j - k] + log[ids[k - 1][j - k]] for k in range(1, min(j, max_piece) + 1)])
    for j in range(m - 1, -1, -1):
        b[j] = np.logaddexp.reduce([b[j + k] + log[ids[k - 1][j]] for k in range(1, min(m - j, max_piece) + 1)])
    got = np.zeros(len(prob))
    for k in range(1, max_piece + 1):
        for i in range(m - k + 1):
            got[ids[k - 1][i]] += np.exp(a[i] + log[ids[k - 1][i]] + b[i + k] - a[m])
    return got


def test_a_long_run_takes_part_in_training():
    path, p = public_tokenizers.path(langid.VOCABULARY), langid.LangParams()
    word = "日本語の文章".encode() * 17 + b"abc"
    one = langid.train({"ja": Counter({word: 3})}, path, langid.LangParams(rounds=1)).probs[:, 0]
    two = langid.train({"ja": Counter({word: 3})}, path, langid.LangParams(rounds=2)).probs[:, 0]
    want = 3 * brute_counts(word, langid._index(path, p.max_piece), one, p.max_piece)
    want[-1] = 0
    v = len(want) - 1
    want = (want + p.smoothing) / (want.sum() + p.smoothing * v)
    assert np.allclose(two[:v], want[:v], rtol=1e-6)


def test_one_long_run_does_not_undo_its_language():
    r = random.Random(3)
    ws = {"".join(r.choice("bcdfgl") + r.choice("aeio") for _ in range(3)).encode() for _ in range(900)}
    plain = Counter({w: 5 for w in sorted(ws)[:800]})
    path = public_tokenizers.path(langid.VOCABULARY)
    model = langid.train({"a": plain, "b": plain + Counter({b"z" * 300: 1})}, path, langid.LangParams())
    s = langid.word_scores(sorted(plain), model)
    assert np.abs(s[:, 0] - s[:, 1]).max() < 0.5
