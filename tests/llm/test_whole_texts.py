"""No part of a text is left out: long runs of letters are judged whole."""

import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import pytest

from ratingstream.llm import toxicity

PLAIN, TOXIC = range(0x4E00, 0x4E00 + 300), ("毒害者人", "恶鬼滚出")


def paragraph(r, toxic=None, at=60, size=90):
    """Chinese-looking letters without a blank; a toxic word, if any, after ``at`` characters."""
    cs = "".join(chr(r.choice(PLAIN)) for _ in range(size))
    return cs[:at] + (toxic or "") + cs[at:]


@pytest.fixture(scope="module")
def toxic_model():
    r = random.Random(5)
    sample = [(paragraph(r), 0) for _ in range(400)]
    sample += [(paragraph(r, r.choice(TOXIC), r.randrange(90)), 1) for _ in range(400)]
    return toxicity.train(sample, toxicity.ToxicityParams())


def test_windows_cover_the_whole_run():
    r = random.Random(1)
    for n in (1, 63, 64, 65, 96, 97, 128, 1000):
        run = bytes(r.randrange(97, 123) for _ in range(n))
        ws = toxicity.windows(run.decode())
        assert max(map(len, ws)) <= 64
        assert all(any(run[i : i + 32] in w for w in ws) for i in range(n))
    assert toxicity.windows("a\u00a0b\u2014c\u3002d\u2009e \u00abf\u00bb") == [b"a", b"b", b"c", b"d", b"e", b"f"]


def test_toxic_word_late_in_a_long_run(toxic_model):
    r = random.Random(9)
    texts = [paragraph(r, t, at) for t in TOXIC for at in (30, 50, 70, 90) for _ in range(5)]
    ordinary = [paragraph(r) for _ in range(40)]
    table = toxicity.word_table(toxic_model)
    assert np.mean(toxicity.score_texts(toxic_model, texts, table) >= 0.5) >= 0.75
    assert np.mean(toxicity.score_texts(toxic_model, ordinary, table) >= 0.5) <= 0.2


def dictionaries() -> str:
    r = random.Random(5)
    sample = [(paragraph(r), 0) for _ in range(120)] + [(paragraph(r, r.choice(TOXIC), r.randrange(90)), 1) for _ in range(120)]
    m = toxicity.train(sample, toxicity.ToxicityParams())
    return hashlib.sha256(m.toxic + m.ordinary + m.weights.tobytes()).hexdigest()


def test_training_does_not_depend_on_the_hash_seed():
    code = "import test_whole_texts as t; print(t.dictionaries())"
    here, root = os.path.dirname(__file__), os.path.dirname(os.path.dirname(os.path.dirname(__file__)))
    got = set()
    for seed in range(5):
        env = os.environ | {"PYTHONHASHSEED": str(seed), "PYTHONPATH": os.pathsep.join([here, root])}
        got.add(subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout)
    assert len(got) == 1
