import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ratingstream.session import checkpoint_root, local_session

    s = local_session(4)
    checkpoint_root(s)  # tests pick their own folder when the session names none
    yield s
    s.stop()
