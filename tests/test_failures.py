"""Task failures: a fold whose input tasks fail on their first attempt gives the same model.

Runs in its own process, since the retry count is fixed when a context starts
(``local[N,F]``: N threads, F attempts per task).
"""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    import numpy as np
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from ratingstream.session import local_session
    from ratingstream.operators import kmeans as km
    from ratingstream.plans import pipeline as pl
    from ratingstream.plans import queries as bq
    from ratingstream.sources import fixtures as fx

    spark = local_session("4,4")
    sf = "/root/testdata/sf0.001"
    vt = bq.vector_table(spark, sf)
    state0 = bq.start_state(spark, sf)
    good = bq.good_ratings(spark, sf).withColumn("day", fx.epoch_day("timestamp"))

    @F.udf("boolean")
    def first_attempt_fails(x):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0:
            raise RuntimeError("simulated loss of the task's executor")
        return True

    flaky = good.where(first_attempt_fails(F.col("msg_id")))
    a = km.model_arrays(km.latest_model(pl.fold_batches(spark, good, "day", vt, state0)).drop("batch_id"))
    b = km.model_arrays(km.latest_model(pl.fold_batches(spark, flaky, "day", vt, state0)).drop("batch_id"))
    np.testing.assert_array_equal(a[0], b[0])
    np.testing.assert_array_equal(a[1], b[1])
    print("SAME")
    """
)


def test_fold_survives_failed_tasks():
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT)], capture_output=True, text=True, timeout=600
    )
    assert "SAME" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
    assert "simulated loss" in out.stderr  # the failures did happen and were retried
