"""Write PLANS.md: the physical plans of the main operators, for review.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ratingstream.operators import kmeans as km  # noqa: E402
from ratingstream.plans import pipeline as pl  # noqa: E402
from ratingstream.plans import queries as bq  # noqa: E402
from ratingstream.session import local_session  # noqa: E402
from ratingstream.sources import fixtures as fx  # noqa: E402
from ratingstream.sources.files import scan_rating_lines, scan_tag_scores  # noqa: E402
from ratingstream.operators.publish import publish_ratings  # noqa: E402

NOTES = {
    "movie vectors (static side)": "partial_max before the first exchange; collect_list after the second; "
    "CSV ReadSchema has the three columns; no Python node.",
    "parse (accepted ratings)": "one scan, narrow projections only; the filter sits in the scan stage.",
    "batch cluster sums": "per-movie partial count → exchange on movie_id → join with the cached, "
    "movie-partitioned vectors (the counts side is the broadcast/build side) → partial sums of exact digits → "
    "exchange of at most K rows per task.",
    "ratings with their cluster": "distinct movies → vectors in place → movie→cluster broadcast back "
    "under the checked bound.",
    "publish records": "one stage: text scan, checks and shaping in whole-stage codegen.",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    vt = bq.vector_table(spark, sf)
    centers = km.model_arrays(bq.start_state(spark, sf))[0]
    good = bq.good_ratings(spark, sf)
    dim = fx.embedding_dim(fx.table(spark, sf, "embeddings"))
    frames = {
        "movie vectors (static side)": pl.movie_vectors(scan_tag_scores(spark, fx.tag_scores_csv(spark, sf)), dim),
        "parse (accepted ratings)": good,
        "batch cluster sums": pl.batch_stats(pl.movie_counts(good), vt, centers),
        "ratings with their cluster": pl.assign_ratings(good, vt, centers),
        "publish records": publish_ratings(scan_rating_lines(spark, fx.rating_lines_text(spark, sf)), "ratings", 2),
    }
    out = ["# Physical plans", "", f"Generated by `tools/plans.py` on `{os.path.basename(sf)}`, "
           "`local[8]`. Long literals (the K centres) are cut.", ""]
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().treeString()
        lines = [ln if len(ln) <= 160 else ln[:157] + "..." for ln in plan.splitlines()]
        out += [f"## {name}", "", NOTES[name], "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
