from pyspark.sql import functions as F

import corpus_pipeline as C
from ratingstream.llm import packing, quality, toxicity
from test_simhash import brute_classes, brute_fingerprint
from test_tokens import check_pieces
from llm_fixtures import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for (name, stage), op in zip(C.STAGES[:2], (quality, toxicity)):
        model = op.fit(spark, docs, labels)
        keep = 1 if name == "quality" else 0
        want = {r.doc_id for r in op.score(spark, docs, model).collect() if r.predicted == keep}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < len(want) < docs.count()
        assert {r.doc_id for r in out.select("doc_id").collect()} == want
    rows = sorted(docs.select("doc_id", "text").collect())
    classes = brute_classes([brute_fingerprint(r.text) for r in rows], 2)
    out = C.near_duplicate_stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [r.doc_id for i, r in enumerate(rows) if classes[i] == i]


def test_run(spark):
    pieces = C.run(spark, SF)
    kept = [r.doc_id for r in pieces.select("doc_id").distinct().collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < len(kept) < docs.count()
    texts = docs.where(docs.doc_id.isin(kept)).select("doc_id", "text").collect()
    check_pieces(texts, pieces.withColumn("ids_crc32", packing.ids_crc32()).collect())


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for _, stage in C.STAGES[:3]:
        out = stage(spark, odd_docs, SF)
        assert out.columns == odd_docs.columns
        out.collect()
        assert stage(spark, no_docs, SF).count() == 0
    deduped = C.near_duplicate_stage(spark, odd_docs, SF).collect()
    # 2, 3, 4 and the row without id and text share fingerprint zero.
    assert sorted(str(r.doc_id) for r in deduped) == ["1", "2", "5", "6", "7", "None"]


TEXT = "one two three four five six seven eight nine ten eleven twelve"


def test_copies_that_share_an_id_or_have_none_go(spark):
    docs = spark.createDataFrame(
        [(1, TEXT), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (5, TEXT), (None, TEXT), (None, TEXT),
         (None, "red orange yellow green blue indigo violet black white grey"),
         (None, "red orange yellow green blue indigo violet black white grey"), (7, TEXT), (1, TEXT)],
        "doc_id long, text string",
    )
    got = sorted((str(r.doc_id), r.text.split()[0]) for r in C.near_duplicate_stage(spark, docs, SF).collect())
    assert got == [("1", "one"), ("5", "alpha"), ("None", "red")]


def test_stages_keep_columns_named_like_their_own(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit("mine") for c in ("predicted", "quality_score", "toxicity_score", "score", "component_id", "key")})
    for _, stage in C.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        for c in ("predicted", "quality_score", "toxicity_score", "score", "component_id", "key"):
            assert out.where(F.col(c) != "mine").count() == 0


def test_run_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
