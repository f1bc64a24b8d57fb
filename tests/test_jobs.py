from pyspark.sql import functions as F

from ratingstream.jobs import clusterer_job, publisher_job
from ratingstream.operators import kmeans as km
from ratingstream.operators.parse import accepted, parse_rating
from ratingstream.options import KMeansOptions, PublishOptions, StreamOptions
from ratingstream.session import fresh_path
from ratingstream.sources import fixtures as fx
from ratingstream.plans import model_table as mt

from conftest import SF_SMOKE


def test_publish_then_cluster(spark):
    lines_path = fx.rating_lines_text(spark, SF_SMOKE)
    topic = fresh_path(spark, "topic")
    summary = publisher_job(spark, lines_path, PublishOptions(topic="ratings"), sink="parquet", sink_path=topic)
    n_lines = spark.read.text(lines_path).count()
    assert summary["n_read"] == n_lines and summary["n_rejected"] == 0
    published = spark.read.parquet(topic)
    assert published.count() == n_lines
    assert published.select("offset").distinct().count() == n_lines

    csv = fx.tag_scores_csv(spark, SF_SMOKE)
    dim = fx.embedding_dim(fx.table(spark, SF_SMOKE, "embeddings"))
    out = fresh_path(spark, "clusterer")
    q, paths = clusterer_job(
        spark, csv, out, KMeansOptions(k=4, dim=dim, seed=7), StreamOptions(sample_fraction=0.1),
        source_format="parquet", source_path=topic, available_now=True,
    )
    assert q.exception() is None
    c, w = km.model_arrays(mt.read_batch(spark, paths.state, 0))
    assert c.shape == (4, dim)
    vec_ids = fx.table(spark, SF_SMOKE, "embeddings").select(F.col("vec_id").cast("int").alias("movie_id"))
    good = accepted(parse_rating(published.select(F.col("value"))))
    assert w.sum() == good.join(vec_ids, "movie_id").count()
    assert spark.read.parquet(paths.predictions).count() > 0
    assert spark.read.parquet(f"{out}/tag_score_rejects").count() == 0  # the embedding scores are all valid


def test_properties_file_reader(tmp_path):
    from ratingstream.jobs import _read_properties

    p = tmp_path / "job.conf"
    p.write_text("# comment\nverbose false\n\nkMeans.K  5\nkMeans.DecayFactor=1.0\nkafkaStream.topics  test\n")
    assert _read_properties(str(p)) == {
        "verbose": "false", "kMeans.K": "5", "kMeans.DecayFactor": "1.0", "kafkaStream.topics": "test"
    }


def test_publish_stream_per_file(spark):
    from ratingstream.jobs import publish_stream

    root = fresh_path(spark, "pubstream")
    lines = fx.rating_file_lines(fx.table(spark, SF_SMOKE, "events")).select("value")
    lines.write.text(f"{root}/in/wave=1")
    q = publish_stream(spark, f"{root}/in/*", f"{root}/out", PublishOptions(topic="ratings"), sink="parquet",
                       available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    recs = spark.read.parquet(f"{root}/out/records")
    n = lines.count()
    assert recs.count() == n
    s = spark.read.parquet(f"{root}/out/summary").collect()
    assert sum(r["n_read"] for r in s) == n and sum(r["n_rejected"] for r in s) == 0
