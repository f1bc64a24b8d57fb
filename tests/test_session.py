from ratingstream.session import checkpoint_root, fresh_path, is_complete, path_exists, publish_folder, scratch_path


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "a", "b").startswith(root.rstrip("/") + "/ratingstream/a/b")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_complete_means_success_marker_and_publish_moves_a_folder(spark):
    src, dst = fresh_path(spark, "src"), fresh_path(spark, "dst")
    assert not is_complete(spark, src)
    spark.range(3).write.parquet(src)
    assert is_complete(spark, src)
    publish_folder(spark, src, f"{dst}/day=1")
    assert not path_exists(spark, src) and is_complete(spark, f"{dst}/day=1")
    assert spark.read.parquet(f"{dst}/day=1").count() == 3
