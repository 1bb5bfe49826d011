"""Cluster sizing and checkpoint-folder helpers."""

from citybeat.session import ensure_checkpoint_dir, scale_settings, scratch_path


def test_scale_settings_for_100_tb():
    conf = scale_settings(100 * 1024**4, executor_cores=8, executor_memory_gb=64)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert 500_000 < parts < 1_000_000  # ~128 MB per shuffle partition before AQE coalescing
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_settings(10 * 1024**3, executor_cores=4, executor_memory_gb=2)
    assert int(small["spark.sql.shuffle.partitions"]) >= 200


def test_scratch_paths_live_in_the_checkpoint_folder(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))
