"""Session helpers: partition sizing and the shared checkpoint folder."""

from __future__ import annotations

from touchline.session import ensure_checkpoint_dir, scratch_path, sizing_conf


def test_sizing_grows_with_input():
    small = sizing_conf(10**9)
    big = sizing_conf(100 * 10**12)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 * 1024 * 1024))
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) > int(
        big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    )


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))
