"""Scope of intermediate tables."""

import os

from profilekit.session import scratch, shared_path


def _local(path):
    return path.removeprefix("file:")


def test_scratch_removes_what_its_scope_wrote(spark):
    outside = shared_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch(spark):
        inside, never = shared_path(spark, "gone"), shared_path(spark, "unused")
        spark.range(3).write.parquet(inside)
        with scratch(spark):
            deeper = shared_path(spark, "deeper")
            spark.range(3).write.parquet(deeper)
        assert not os.path.exists(_local(deeper)) and os.path.exists(_local(inside))
    assert not os.path.exists(_local(inside)) and not os.path.exists(_local(never))
    assert os.path.exists(_local(outside)) and spark.read.parquet(outside).count() == 3
