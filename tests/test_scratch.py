"""Scratch tables: paths of their own, and their clean-up."""

from __future__ import annotations

import os

from cinesift import drop_scratch, materialize, scratch_mark, scratch_path


def _local(path: str) -> str:
    return path.removeprefix("file:")


def test_only_tables_since_the_mark_go(spark):
    old = materialize(spark.range(3).toDF("x"), "kept/old")
    mark = scratch_mark(spark)
    kept = scratch_path(spark, "kept")
    spark.range(4).write.parquet(kept)
    gone = scratch_path(spark, "gone")
    spark.range(5).write.parquet(gone)
    empty = scratch_path(spark, "never/written")
    assert len({kept, gone, empty}) == 3
    assert drop_scratch(spark, mark, keep=(kept,)) == 2
    assert not os.path.exists(os.path.dirname(_local(gone)))
    assert old.count() == 3 and spark.read.parquet(kept).count() == 4
    assert drop_scratch(spark, mark, keep=(kept,)) == 0
    assert drop_scratch(spark, mark) == 1 and not os.path.exists(_local(kept)) and old.count() == 3
