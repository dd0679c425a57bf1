"""Scratch tables and their removal."""

import threading

import pytest

from citystream.session import cut, removed_after, scratch
from citystream.sources import files


def test_tables_made_inside_go_and_others_stay(spark):
    outside, kept = scratch(spark, "outside"), scratch(spark, "kept")
    with removed_after(spark):
        inner = cut(spark.range(5))
        with removed_after(spark):
            innermost = scratch(spark, "innermost")
            cut(inner, innermost)
        assert inner.count() == 5 and not files.exists(spark, innermost)
        result = cut(inner.where("id > 1"), kept)
        spark.range(1).write.parquet(outside)
        path = inner.inputFiles()[0].rsplit("/", 1)[0]
    assert result.count() == 3 and files.exists(spark, outside) and not files.exists(spark, path)


def test_tables_go_after_an_error_too_and_unwritten_paths_do_no_harm(spark):
    with pytest.raises(ValueError, match="stop"), removed_after(spark):
        scratch(spark, "never-written")
        path = scratch(spark, "written")
        cut(spark.range(2), path)
        raise ValueError("stop")
    assert not files.exists(spark, path)


def test_paths_of_another_thread_are_left_alone(spark):
    made = []
    with removed_after(spark):
        other = threading.Thread(target=lambda: made.append(cut(spark.range(3))))
        other.start()
        other.join()
    assert made[0].count() == 3
