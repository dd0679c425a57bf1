"""Histories kept in order on disk."""

import pytest
from helpers import at, frame
from test_plans import plan

from citystream.operators import detect, ordered
from citystream.plans.queries import _signal_store
from citystream.session import scratch
from citystream.sources import ordered_store

SF = "/root/testdata/sf0.001"
SCHEMA = "k string, event_time timestamp, seq bigint, v bigint"
ROWS = ([("hot", at(i // 3), i, i % 50) for i in range(2_000)] + [(f"k{i % 7}", at(i), 5_000 + i, i % 50) for i in range(300)]
        + [(None, at(i), 6_000 + i, i % 50) for i in range(20)])
PLACE = (["k"], "event_time", "seq")


def trailing(df):
    return sorted((r.seq, r.last) for r in ordered.trailing_values(df, *PLACE, "v", 4, "last").collect())


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch(spark, "store")
    return path, ordered_store.write(frame(spark, ROWS, SCHEMA).repartition(5), path, *PLACE, buckets=6)


def test_windows_over_a_store_equal_those_over_the_rows(spark, stored):
    assert trailing(stored[1]) == trailing(frame(spark, ROWS, SCHEMA))
    assert stored[1].drop("_slice").exceptAll(frame(spark, ROWS, SCHEMA)).count() == 0 and stored[1].count() == len(ROWS)


def test_a_hot_key_lies_in_several_buckets(stored):
    files = stored[1].where("k = 'hot'").selectExpr("input_file_name() as f").groupBy("f").count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 0.7 * 2_000


def test_another_session_reads_the_same_store(spark, stored):
    path, df = stored
    again = ordered_store.attach(spark.newSession(), path, df.schema, *PLACE, buckets=6)
    assert trailing(again) == trailing(df)
    assert "Exchange" not in plan(again.groupBy("k", "_slice").count())


def test_an_empty_store(spark):
    empty = ordered_store.write(frame(spark, [], SCHEMA), scratch(spark, "store"), *PLACE)
    assert trailing(empty) == []


def test_gridlock_reads_its_store_without_a_shuffle_or_sort(spark):
    """Rows a slice knows all about go through one window on the scan; only those at edges move."""
    seen = detect.consecutive_above(_signal_store(spark, SF), ["junction_id"], "avg_wait_sec", "event_time", "offset", 180, 3)
    text = plan(seen)
    assert text.count("Exchange") == text.count("Sort [") == 1 and text.count("Bucketed: true") == text.count("FileScan") == 2
    below = text.split("Exchange", 1)[1]
    assert "Window" in below and "Sort [" not in below
