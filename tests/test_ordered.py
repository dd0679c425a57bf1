import numpy as np
import pytest
from helpers import T0, at, frame
from pyspark.sql import functions as F

from citystream.functions.times import epoch_ms
from citystream.operators.ordered import in_slices, neighbour_positions, run_starts, trailing_values

SCHEMA = "k string, event_time timestamp, seq bigint, v int"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    keys = ["hot" if r < 0.6 else f"k{int(r * 10)}" for r in rng.random(600)]
    times = np.cumsum(rng.choice([0, 400, 3_000, 20_000], 600, p=[.2, .5, .2, .1]))
    rows = [(k, at(int(t) / 1000), i, int(v)) for i, (k, t, v) in enumerate(zip(keys, times, rng.integers(0, 50, 600)))]
    per_key = {}
    for k, t, seq, v in rows:
        per_key.setdefault(k, []).append((t, seq, v))
    return frame(spark, rows, SCHEMA).cache(), per_key


@pytest.mark.parametrize("slice_ms", [1, 60_000, 10**9, None])
@pytest.mark.parametrize("n", [1, 3])
def test_trailing_values(data, slice_ms, n):
    df, per_key = data
    got = {r.seq: r.last for r in
           trailing_values(df, ["k"], "event_time", "seq", "v", n, "last", slice_ms).collect()}
    want = {rows[i][1]: [v for _, _, v in rows[max(0, i - n + 1):i + 1]]
            for rows in per_key.values() for i in range(len(rows))}
    assert got == want


@pytest.mark.parametrize("slice_ms", [1, 60_000, 10**9, None])
def test_neighbours(data, slice_ms):
    df, per_key = data
    found = neighbour_positions(df, ["k"], "event_time", "seq", "b", "a", slice_ms).select("seq", "b.seq", "a.seq")
    got = sorted(tuple(r) for r in found.collect())
    want = sorted((rows[i][1], rows[i - 1][1] if i else None, rows[i + 1][1] if i + 1 < len(rows) else None)
                  for rows in per_key.values() for i in range(len(rows)))
    assert got == want


@pytest.mark.parametrize("slice_ms", [1, 60_000, 10**9, None])
def test_run_starts(spark, data, slice_ms):
    """Some links are missing and some point past a neighbour; both begin a new run."""
    _, per_key = data
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for k, entries in per_key.items():
        start = None
        for i, (t, seq, _) in enumerate(entries):
            kind = rng.random()
            back = 1 if kind < 0.9 else 2
            link = entries[i - back] if i >= back and kind < 0.97 else None
            if back == 2 or link is None:
                start = t
            want[seq] = round((start - T0).total_seconds() * 1000)
            rows.append((k, t, seq, link[:2] if link else None))
    df = frame(spark, rows, "k string, event_time timestamp, seq bigint, p struct<ts: timestamp, seq: bigint>")
    base = epoch_ms(F.lit(at(0)))
    found = run_starts(df, ["k"], "event_time", "seq", "p", "start", slice_ms)
    assert {r.seq: r.since for r in found.select("seq", (F.col("start") - base).alias("since")).collect()} == want


def test_slices_split_a_hot_key_by_rows(spark):
    """One key owns nine tenths of the rows, half of them evenly spaced, half in one burst with ties."""
    even, burst = [i * 1_000 for i in range(1_800)], [5_000_000 + i // 40 for i in range(1_800)]
    rows = [("hot", at(t / 1000), i, 0) for i, t in enumerate(even + burst)]
    rows += [(f"k{i % 9}", at(i), 10_000 + i, 0) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = in_slices(frame(spark, rows, SCHEMA).repartition(4), ["k"], "event_time", "seq")
        counts = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(counts) == 4_000 and max(counts) < 2.5 * 4_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_epoch_ms_floors(spark):
    assert frame(spark, [(at(1.9996),)], "t timestamp").select(epoch_ms(F.col("t")) % 1000).first()[0] == 999
