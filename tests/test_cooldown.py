import numpy as np
import pandas as pd
import pytest
from helpers import at, frame, thin
from hypothesis import given, settings
from hypothesis import strategies as st

from citystream.operators.cooldown import NEVER, cooldown, entry_times, slice_steps, whole_groups

SCHEMA = "k string, event_time timestamp, seq bigint"


def run(spark, rows, interval, slice_ms):
    data = [(k, at(ms / 1000), i) for i, (k, ms) in enumerate(rows)]
    kept = cooldown(frame(spark, data, SCHEMA), ["k"], "event_time", "seq", interval, slice_ms)
    return sorted(r.seq for r in kept.collect())


def in_order(rows):
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("slice_ms", [2_000, 3_600_000])
def test_boundary(spark, slice_ms):
    assert run(spark, [("a", 0), ("a", 119_999), ("a", 120_000)], 120_000, slice_ms) == [0, 2]


@pytest.mark.parametrize("slice_ms", [20_000, 1_000, 50])
def test_hot_key_over_many_slices(spark, slice_ms):
    """One key holds most rows, evenly dense: the survivors of all slices, of several levels, hang together."""
    rows = in_order([("hot", i * 1_000) for i in range(4_000)] + [(f"k{i % 7}", i * 9_500) for i in range(400)])
    assert run(spark, rows, 7_500, slice_ms) == thin(rows, 7_500)


def test_copies_in_one_millisecond(spark):
    rows = [("a", 0)] * 50 + [("a", 5)] * 50 + [("a", 10)] * 3
    assert run(spark, rows, 10, 1_000) == [0, 100]


@pytest.mark.parametrize("seed", range(4))
def test_random(spark, seed):
    rng = np.random.default_rng(seed)
    rows = in_order([(f"k{int(k)}", int(t)) for k, t in
                     zip(rng.zipf(1.5, 1500) % 5, np.cumsum(rng.integers(0, 900, 1500)))])
    interval = int(rng.integers(1, 20_000))
    assert run(spark, rows, interval, 30_000) == thin(rows, interval)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99)), min_size=1, max_size=60, unique=True),
       st.integers(1, 100))
def test_step_functions(points, interval):
    """Whatever the release time of a slice, the step function names its true last survivor."""
    points.sort()
    group = np.unique([g for g, _ in points], return_inverse=True)[1]
    offset = np.array([o for _, o in points])
    starts, lasts = slice_steps(group, offset, interval, 100)
    for g in set(group):
        mine = offset[group == g]
        for release in range(0, interval + 1):
            last, free = None, release
            for t in mine:
                if t >= free:
                    last, free = t, t + interval
            answer = next((offset[b] for a, b in zip(starts, lasts) if group[a] == g and offset[a] >= release), None)
            assert answer == last


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True), st.integers(1, 90), st.integers(0, 90))
def test_composed_steps_and_entries(points, interval, ago):
    """Steps of slices of ten, composed to slices of eighty, name the true survivors; so do the entries of all slices."""
    points = np.array(sorted(points)) + 80  # the first longer slice is empty
    first = np.unique(points // 10, return_inverse=True)[1]
    starts, ends = (points[x] for x in slice_steps(first, points % 10, interval, 10))
    longer = np.unique(starts // 80, return_inverse=True)[1]
    at_start, at_end = slice_steps(longer, starts % 80, interval, 80, ends - starts // 80 * 80)
    for number in set(points // 80):
        mine = points[points // 80 == number]
        for release in range(number * 80, number * 80 + interval):
            survivors, free = [], release
            for t in mine:
                if t >= free:
                    survivors, free = [*survivors, t], t + interval
            answer = next((ends[b] for a, b in zip(at_start, at_end) if starts[a] // 80 == number and starts[a] >= release), None)
            assert answer == (survivors[-1] if survivors else None)

    for entry in (NEVER, 79 - ago):
        heads, before = entry_times(np.zeros(len(starts), dtype=int), starts // 10, starts, ends, np.array([entry]), interval)
        survivors, free = [], entry + interval if entry != NEVER else 0
        for t in points:
            if t >= free:
                survivors, free = [*survivors, t], t + interval
        for head, got in zip(heads, before):
            earlier = [t for t in survivors if t // 10 < starts[head] // 10]
            assert got == (earlier[-1] if earlier else entry)


def test_whole_groups_rejoins_split_groups():
    rows = pd.DataFrame({"a": list("xxxxyyzz"), "b": [1, 1, 1, 2, 2, 2, 2, 2]})
    parts = list(whole_groups(iter([rows[:2], rows[2:3], rows[3:5], rows[5:]]), ["a", "b"]))
    assert pd.concat([p for p, _ in parts], ignore_index=True).equals(rows)
    groups = [tuple(g) for p, n in parts for _, q in p.groupby(n) for g in {tuple(r) for r in q.to_numpy()}]
    assert len(groups) == len(set(groups)) == 4
