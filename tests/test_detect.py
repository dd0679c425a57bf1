"""Edges of the incident rules, and the batch rules against event-by-event replays."""

import numpy as np
import pytest
from helpers import air, at, bunching, gps, metres, signals
from pyspark.sql import functions as F

from citystream.functions import geo
from citystream.operators import detect, proximity
from citystream.operators.ordered import run_starts


def test_aqi_threshold_and_severity(spark):
    rows = [("a", 0, 300), ("b", 0, 300.5), ("c", 0, 400), ("d", 0, 401), ("e", 0, 999), ("f", 0, None), ("g", 0, 0)]
    got = {r.sensor_id: r.severity for r in detect.aqi_emergencies(air(spark, rows)).collect()}
    assert got == {"b": "HAZARDOUS", "c": "HAZARDOUS", "d": "CRITICAL", "e": "CRITICAL"}


def test_aqi_cooldown(spark):
    rows = [("a", 0, 350), ("a", 119.999, 350), ("a", 120, 350), ("b", 60, 350)]
    got = sorted((r.sensor_id, r.event_time) for r in detect.aqi_emergencies(air(spark, rows)).collect())
    assert got == [("a", at(0)), ("a", at(120)), ("b", at(60))]


def test_gridlock_skips_null_and_keeps_history(spark):
    rows = [("j", 0, 190.0), ("j", 10, None), ("j", 20, 200.0), ("j", 30, 210.9), ("j", 40, 220.0),
            ("j", 330, 230.0), ("i", 0, 181.0), ("i", 1, 180.0), ("i", 2, 181.0), ("i", 3, 182.0)]
    got = sorted((r.junction_id, r.event_time, r.consecutive_readings_sec, r.min_wait_sec, r.max_wait_sec)
                 for r in detect.gridlocks(signals(spark, rows)).collect())
    assert got == [("j", at(30), [190, 200, 210], 190, 210), ("j", at(330), [210, 220, 230], 210, 230)]


NEAR, FAR = 0.001, 0.01  # degrees of latitude: about 111 m and 1.1 km


def test_bunching_needs_five_minutes(spark):
    rows = [("r", "a", 0, 10.0, 20.0), ("r", "b", 1, 10.0 + NEAR, 20.0),
            ("r", "a", 300.999, 10.0, 20.0), ("r", "b", 301, 10.0 + NEAR, 20.0)]
    got = [(r.bus_1, r.bus_2, r.event_time, r.duration_min) for r in proximity.bus_bunching(gps(spark, rows)).collect()]
    assert got == [("a", "b", at(301), 5.0)]


def test_bunching_separation_resets_run_but_not_cooldown(spark):
    rows = [("r", "a", 0, 10.0, 20.0), ("r", "b", 1, 10.0, 20.0), ("r", "b", 301, 10.0, 20.0),
            ("r", "b", 302, 10.0 + FAR, 20.0), ("r", "b", 303, 10.0, 20.0), ("r", "a", 602, 10.0, 20.0),
            ("r", "a", 603, 10.0, 20.0), ("r", "a", 604, 10.0, 20.0)]
    got = sorted(r.event_time for r in proximity.bus_bunching(gps(spark, rows)).collect())
    assert got == [at(301), at(603)]


def test_unusable_positions_are_ignored(spark):
    rows = [("r", "a", 0, 10.0, 20.0), ("r", "b", 1, 999.0, 999.0), ("r", "", 1, 10.0, 20.0),
            ("", "b", 1, 10.0, 20.0), ("r", "b", 2, None, 20.0), (None, "b", 2, 10.0, 20.0)]
    assert proximity.contacts(gps(spark, rows)).count() == 0


def _walk(seed, n=700, buses=6, routes=2, gap=(1, 5, 40, 4000), step=0.0008):
    rng = np.random.default_rng(seed)
    where = {(r, b): rng.random(2) * 0.004 for r in range(routes) for b in range(buses)}
    t, rows = 0.0, []
    for _ in range(n):
        t += float(rng.choice(gap, p=[.5, .3, .18, .02]))
        key = (int(rng.integers(routes)), int(rng.integers(buses)) if rng.random() > .4 else 0)
        where[key] = where[key] + rng.normal(0, step, 2)
        lat, lon = where[key]
        rows.append((f"r{key[0]}", f"b{key[1]}", t, 12.9 + float(lat), 77.5 + float(lon)))
    return rows


@pytest.mark.parametrize("seed,slice_ms", [(0, None), (1, 30_000), (2, 600_000)])
def test_bunching_against_replay(spark, seed, slice_ms):
    rows = _walk(seed)
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.event_time, r.distance_m)
                 for r in proximity.bus_bunching(gps(spark, rows), slice_ms=slice_ms).collect())
    want = sorted((r, a, b, at(t), d) for r, a, b, t, d in bunching(rows))
    assert len(want) > 5
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=0.011)


def test_contacts_against_replay(spark):
    rows = _walk(9, n=400)
    where, want = {}, set()
    for i, (route, bus, _, lat, lon) in enumerate(rows):
        for (r, other), (la, lo) in where.items():
            if r == route and other != bus and metres(lat, lon, la, lo) < 200:
                want.add((route, *sorted([bus, other]), i))
        where[(route, bus)] = (lat, lon)
    got = [(r.route_id, r.bus_1, r.bus_2, r.offset) for r in proximity.contacts(gps(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def _replayed_contacts(rows):
    where, want = {}, set()
    for i, (route, bus, _, lat, lon) in enumerate(rows):
        for (r, other), (la, lo) in where.items():
            if r == route and other != bus and metres(lat, lon, la, lo) < 200:
                want.add((route, *sorted([bus, other]), i))
        where[(route, bus)] = (lat, lon)
    return want


def test_levels_of_few_positions_get_no_copies_of_the_reports():
    usual = {3: (1_000, 1_000 * 12_000.0), 4: (900, 900 * 50_000.0)}
    assert proximity.kept_levels(usual) == [3, 4]
    assert proximity.kept_levels(usual | {5: (3, 3 * 150_000.0), 6: (1, 500_000.0)}) == [3, 4]
    assert proximity.kept_levels(usual | {5: (800, 800 * 150_000.0)}) == [3, 4, 5]
    # not below DEEPER: one position must not lie in very many buckets; and never in longer ones
    assert proximity.kept_levels(usual | {1: (1, 1_000.0), 8: (1, 1e7)}) == [1, 3, 4, 8]
    assert proximity.kept_levels({}) == []


def test_contacts_after_rare_long_silences(spark):
    rows = _walk(12, n=400, gap=(1, 2, 3, 4_000), step=0.0004)
    silent = [("r0", "late", 0.0, 12.902, 77.502), *rows, ("r0", "late", rows[-1][2] + 1, 12.902, 77.502)]
    got = [(r.route_id, r.bus_1, r.bus_2, r.offset) for r in proximity.contacts(gps(spark, silent)).collect()]
    assert len(got) == len(set(got)) and set(got) == _replayed_contacts(silent) and any("late" in g for g in got)


def test_contacts_are_found_once(spark, monkeypatch):
    """The ranges in which runs are sought take a pass over the contacts, which must not be another join."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    sought = []
    monkeypatch.setattr(proximity, "run_starts", lambda df, *rest: sought.append(plan(df)) or run_starts(df, *rest))
    proximity.bus_bunching(gps(spark, _walk(2, n=60)))
    assert len(sought) == 1 and "Join" not in sought[0] and "Generate" not in sought[0]


@pytest.mark.parametrize("lat0,lon0", [(0.0, 0.0), (0.0, 180.0), (60.0, -180.0), (89.9995, 0.0), (-90.0, 10.0), (45.0, 7.0)])
def test_grid_finds_every_near_point(spark, lat0, lon0):
    """Also across ±180° and around the poles; each near pair meets exactly once."""
    rng = np.random.default_rng(1)
    spread = 0.003
    lats = np.clip(lat0 + rng.normal(0, spread, 60), -90, 90)
    scale = max(np.cos(np.radians(lat0)), 1e-5)
    lons = (lon0 + rng.normal(0, spread, 60) / scale + 180) % 360 - 180
    points = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(zip(lats, lons))],
                                   "i int, lat double, lon double")
    left = geo.with_cell(points, "lat", "lon", 200)
    right = geo.with_cells_within(points.toDF("j", "lat2", "lon2"), "lat2", "lon2", 200)
    near = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) < 200
    got = [(r.i, r.j) for r in left.join(right, ["band", "cell"]).where(near).select("i", "j").collect()]
    want = {(i, j) for i in range(60) for j in range(60) if metres(lats[i], lons[i], lats[j], lons[j]) < 200}
    assert len(got) == len(set(got)) and set(got) == want


def test_alert_records(spark):
    record = detect.alert_records(detect.gridlocks(signals(spark, [("j", i, 200.0) for i in range(3)]))).first()
    assert record.key is None and '"consecutive_readings_sec":[200,200,200]' in record.value
    assert "alert_generated_at" in record.value and '"event_time"' not in record.value


def test_alert_texts(spark):
    alerts = detect.aqi_emergencies(air(spark, [("a", 0, 350)]))
    row = detect.as_incident(detect.stamped(alerts.withColumn("no2", F.lit(None).cast("double"))), F.col("sensor_id")).first()
    assert row.subject == "a" and '"no2":null' in row.value and '"alert_generated_at":"' in row.value
