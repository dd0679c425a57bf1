"""The jobs as streams: several micro-batches, late rows, restarts, lanes."""

import json

import numpy as np
import pytest
from helpers import at, bunching, signals, thin, write_batches
from pyspark.sql import functions as F

from citystream import schemas
from citystream.operators import advisory, decode, detect, energy, enrich
from citystream.sources import streams, tables
from citystream.streaming import detectors, jobs, lanes, sinks

NOW = {"availableNow": True}


def meter(ward, seconds, kwh=1.0):
    return {"meter_id": "M", "ward_id": ward, "kwh_consumed": kwh, "power_factor": 0.9, "voltage": 230.0,
            "timestamp": at(seconds).strftime("%Y-%m-%dT%H:%M:%SZ")}


def batches_of(topic, events, size):
    rows = [(topic, 0, i, e) for i, e in enumerate(events)]
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def run(spark, rows, tmp_path, mode="append", name="out", **how):
    query = sinks.to_table(rows, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), mode, NOW, **how)
    sinks.await_all(query)
    return query, sinks.read_table(spark, str(tmp_path / name))


def test_ward_energy_update_equals_batch(spark, tmp_path):
    events = [meter(f"W0{i % 3}", i * 120, i / 8) for i in range(120)]
    write_batches(tmp_path / "in", batches_of("smart_meters", events, 25))
    raw = streams.from_files(spark, str(tmp_path / "in"), max_files=1)
    _, out = run(spark, jobs.ward_energy(raw), tmp_path, "update")
    assert out.select("batch_id").distinct().count() >= 5
    got = {r[:3]: r[3:] for r in sinks.latest_updates(out, ["ward_id", "window_start", "window_end"]).select(*energy.SUMMARY).collect()}
    table = decode.smart_meters(streams.from_files(spark, str(tmp_path / "in"), streaming=False))
    want = {r[:3]: r[3:] for r in energy.ward_summary(table).select(*energy.SUMMARY).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_lake_gets_closed_windows_only_and_late_rows_are_dropped(spark, tmp_path):
    on_time = [meter("W01", s) for s in (0, 900, 3600, 5400, 9000)]
    write_batches(tmp_path / "in", [
        [("smart_meters", 0, i, e) for i, e in enumerate(on_time)],
        [("smart_meters", 0, 10, meter("W01", 9001))],
        [("smart_meters", 0, 11, meter("W01", 9002))],
        [("smart_meters", 0, 12, meter("W01", 10, 500.0))],
        [("smart_meters", 0, 13, meter("W01", 9003))]])
    rows = jobs.ward_energy(streams.from_files(spark, str(tmp_path / "in"), max_files=1))
    query = sinks.to_lake(energy.lake_rows(rows), str(tmp_path / "lake"), str(tmp_path / "cp"), ["ward_id", "date"], NOW)
    sinks.await_all(query)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    lake = tables.read_lake(spark, str(tmp_path / "lake"))
    got = {r.window_end: r.total_kwh_consumed for r in lake.collect()}
    assert got == {at(900): 1.0, at(1800): 1.0, at(4500): 1.0, at(6300): 1.0}
    assert {r.date for r in lake.select(F.col("date").cast("string").alias("date")).collect()} == {"2024-03-01"}


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    events = [meter("W01", i * 60) for i in range(30)]
    parts = batches_of("smart_meters", events, 10)
    write_batches(tmp_path / "in", parts[:2])
    for more in (None, parts[2:]):
        if more:
            write_batches(tmp_path / "in", more)
        raw = streams.from_files(spark, str(tmp_path / "in"), max_files=1)
        query, out = run(spark, jobs.ward_energy(raw), tmp_path, "update")
        if more:
            assert sum(p["numInputRows"] for p in query.recentProgress) == 10
    final = sinks.latest_updates(out, ["window_start"])
    assert final.agg(F.sum("total_kwh_consumed")).first()[0] == 30.0


def readings(n):
    rng = np.random.default_rng(5)
    zones = ["North", "South", "Harbour"]
    return [{"sensor_id": f"AQ{int(rng.integers(6))}", "zone": zones[i % 3], "pm25": 1.5, "pm10": 2.5, "no2": 3.5,
             "aqi": None if i % 17 == 0 else int(rng.integers(100, 520)), "timestamp": at(i * 11).isoformat()}
            for i in range(n)]


def test_advisories_stream_and_sql_equal_batch(spark, tmp_path):
    write_batches(tmp_path / "in", batches_of("air_quality", readings(300), 60))
    zones = tables.zone_profile(spark)
    keys = ["zone", "window_start", "window_end"]
    table = decode.air_quality(streams.from_files(spark, str(tmp_path / "in"), streaming=False))
    want = {r[:3]: r[3:] for r in advisory.advisories(advisory.rolling_aqi_from_panes(table), zones)
            .select(*keys, "rolling_avg_aqi", "advisory_level", "population").collect()}
    raw = streams.from_files(spark, str(tmp_path / "in"), max_files=1)
    for name, rows in (("frame", jobs.health_advisories(raw, zones)), ("sql", jobs.health_advisories_sql(spark, raw, zones))):
        _, out = run(spark, rows, tmp_path, "update", name)
        got = {r[:3]: r[3:] for r in sinks.latest_updates(out, keys)
               .select(*keys, "rolling_avg_aqi", "advisory_level", "population").collect()}
        # A window whose mean fell to 150 or below keeps its last advisory: updates are not retracted.
        assert want.keys() <= got.keys()
        assert all(got[k][0] == pytest.approx(want[k][0]) and got[k][1:] == want[k][1:] for k in want)


def test_aqi_stream_over_batches(spark, tmp_path):
    events = readings(400)
    write_batches(tmp_path / "in", batches_of("air_quality", events, 90))
    raw = decode.detector_input(streams.from_files(spark, str(tmp_path / "in"), max_files=1), "air_quality")
    _, out = run(spark, detectors.aqi_emergencies(raw), tmp_path)
    got = sorted((r.sensor_id, r.event_timestamp, r.severity) for r in out.collect())
    hot = [(i, e) for i, e in enumerate(events) if e["aqi"] is not None and e["aqi"] > 300]
    kept = thin([(e["sensor_id"], i * 11_000) for i, e in hot], 120_000)
    assert got == sorted((hot[k][1]["sensor_id"], hot[k][1]["timestamp"],
                          "CRITICAL" if hot[k][1]["aqi"] > 400 else "HAZARDOUS") for k in kept)


def test_gridlock_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"J{int(rng.integers(3))}", i * 20, None if i % 13 == 0 else float(rng.integers(150, 250))) for i in range(400)]
    events = [{"junction_id": j, "zone": "East", "avg_wait_sec": w, "timestamp": at(t).isoformat()} for j, t, w in rows]
    write_batches(tmp_path / "in", batches_of("traffic_signals", events, 70))
    raw = decode.detector_input(streams.from_files(spark, str(tmp_path / "in"), max_files=1), "traffic_signals")
    _, out = run(spark, detectors.gridlocks(raw), tmp_path)
    columns = ["junction_id", "event_timestamp", "consecutive_readings_sec", "min_wait_sec", "max_wait_sec"]
    got = sorted(tuple(r) for r in out.select(*columns).collect())
    want = sorted(tuple(r) for r in detect.gridlocks(signals(spark, rows)).select(*columns).collect())
    assert len(want) > 5 and got == want


def test_bunching_stream_over_batches(spark, tmp_path):
    rng = np.random.default_rng(4)
    where, rows, t = {}, [], 0
    for _ in range(600):
        t += int(rng.choice([2, 10, 60]))
        key = (f"r{int(rng.integers(2))}", f"b{int(rng.integers(5))}")
        where[key] = where.get(key, np.zeros(2)) + rng.normal(0, 0.0006, 2)
        rows.append((*key, t, 12.9 + float(where[key][0]), 77.5 + float(where[key][1])))
    events = [{"route_id": r, "bus_id": b, "lat": la, "lon": lo, "timestamp": at(s).isoformat()} for r, b, s, la, lo in rows]
    write_batches(tmp_path / "in", batches_of("bus_gps", events, 130))
    raw = decode.detector_input(streams.from_files(spark, str(tmp_path / "in"), max_files=1), "bus_gps")
    _, out = run(spark, detectors.bus_bunching(raw), tmp_path)
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.event_timestamp) for r in out.collect())
    want = sorted((r, a, b, at(s).isoformat()) for r, a, b, s, _ in bunching(rows))
    assert len(want) > 5 and got == want


def test_dead_letter_stream(spark, tmp_path):
    write_batches(tmp_path / "in" / "air_quality", batches_of("air_quality", [{"aqi": 1}, {"aqi": None}, "{"], 1))
    write_batches(tmp_path / "in" / "bus_gps", batches_of("bus_gps", [{"lat": 999, "lon": 1}, {"lat": 9, "lon": 1}], 1))
    raw = streams.read_topics(spark, "file", str(tmp_path / "in"), ["air_quality", "bus_gps"], max_files=1)
    _, out = run(spark, jobs.dead_letters(raw, flag_malformed=True), tmp_path)
    assert sorted((r.error_reason, r.source_topic, r.offset) for r in out.collect()) == [
        ("INVALID_GPS_COORDINATES", "bus_gps", 0), ("MALFORMED_JSON", "air_quality", 2), ("NULL_AQI", "air_quality", 1)]


def test_enrichment_sees_new_timetable_rows(spark, tmp_path):
    def route(name):
        return {"route_id": "R10", "route_name": name, "terminal": "T", "scheduled_arrival_time": "1"}

    def position(i):
        return ("bus_gps", 0, i, {"bus_id": f"B{i}", "route_id": "R10"}, "R10")

    def changes():
        return streams.from_files(spark, str(tmp_path / "changes"), streaming=False)

    for i, name in enumerate(["Old", "New"]):
        write_batches(tmp_path / "changes", [[("route_schedule", 0, i, route(name), "R10")]])
        write_batches(tmp_path / "in", [[position(i)]])
        raw = streams.from_files(spark, str(tmp_path / "in"))
        query = jobs.start_enriched_gps(raw, changes, str(tmp_path / "out"), str(tmp_path / "cp"), NOW)
        sinks.await_all(query)
    got = [json.loads(r.value) for r in sinks.read_table(spark, str(tmp_path / "out")).collect()]
    assert sorted((r["bus_id"], r["route_name"]) for r in got) == [("B0", "Old"), ("B1", "New")]


def test_lanes_are_independent(spark, tmp_path):
    events = [{"junction_id": "J1", "vehicle_count": i, "signal_phase": "RED"} for i in range(12)]
    write_batches(tmp_path / "in", batches_of("traffic_signals", events, 3))
    found = {}
    for lane, limit in ((lanes.HIGH, None), (lanes.STANDARD, 1)):
        raw = streams.from_files(spark, str(tmp_path / "in"), max_files=limit)
        query = lanes.start_lane(raw, lane, str(tmp_path / lane), str(tmp_path / f"{lane}-cp"), NOW)
        sinks.await_all(query)
        found[lane] = (query, sinks.read_table(spark, str(tmp_path / lane)))
    assert all(out.count() == 12 for _, out in found.values())
    assert len(found[lanes.HIGH][0].recentProgress) < len(found[lanes.STANDARD][0].recentProgress)
    assert lanes.backlog(found[lanes.STANDARD][0])["batch_id"] == 3


def test_rows_without_time_raise_no_alert(spark, tmp_path):
    """A reading whose event time is null is left to the dead letters; the cooldown of the others holds for good."""
    def hot(sensor, seconds):
        return {"sensor_id": sensor, "zone": "N", "aqi": 400, "timestamp": at(seconds).isoformat()}

    write_batches(tmp_path / "in", batches_of("air_quality", [hot("a", 0), hot("a", 100), hot("b", 9_000)], 1))
    raw = decode.detector_input(streams.from_files(spark, str(tmp_path / "in"), max_files=1), "air_quality")
    raw = raw.withColumn("event_time", F.when(F.col("sensor_id") != "b", F.col("event_time")))
    _, out = run(spark, detectors.aqi_emergencies(raw), tmp_path)
    assert [r.sensor_id for r in out.collect()] == ["a"]


def test_kafka_write_options():
    assert sinks.kafka_write_options("h:1", "t", "/cp") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "checkpointLocation": "/cp"}
    assert schemas.BY_TOPIC.keys() == {"bus_gps", "air_quality", "traffic_signals", "smart_meters", "route_schedule"}
    assert enrich.FAILED == '{"error":"ENRICHMENT_FAILED"}'
