"""Small builders and straightforward reference simulations for the tests."""

from __future__ import annotations

import json
import math
import os
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq

T0 = datetime(2024, 3, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def air(spark, rows):
    """rows: (sensor, seconds, aqi)"""
    data = [(s, "North", float(a) if a is not None else None, 1.0, 2.0, 3.0, at(t).isoformat(), at(t), i)
            for i, (s, t, a) in enumerate(rows)]
    return frame(spark, data, "sensor_id string, zone string, aqi double, pm25 double, pm10 double, no2 double, "
                              "timestamp string, event_time timestamp, offset bigint")


def signals(spark, rows):
    """rows: (junction, seconds, wait)"""
    data = [(j, "East", w, at(t).isoformat(), at(t), i) for i, (j, t, w) in enumerate(rows)]
    return frame(spark, data, "junction_id string, zone string, avg_wait_sec double, timestamp string, "
                              "event_time timestamp, offset bigint")


def gps(spark, rows):
    """rows: (route, bus, seconds, lat, lon)"""
    data = [(r, b, la, lo, at(t).isoformat(), at(t), i) for i, (r, b, t, la, lo) in enumerate(rows)]
    return frame(spark, data, "route_id string, bus_id string, lat double, lon double, timestamp string, "
                              "event_time timestamp, offset bigint")


def thin(rows, interval):
    """rows: (key, ms) in order -> positions kept"""
    last, kept = {}, []
    for i, (key, ms) in enumerate(rows):
        if key not in last or ms - last[key] >= interval:
            kept.append(i)
            last[key] = ms
    return kept


def metres(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 6_371_000 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def bunching(rows, near=200, hold=300, again=300):
    """Event-by-event replay of the rule. rows: (route, bus, seconds, lat, lon) in order."""
    where, since, told, alerts = {}, {}, {}, []
    for route, bus, t, lat, lon in rows:
        for (r, other), (la, lo) in list(where.items()):
            if r != route or other == bus:
                continue
            pair = (route, *sorted([bus, other]))
            gap = metres(lat, lon, la, lo)
            if gap >= near:
                since.pop(pair, None)
            elif pair not in since:
                since[pair] = t
            elif t - since[pair] >= hold and (pair not in told or t - told[pair] >= again):
                told[pair] = t
                alerts.append((*pair, t, round(gap, 2)))
        where[(route, bus)] = (lat, lon)
    return alerts


def write_batches(folder, batches):
    """One Parquet file of envelope rows per batch, in order of modification time.

    batches: lists of (topic, partition, offset, event dict or text, key)
    """
    os.makedirs(folder, exist_ok=True)
    stamp = 1_700_000_000 + len(os.listdir(folder)) * 10
    for rows in batches:
        texts = [r[3] if isinstance(r[3], str) else json.dumps(r[3]) for r in rows]
        table = pa.table({
            "key": pa.array([r[4] if len(r) > 4 else None for r in rows], pa.string()),
            "value": pa.array(texts, pa.string()),
            "topic": pa.array([r[0] for r in rows], pa.string()),
            "partition": pa.array([r[1] for r in rows], pa.int32()),
            "offset": pa.array([r[2] for r in rows], pa.int64()),
            "timestamp": pa.array([T0] * len(rows), pa.timestamp("us", tz="UTC")),
        })
        path = os.path.join(folder, f"part-{stamp}.parquet")
        pq.write_table(table, path)
        os.utime(path, (stamp, stamp))
        stamp += 10
