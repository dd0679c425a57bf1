"""Incident rules over streams, with state per key that outlives micro-batches.

Rows of one micro-batch are taken in order of event time and offset; across batches the order
is arrival, as in any stream. The batch size is bounded by the source's rate limit.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from citystream.functions.geo import EARTH_RADIUS_M
from citystream.functions.times import epoch_ms
from citystream.operators import detect, proximity

NOT_NEAR = np.iinfo("int64").min


def _in_order(batches: Iterable[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(list(batches), ignore_index=True)
    return rows.sort_values(["ms", "offset"], kind="stable", ignore_index=True)


def _stateful(df: DataFrame, key: str, rule: Callable, extra: list[T.StructField], state: str) -> DataFrame:
    """Runs ``rule(rows, state tuple or None) -> (kept positions, added columns, state tuple)`` per key.

    State is kept for good and no row is ever too late. Rows without an event time have no place in the order
    and raise no alert; ``quality.untimed`` lists them.
    """
    columns = [c for c in df.columns if c != "event_time"]
    out = T.StructType([*[df.schema[c] for c in columns], *extra])
    df = df.where(F.col("event_time").isNotNull()).select(*columns)

    def run(_: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        rows = _in_order(batches)
        at, added, after = rule(rows, held.get if held.exists else None)
        held.update(after)
        kept = rows.iloc[at].reset_index(drop=True)
        for field, values in zip(extra, added):
            kept[field.name] = values
        yield kept[[*columns, *[f.name for f in extra]]]

    return df.groupBy(key).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.NoTimeout)


def _thin(ms: list[int], last: int | None, interval: int) -> tuple[list[int], int | None]:
    kept = []
    for i, t in enumerate(ms):
        if last is None or t - last >= interval:
            kept.append(i)
            last = t
    return kept, last


def aqi_emergencies(air: DataFrame, limit: float = detect.AQI_LIMIT, cooldown_ms: int = detect.AQI_COOLDOWN_MS) -> DataFrame:
    found = detect.aqi_candidates(air, limit).select(
        "sensor_id", "zone", "aqi", "pm25", "pm10", "no2", "timestamp", "offset", "event_time",
        epoch_ms(F.col("event_time")).alias("ms"))

    def rule(rows: pd.DataFrame, state):
        kept, last = _thin(rows["ms"].tolist(), state[0] if state else None, cooldown_ms)
        return kept, [], (last,)

    kept = _stateful(found, "sensor_id", rule, [], "last_ms long")
    return detect.aqi_alert_columns(kept).select(*detect.AQI_ALERT)


def gridlocks(signals: DataFrame, limit: int = detect.WAIT_LIMIT_SEC, cycles: int = detect.WAIT_CYCLES,
              cooldown_ms: int = detect.WAIT_COOLDOWN_MS) -> DataFrame:
    readings = (detect.gridlock_input(signals).where(F.col("avg_wait_sec").isNotNull())
                .select("junction_id", "zone", "avg_wait_sec", "timestamp", "offset", "event_time",
                        epoch_ms(F.col("event_time")).alias("ms")))

    def rule(rows: pd.DataFrame, state):
        before, last = (list(state[0]), state[1]) if state else ([], None)
        waits = np.array([*before, *rows["avg_wait_sec"].tolist()], dtype="int64")
        run = np.convolve(waits > limit, np.ones(cycles, dtype="int64"))[:len(waits)]
        full = np.flatnonzero(run[len(before):] == cycles)
        chosen, last = _thin(rows["ms"].to_numpy()[full].tolist(), last, cooldown_ms)
        at = full[chosen]
        seen = [waits[i + len(before) - cycles + 1:i + len(before) + 1].tolist() for i in at]
        return at, [seen], (waits[-cycles:].tolist(), last)

    kept = _stateful(readings, "junction_id", rule, [T.StructField("readings", T.ArrayType(T.IntegerType()))],
                     "history array<int>, last_ms long")
    return detect.gridlock_alert_columns(kept, limit, cycles).select(*detect.GRIDLOCK_ALERT)


def _distances(lat: np.ndarray, lon: np.ndarray, lats: np.ndarray, lons: np.ndarray) -> np.ndarray:
    half_lat = np.sin(np.radians(lats - lat) / 2)
    half_lon = np.sin(np.radians(lons - lon) / 2)
    a = half_lat * half_lat + np.cos(np.radians(lat)) * np.cos(np.radians(lats)) * half_lon * half_lon
    return np.arctan2(np.sqrt(a), np.sqrt(1 - a)) * (2.0 * EARTH_RADIUS_M)


#: Reports times vehicles that are looked at together.
CELLS = 1 << 20


def _bunched(me: np.ndarray, x: np.ndarray, y: np.ndarray, ms: np.ndarray, lat: np.ndarray, lon: np.ndarray, near: dict, told: dict,
             near_m: float, near_for_ms: int, cooldown_ms: int) -> tuple[np.ndarray, ...]:
    """The alerts of some reports in order: report, vehicle, other vehicle, metres and how long near, an array each.

    ``lat`` and ``lon`` hold the last position of every vehicle (NaN: none yet), ``near`` since when pairs are near and
    ``told`` the last alerts of pairs; all are brought up to date.
    """
    n, k = np.arange(len(me)), len(lat)
    last = np.full((len(me) + 1, k), -1)    # of every vehicle the last report before each one
    last[n + 1, me] = n
    last = np.maximum.accumulate(last, axis=0)
    before, seen = last[:-1], last[-1]
    metres = _distances(x[:, None], y[:, None], np.where(before < 0, lat, x[before]), np.where(before < 0, lon, y[before]))
    metres[n, me] = np.nan
    at, other = np.nonzero(metres < near_m)
    pair = np.minimum(me[at], other) * k + np.maximum(me[at], other)
    order = np.lexsort((at, pair))
    at, other, pair = at[order], other[order], pair[order]
    # a contact goes on with a run if the pair's report before it was a contact too, here or before these reports
    previous = np.maximum(before[at, me[at]], before[at, other])
    same = np.append(False, (pair[1:] == pair[:-1]) & (at[:-1] == previous[1:])) if len(at) else np.zeros(0, bool)
    since = np.array([near.get(p, NOT_NEAR) if b < 0 else NOT_NEAR for p, b in zip(pair[~same].tolist(), previous[~same].tolist())], "int64")
    goes_on = same.copy()
    goes_on[~same] = since != NOT_NEAR
    since = np.where(since == NOT_NEAR, ms[at[~same]], since)[np.cumsum(~same) - 1]
    lasted = ms[at] - since
    found, kept = np.flatnonzero(goes_on & (lasted >= near_for_ms)), []
    for own in np.split(found, np.flatnonzero(np.diff(pair[found])) + 1) if len(found) else []:
        p, times, rows = int(pair[own[0]]), ms[at[own]].tolist(), own.tolist()
        i = bisect_left(times, told[p] + cooldown_ms) if p in told else 0
        while i < len(times):
            kept.append(rows[i])
            told[p] = times[i]
            i = bisect_left(times, times[i] + cooldown_ms, i + 1)
    for p in [p for p in near if max(seen[p // k], seen[p % k]) >= 0]:
        del near[p]
    ends = np.flatnonzero(at == np.maximum(seen[pair // k], seen[pair % k]))
    near.update(zip(pair[ends].tolist(), since[ends].tolist()))
    moved = seen >= 0
    lat[moved], lon[moved] = x[seen[moved]], y[seen[moved]]
    kept = np.array(kept, "int64")
    kept = kept[np.lexsort((other[kept], at[kept]))]
    return at[kept], me[at[kept]], other[kept], metres[at[kept], other[kept]], lasted[kept]


def bus_bunching(gps: DataFrame, near_m: int = proximity.NEAR_M, near_for_ms: int = proximity.NEAR_FOR_MS,
                 cooldown_ms: int = proximity.COOLDOWN_MS) -> DataFrame:
    """State of a route: last positions, pairs now near (since when), last alert per pair.

    Only pairs that are near or have alerted are kept, not all pairs of the route.
    """
    reports = proximity.usable_positions(gps).select(
        "route_id", "bus_id", "lat", "lon", "timestamp", "offset", "event_time",
        epoch_ms(F.col("event_time")).alias("ms"))
    extra = [T.StructField("bus_1", T.StringType()), T.StructField("bus_2", T.StringType()),
             T.StructField("distance_m", T.DoubleType()), T.StructField("near_ms", T.LongType())]
    state = ("buses array<string>, lats array<double>, lons array<double>, near_1 array<string>, "
             "near_2 array<string>, near_since array<long>, told_1 array<string>, told_2 array<string>, "
             "told_at array<long>")

    def rule(rows: pd.DataFrame, held):
        buses, lats, lons, near_1, near_2, since, told_1, told_2, told_at = (
            [list(part) for part in held] if held else [[] for _ in range(9)])
        names = np.array([*buses, *sorted(set(rows["bus_id"]) - set(buses))], dtype=object)
        k, index = len(names), {name: i for i, name in enumerate(names)}
        number = lambda one, two: min(index[one], index[two]) * k + max(index[one], index[two])
        near = {number(*pair): t for *pair, t in zip(near_1, near_2, since)}
        told = {number(*pair): t for *pair, t in zip(told_1, told_2, told_at)}
        lat = np.full(k, np.nan)
        lon = np.full(k, np.nan)
        lat[:len(buses)], lon[:len(buses)] = lats, lons
        me = rows["bus_id"].map(index).to_numpy("int64")
        x, y, ms = rows["lat"].to_numpy("float64"), rows["lon"].to_numpy("float64"), rows["ms"].to_numpy("int64")
        at, ones, twos, metres, spans = [], [], [], [], []
        step = max(1, CELLS // k)
        for first in range(0, len(rows), step):
            part = slice(first, first + step)
            i, bus, other, distance, lasted = _bunched(me[part], x[part], y[part], ms[part], lat, lon, near, told,
                                                       near_m, near_for_ms, cooldown_ms)
            at += (first + i).tolist()
            ones += np.minimum(names[bus], names[other]).tolist()
            twos += np.maximum(names[bus], names[other]).tolist()
            metres += distance.tolist()
            spans += lasted.tolist()

        def pairs(of: dict) -> list[list]:
            named = [sorted((names[p // k], names[p % k])) for p in of]
            return [[p[0] for p in named], [p[1] for p in named], list(of.values())]

        after = (names.tolist(), lat.tolist(), lon.tolist(), *pairs(near), *pairs(told))
        return at, [ones, twos, metres, spans], after

    kept = _stateful(reports, "route_id", rule, extra, state)
    return proximity.bunching_alert_columns(kept, near_m).select(*detect.BUNCHING_ALERT)
