"""Incident rules over tables: threshold, consecutive readings, fan-in of alerts.

Rows are taken in order of event time, then ``seq``. The same rules run on streams in
``citystream.streaming.detectors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions import levels
from citystream.functions.json_rows import full_json
from citystream.functions.times import utc_text
from citystream.operators.cooldown import cooldown
from citystream.operators.decode import or_default
from citystream.operators.ordered import trailing_values
from citystream.session import cut

# Fixed values of the city's alert rules.
AQI_LIMIT = 300
AQI_COOLDOWN_MS = 120_000
WAIT_LIMIT_SEC = 180
WAIT_CYCLES = 3
WAIT_COOLDOWN_MS = 300_000

AQI_ALERT = ["alert_type", "sensor_id", "zone", "aqi", "pm25", "pm10", "no2", "event_timestamp", "severity"]
GRIDLOCK_ALERT = ["alert_type", "junction_id", "zone", "consecutive_readings_sec", "consecutive_cycles",
                  "min_wait_sec", "max_wait_sec", "threshold_sec", "event_timestamp"]
BUNCHING_ALERT = ["alert_type", "route_id", "bus_1", "bus_2", "distance_m", "duration_min", "threshold_m",
                  "event_timestamp"]


def aqi_candidates(air: DataFrame, limit: float = AQI_LIMIT) -> DataFrame:
    """Readings strictly above the limit, without an upper bound; NaN is above nothing."""
    return air.where((F.col("aqi") > limit) & ~F.isnan("aqi")).withColumn("sensor_id", or_default("sensor_id", "unknown"))


def aqi_alert_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "alert_type": F.lit("AQI_EMERGENCY"),
        "event_timestamp": F.col("timestamp"),
        "severity": levels.severity(F.col("aqi")),
    })


def aqi_emergencies(air: DataFrame, seq: str = "offset", limit: float = AQI_LIMIT,
                    cooldown_ms: int = AQI_COOLDOWN_MS) -> DataFrame:
    # one pass over the raw readings; what it leaves is small and has only what an alert needs
    found = cut(aqi_candidates(air, limit).select("sensor_id", "zone", "aqi", "pm25", "pm10", "no2", "timestamp", "event_time", seq))
    kept = cooldown(found, ["sensor_id"], "event_time", seq, cooldown_ms)
    return aqi_alert_columns(kept).select(*AQI_ALERT, "event_time")


def consecutive_above(df: DataFrame, keys: Sequence[str], value: str, ts: str, seq: str, limit: float,
                      n: int, above: bool = True, slice_ms: int | None = None) -> DataFrame:
    """Rows at which the last ``n`` values of the key all exceed ``limit`` (or all fall short of it).

    Null values are passed over and do not interrupt a run. Adds ``readings``.
    """
    seen = trailing_values(df.where(F.col(value).isNotNull()), keys, ts, seq, value, n, "readings", slice_ms)
    holds = F.array_min("readings") > limit if above else F.array_max("readings") < limit
    return seen.where((F.size("readings") == n) & holds)


def gridlock_input(signals: DataFrame) -> DataFrame:
    return signals.select(
        or_default("junction_id", "unknown").alias("junction_id"), or_default("zone", "Unknown").alias("zone"),
        F.col("avg_wait_sec").try_cast("int").alias("avg_wait_sec"),
        "timestamp", "event_time", "offset")


def gridlock_alert_columns(df: DataFrame, limit: int = WAIT_LIMIT_SEC, cycles: int = WAIT_CYCLES) -> DataFrame:
    return df.withColumns({
        "alert_type": F.lit("TRAFFIC_GRIDLOCK"),
        "consecutive_readings_sec": F.col("readings"),
        "consecutive_cycles": F.lit(cycles),
        "min_wait_sec": F.array_min("readings"),
        "max_wait_sec": F.array_max("readings"),
        "threshold_sec": F.lit(limit),
        "event_timestamp": F.col("timestamp"),
    })


def gridlocks(signals: DataFrame, limit: int = WAIT_LIMIT_SEC, cycles: int = WAIT_CYCLES,
              cooldown_ms: int = WAIT_COOLDOWN_MS) -> DataFrame:
    return gridlocks_in_order(gridlock_input(signals), limit, cycles, cooldown_ms)


def gridlocks_in_order(rows: DataFrame, limit: int = WAIT_LIMIT_SEC, cycles: int = WAIT_CYCLES,
                       cooldown_ms: int = WAIT_COOLDOWN_MS) -> DataFrame:
    """The same over rows of ``gridlock_input``, which may come from an ordered store."""
    found = consecutive_above(rows, ["junction_id"], "avg_wait_sec", "event_time", "offset", limit, cycles)
    kept = cooldown(cut(found), ["junction_id"], "event_time", "offset", cooldown_ms)
    return gridlock_alert_columns(kept, limit, cycles).select(*GRIDLOCK_ALERT, "event_time")


def low_power_factor(summary: DataFrame, limit: float, windows: int) -> DataFrame:
    """Ward windows at which the mean power factor was below ``limit`` for ``windows`` in a row."""
    # Summaries are evenly spaced, so a slice of a month is small without measuring.
    found = consecutive_above(summary, ["ward_id"], "avg_power_factor", "window_start", "window_end",
                              limit, windows, above=False, slice_ms=31 * 86_400_000)
    return found.select("ward_id", "window_start", "window_end", "avg_power_factor",
                        F.lit(windows).alias("windows_below"))


def stamped(alerts: DataFrame) -> DataFrame:
    """Adds the moment the alert was made; left out wherever results are compared."""
    return alerts.withColumn("alert_generated_at", utc_text(F.current_timestamp()))


def as_incident(alerts: DataFrame, subject: Column) -> DataFrame:
    """Common layout of all alert kinds: type, subject, time and the alert itself as JSON."""
    body = [c for c in alerts.columns if c != "event_time"]
    return alerts.select("alert_type", subject.alias("subject"), "event_timestamp", full_json(*body).alias("value"))


def alert_records(alerts: DataFrame) -> DataFrame:
    """Alerts as outgoing records without a key, stamped, nulls kept."""
    stamp = stamped(alerts.drop("event_time"))
    return stamp.select(F.lit(None).cast("string").alias("key"), full_json(*stamp.columns).alias("value"))


def incidents(aqi: DataFrame, gridlock: DataFrame, bunching: DataFrame) -> DataFrame:
    return (as_incident(aqi, F.col("sensor_id"))
            .unionByName(as_incident(gridlock, F.col("junction_id")))
            .unionByName(as_incident(bunching, F.concat_ws("_", "route_id", "bus_1", "bus_2"))))
