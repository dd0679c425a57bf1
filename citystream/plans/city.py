"""City streams derived from the ``events`` table, row by row and without losing any.

Every view is plain arithmetic on ``event_id`` and ``user_id``, so it works on a table and on
a stream alike and gives the same values in any SQL engine. Event time is one second per
``event_id``; ``ts`` stays available as the moment of ingestion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citystream.session import use_utc

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

_ISO = "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_ISO_Z = "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
_BUS = "(user_id div 6) % 4"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream source takes a plain path for a folder; this may be one file.
    return use_utc(spark).readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parquet*")


def _base(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_id", "user_id", "ts",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id) as event_time",
        "(event_id * 7919 + user_id * 104729) % 10007 as h",
        "event_id as offset")


def air_quality(ev: DataFrame) -> DataFrame:
    return _base(ev).selectExpr(
        "event_id", "event_time", "ts", "offset", "cast(user_id % 3 as int) as partition",
        "concat('AQ', cast(100 + user_id % 50 as string)) as sensor_id",
        "case user_id % 5 when 0 then 'North' when 1 then 'South' when 2 then 'East' "
        "when 3 then 'West' else 'Central' end as zone",
        "(1000 + (h * 17) % 24000) / 100.0D as pm25",
        "(2000 + (h * 19) % 28000) / 100.0D as pm10",
        "(500 + (h * 23) % 14500) / 100.0D as no2",
        "cast(case when event_id % 20 = 7 then null when event_id % 40 = 13 then -10 "
        "when event_id % 40 = 33 then 999 else 40 + 75 * (user_id % 5) + h % 81 end as double) as aqi",
        f"{_ISO} as timestamp")


def traffic_signals(ev: DataFrame) -> DataFrame:
    return _base(ev).selectExpr(
        "event_id", "event_time", "ts", "offset", "cast(user_id % 6 as int) as partition",
        "concat('J', cast(1 + user_id % 20 as string)) as junction_id",
        "case user_id % 4 when 0 then 'North' when 1 then 'South' when 2 then 'East' "
        "else 'West' end as zone",
        "cast(10 + h % 291 as int) as vehicle_count",
        "cast(20 + h % 231 as double) as avg_wait_sec",
        "case h % 3 when 0 then 'GREEN' when 1 then 'RED' else 'YELLOW' end as signal_phase",
        f"{_ISO} as timestamp")


def bus_gps(ev: DataFrame) -> DataFrame:
    return _base(ev).selectExpr(
        "event_id", "event_time", "ts", "offset", "cast(user_id % 12 as int) as partition",
        "concat('R1', cast(user_id % 6 as string)) as route_id",
        f"concat('BUS', cast(100 + {_BUS} as string)) as bus_id",
        "cast(case when event_id % 10 = 3 then 999 when event_id % 50 = 21 then null "
        f"else 12.95D + 0.001D * (({_BUS} + (event_id div 900) * 3 * ({_BUS} + 1)) % 16) end as double) as lat",
        "cast(case when event_id % 10 = 3 then 999 else 77.55D + 0.01D * (user_id % 6) end as double) as lon",
        "cast(h % 61 as int) as speed_kmh", "cast(10 + h % 91 as int) as occupancy_pct",
        f"{_ISO} as timestamp")


def smart_meters(ev: DataFrame) -> DataFrame:
    return _base(ev).selectExpr(
        "event_id", "event_time", "ts", "offset", "cast(user_id % 8 as int) as partition",
        "concat('M', lpad(cast(1 + user_id % 10 as string), 2, '0'), "
        "lpad(cast(1 + (user_id div 10) % 5 as string), 2, '0')) as meter_id",
        "concat('W', lpad(cast(1 + user_id % 10 as string), 2, '0')) as ward_id",
        "(200 + h % 2300) / 1000.0D as kwh_consumed",
        "(700 + (h * 7) % 290) / 1000.0D as power_factor",
        "(21800 + (h * 13) % 2400) / 100.0D as voltage",
        f"{_ISO_Z} as timestamp")


def schedule_changes(ev: DataFrame) -> DataFrame:
    """A changelog of route timetables: every event re-publishes the row of one route."""
    return _base(ev).selectExpr(
        "event_id", "event_time", "offset",
        "concat('R1', cast(user_id % 5 as string)) as route_id",
        "concat('Line ', cast(user_id % 5 as string)) as route_name",
        "concat('Terminal ', cast(h % 7 as string)) as terminal",
        "concat(lpad(cast(5 + h % 18 as string), 2, '0'), ':', "
        "lpad(cast(h % 60 as string), 2, '0')) as scheduled_arrival_time")


VIEWS = {
    "air_quality": air_quality,
    "traffic_signals": traffic_signals,
    "bus_gps": bus_gps,
    "smart_meters": smart_meters,
}

# What some producers send instead of a whole record: SQL expressions over a record's ``value`` and ``offset``.
_BROKEN = "when offset % 37 = 5 then concat('not json ', offset) when offset % 41 = 9 then '[1, 2]' "
ROUGH = {
    "traffic_signals": f"case {_BROKEN} when offset % 17 = 3 then regexp_replace(value, '\"junction_id\":\"[^\"]*\",', '') "
                       "when offset % 19 = 4 then regexp_replace(value, '\"avg_wait_sec\":[^,]*,', '\"avg_wait_sec\":null,') "
                       "when offset % 29 = 11 then regexp_replace(value, '\"timestamp\":\"[^\"]*\"', '\"timestamp\":\"soon\"') else value end",
    "smart_meters": f"case {_BROKEN} when offset % 17 = 3 then regexp_replace(value, '\"ward_id\":\"[^\"]*\",', '') "
                    "when offset % 19 = 4 then regexp_replace(value, '\"kwh_consumed\":[^,]*,', '\"kwh_consumed\":\"much\",') "
                    "when offset % 29 = 11 then regexp_replace(value, 'Z\"', '+00:00\"') else value end",
    "air_quality": f"case {_BROKEN} else value end",
    "bus_gps": f"case {_BROKEN} else value end",
}
