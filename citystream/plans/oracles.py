"""The same queries in standard SQL, for an independent engine on the same tables."""

from __future__ import annotations

# Fixed values of the city, written out here once more so that a wrong one in the package does not go unnoticed.
_ZONES = """('North', 'North Zone', 125000, 12, 3, 48), ('South', 'South Zone', 98000, 8, 2, 35), ('East', 'East Zone', 145000, 15, 4, 52),
  ('West', 'West Zone', 112000, 10, 2, 41), ('Central', 'Central Zone', 200000, 25, 6, 28)"""
_ROUTES = """('R10', 'Airport Express', 'Airport', '08:45'), ('R11', 'Tech Park Shuttle', 'Tech Park', '09:00'),
  ('R12', 'City Center Loop', 'City Center', '09:15'), ('R13', 'Ring Road Service', 'Ring Road', '09:30'),
  ('R14', 'Metro Connector', 'Metro Station', '09:45')"""
_LEVEL = "case when aqi > 300 then 'HAZARDOUS' when aqi > 200 then 'VERY_UNHEALTHY' else 'UNHEALTHY' end"
_MESSAGE = """case when aqi > 300 then 'Immediate evacuation recommended. All outdoor activity prohibited.'
  when aqi > 200 then 'Health alert: Everyone should avoid prolonged outdoor exposure.'
  else 'Sensitive groups should avoid outdoor activity. General public: limit exposure.' end"""

_BASE = """base as (
  select event_id, event_id as "offset", user_id, ts,
         timestamp '2024-01-01 00:00:00' + to_seconds(event_id) as event_time,
         (event_id * 7919 + user_id * 104729) % 10007 as h
  from events)"""
_ISO = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') as timestamp"

_VIEWS = {
    "air": f"""air as (
  select *, cast(user_id % 3 as integer) as partition,
    'AQ' || cast(100 + user_id % 50 as varchar) as sensor_id,
    case user_id % 5 when 0 then 'North' when 1 then 'South' when 2 then 'East' when 3 then 'West' else 'Central' end as zone,
    (1000 + (h * 17) % 24000) / 100.0::double as pm25, (2000 + (h * 19) % 28000) / 100.0::double as pm10,
    (500 + (h * 23) % 14500) / 100.0::double as no2,
    cast(case when event_id % 20 = 7 then null when event_id % 40 = 13 then -10 when event_id % 40 = 33 then 999
         else 40 + 75 * (user_id % 5) + h % 81 end as double) as aqi, {_ISO}
  from base)""",
    "signals": f"""signals as (
  select *, 'J' || cast(1 + user_id % 20 as varchar) as junction_id,
    case user_id % 4 when 0 then 'North' when 1 then 'South' when 2 then 'East' else 'West' end as zone,
    cast(10 + h % 291 as integer) as vehicle_count, cast(20 + h % 231 as integer) as avg_wait_sec,
    case h % 3 when 0 then 'GREEN' when 1 then 'RED' else 'YELLOW' end as signal_phase, {_ISO}
  from base)""",
    "gps": f"""gps as (
  select *, cast(user_id % 12 as integer) as partition,
    'R1' || cast(user_id % 6 as varchar) as route_id, 'BUS' || cast(100 + (user_id // 6) % 4 as varchar) as bus_id,
    cast(case when event_id % 10 = 3 then 999 when event_id % 50 = 21 then null
         else 12.95::double + 0.001::double * (((user_id // 6) % 4 + (event_id // 900) * 3 * ((user_id // 6) % 4 + 1)) % 16) end as double) as lat,
    cast(case when event_id % 10 = 3 then 999 else 77.55::double + 0.01::double * (user_id % 6) end as double) as lon,
    cast(h % 61 as integer) as speed_kmh, cast(10 + h % 91 as integer) as occupancy_pct, {_ISO}
  from base)""",
    "meters": """meters as (
  select *, 'W' || lpad(cast(1 + user_id % 10 as varchar), 2, '0') as ward_id,
    (200 + h % 2300) / 1000.0::double as kwh_consumed, (700 + (h * 7) % 290) / 1000.0::double as power_factor,
    (21800 + (h * 13) % 2400) / 100.0::double as voltage
  from base)""",
    "changes": """changes as (
  select *, 'R1' || cast(user_id % 5 as varchar) as route_id, 'Line ' || cast(user_id % 5 as varchar) as route_name,
    'Terminal ' || cast(h % 7 as varchar) as terminal,
    lpad(cast(5 + h % 18 as varchar), 2, '0') || ':' || lpad(cast(h % 60 as varchar), 2, '0') as scheduled_arrival_time
  from base)""",
    "zones": "zones(zone, zone_name, population, num_schools, num_hospitals, area_sq_km) as (values " + _ZONES + ")",
    "routes": "routes(route_id, route_name, terminal, scheduled_arrival_time) as (values " + _ROUTES + ")",
}


def _with(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    parts = [_BASE, *[_VIEWS[v] for v in views.split()], *ctes]
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


# -- ward energy ---------------------------------------------------------------------------

_WARD = """ward as (
  select ward_id, time_bucket(interval '15 minutes', event_time) as window_start,
         window_start + interval '15 minutes' as window_end,
         round(sum(kwh_consumed), 3) as total_kwh_consumed, round(avg(power_factor), 9) as avg_power_factor,
         max(voltage) as peak_voltage
  from meters group by ward_id, window_start)"""
_LAKE = "select *, strftime(window_start, '%Y-%m-%d') as date from ward"


def _report(period: str) -> str:
    return _with("meters", f"""
select ward_id, cast(date_trunc('{period}', event_time) as date) as period_start,
       round(sum(kwh_consumed), 3) as total_kwh_consumed, round(avg(power_factor), 9) as avg_power_factor,
       max(voltage) as peak_voltage, count(distinct time_bucket(interval '15 minutes', event_time)) as windows
from meters group by all""")


# -- air quality ---------------------------------------------------------------------------

_ROLLING = """rolling as (
  select zone, time_bucket(interval '1 minute', event_time) - to_minutes(b) as window_start,
         window_start + interval '10 minutes' as window_end,
         avg(aqi) as aqi, avg(pm25) as pm25, avg(pm10) as pm10
  from air, range(10) r(b) where aqi between 0 and 500 group by zone, window_start)"""


_AVERAGES = ("round(aqi, 9) as rolling_avg_aqi, round(pm25, 9) as rolling_avg_pm25, "
             "round(pm10, 9) as rolling_avg_pm10")
_ADVISORIES = _with("air zones", f"""
select zone, zone_name, population, num_schools, num_hospitals, window_start, window_end, {_AVERAGES},
       {_LEVEL} as advisory_level, {_MESSAGE} as advisory_message
from rolling left join zones using (zone) where aqi > 150""", _ROLLING)

# -- data quality --------------------------------------------------------------------------


def _text(c: str) -> str:
    return f"""'"{c}":"' || {c} || '"'"""


def _number(c: str) -> str:
    return f"""'"{c}":' || coalesce(cast({c} as varchar), 'null')"""


def _json(*parts: str) -> str:
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_AIR_REASON = "case when aqi is null then 'NULL_AQI' when aqi < 0 or aqi > 500 then 'AQI_OUT_OF_RANGE' end"
_GPS_REASON = ("case when lat is null or lon is null then 'NULL_GPS_COORDINATE' "
               "when abs(lat) > 90 or abs(lon) > 180 then 'INVALID_GPS_COORDINATES' end")
_AIR_JSON = _json(_text("sensor_id"), _text("zone"), _number("pm25"), _number("pm10"), _number("no2"),
                  _number("aqi"), _text("timestamp"))
_GPS_JSON = _json(_text("bus_id"), _text("route_id"), _number("lat"), _number("lon"), _number("speed_kmh"),
                  _number("occupancy_pct"), _text("timestamp"))


def _dlq_select(view: str, topic: str, reason: str, body: str) -> str:
    return (f"select {reason} as error_reason, '{topic}' as source_topic, partition, \"offset\", "
            f"{body} as original_event from {view} where {reason} is not null")


_DLQ_AIR = _dlq_select("air", "air_quality", _AIR_REASON, _AIR_JSON)
_DLQ_GPS = _dlq_select("gps", "bus_gps", _GPS_REASON, _GPS_JSON)
_DLQ_ALL = _with("air gps", f"{_DLQ_AIR} union all {_DLQ_GPS}")

_POSITION = '"offset", bus_id, route_id, lat, lon, speed_kmh, occupancy_pct, event_time'
_LATEST_CHANGES = """latest as (
  select route_id, route_name, terminal, scheduled_arrival_time from changes
  qualify row_number() over (partition by route_id order by "offset" desc) = 1)"""


def _enriched(table: str) -> str:
    return f"""select {_POSITION}, coalesce(route_name, 'UNKNOWN') as route_name,
  coalesce(terminal, 'UNKNOWN') as terminal, coalesce(scheduled_arrival_time, 'UNKNOWN') as scheduled_arrival_time
from gps left join {table} using (route_id)"""


# Records out of order: tenths of a second of delay, and what came later than a bound behind the newest before it.
_DELAY = ("(event_id * 7919) % 89 + case when event_id % 211 = 7 then 6000 else 0 end "
          "+ case when event_id % 509 = 11 then 30000 else 0 end")


def _split(view: str, seconds: int) -> tuple[str, str]:
    return (f"""{view}_judged as (
  select *, coalesce(event_time < max(event_time) over (order by event_id * 10 + {_DELAY}, event_id
    rows between unbounded preceding and 1 preceding) - interval '{seconds} seconds', false) as late from {view})""",
            f"{view}_on_time as (select * from {view}_judged where not late)")


def _on_time(views: str, view: str, seconds: int, select: str, *ctes: str) -> str:
    return _with(views, select, *_split(view, seconds), *[c.replace(f"from {view}", f"from {view}_on_time") for c in ctes], recursive=True)


def _late(view: str, topic: str, subject: str, seconds: int) -> str:
    return _with(view, f"""select 'LATE_EVENT' as error_reason, '{topic}' as source_topic, cast(user_id % {{}} as integer) as partition, "offset",
  {subject} as subject from {view}_judged where late""".format({"air": 3, "meters": 8}[view]), _split(view, seconds)[0])


# -- incidents -----------------------------------------------------------------------------


def _thin(name: str, source: str, keys: str, minutes: int) -> str:
    """Greedy thinning of ``source`` per key: each kept time decides the next one."""
    same = " and ".join(f"r.{k} = e.{k}" for k in keys.split(", "))
    held = ", ".join(f"r.{k}" for k in keys.split(", "))
    return f"""{name} as (
  select {keys}, min(event_time) as event_time from {source} group by {keys}
  union all
  select {held}, min(e.event_time) from {name} r join {source} e
    on {same} and e.event_time >= r.event_time + interval '{minutes} minutes' group by {held}, r.event_time)"""


_AQI_CTES = ("hot as (select * from air where aqi > 300)", _thin("aqi_kept", "hot", "sensor_id", 2))
_AQI_SELECT = """select 'AQI_EMERGENCY' as alert_type, sensor_id, zone, aqi, pm25, pm10, no2,
  timestamp as event_timestamp, case when aqi > 400 then 'CRITICAL' else 'HAZARDOUS' end as severity
from aqi_kept join hot using (sensor_id, event_time)"""

_GRID_CTES = ("""seen as (
  select *, list(avg_wait_sec) over (partition by junction_id order by event_time rows between 2 preceding and current row) as readings
  from signals)""",
              "stuck as (select * from seen where len(readings) = 3 and list_min(readings) > 180)",
              _thin("grid_kept", "stuck", "junction_id", 5))
_GRID_SELECT = """select 'TRAFFIC_GRIDLOCK' as alert_type, junction_id, zone,
  array_to_string(readings, ',') as consecutive_readings_sec, 3 as consecutive_cycles,
  list_min(readings) as min_wait_sec, list_max(readings) as max_wait_sec, 180 as threshold_sec,
  timestamp as event_timestamp
from grid_kept join stuck using (junction_id, event_time)"""

_PAIR_CTES = (
    "usable as (select * from gps where lat between -90 and 90 and lon between -180 and 180)",
    "buses as (select distinct route_id, bus_id from usable)",
    """asked as (
  select e.*, b.bus_id as other_bus from usable e join buses b on e.route_id = b.route_id and e.bus_id <> b.bus_id)""",
    """apart as (
  select a.route_id, least(a.bus_id, other_bus) as bus_1, greatest(a.bus_id, other_bus) as bus_2,
         a.event_time, a."offset", a.timestamp, o.timestamp as other_timestamp,
         pow(sin(radians(o.lat - a.lat) / 2), 2)
           + cos(radians(a.lat)) * cos(radians(o.lat)) * pow(sin(radians(o.lon - a.lon) / 2), 2) as q,
         2 * 6371000 * atan2(sqrt(q), sqrt(1 - q)) as distance_m
  from asked a asof join usable o
    on a.route_id = o.route_id and a.other_bus = o.bus_id and a.event_time > o.event_time)""")
_BUNCH_CTES = (
    *_PAIR_CTES,
    """stretches as (
  select *, sum(case when distance_m >= 200 then 1 else 0 end) over (
    partition by route_id, bus_1, bus_2 order by event_time rows unbounded preceding) as stretch
  from apart)""",
    """near as (
  select *, epoch_ms(event_time) - epoch_ms(min(event_time) over (
    partition by route_id, bus_1, bus_2, stretch)) as near_ms
  from stretches where distance_m < 200)""",
    "bunched as (select * from near where near_ms >= 300000)",
    _thin("bunch_kept", "bunched", "route_id, bus_1, bus_2", 5))
_BUNCH_SELECT = """select 'BUS_BUNCHING' as alert_type, route_id, bus_1, bus_2, round(distance_m, 2) as distance_m,
  round(near_ms / 60000.0::double, 2) as duration_min, 200 as threshold_m, timestamp as event_timestamp
from bunch_kept join bunched using (route_id, bus_1, bus_2, event_time)"""

_AQI = _with("air", _AQI_SELECT, *_AQI_CTES, recursive=True)
_GRID = _with("signals", _GRID_SELECT, *_GRID_CTES, recursive=True)
_BUNCH = _with("gps", _BUNCH_SELECT, *_BUNCH_CTES, recursive=True)


def _feed(lane: str) -> str:
    return _with("signals", f"""select "offset",
  format('[{lane}] junction={{}} vehicles={{}} phase={{}}', junction_id, vehicle_count, signal_phase) as line
from signals""")


def _retained(view: str, days: int, extra: str = "", where: str = "true") -> str:
    return _with(view, f"""select "offset", ts{extra} from {view}
where {where} and ts >= (select max(ts) from {view} where {where}) - interval '{days} days'""")


def _lags(lane: str, batches: int) -> str:
    return f"""select '{lane}' as lane, cast(batch as integer) as batch, n_rows, cast((select count(*) from base) - sum(n_rows) over (order by batch) as bigint) as behind
from (select event_id * 10 * {batches} // ((select max(event_id) from base) * 10 + 1) as batch, count(*) as n_rows from base group by 1)"""


def _incident(kind: str, subject: str, body: str, source: str) -> str:
    return f"select alert_type, {subject} as subject, event_timestamp, {body} as value from ({source}) as {kind}"


_AQI_JSON = _json(_text("alert_type"), _text("sensor_id"), _text("zone"), *map(_number, ("aqi", "pm25", "pm10", "no2")),
                  _text("event_timestamp"), _text("severity"))
_GRID_JSON = _json(_text("alert_type"), _text("junction_id"), _text("zone"), "'\"consecutive_readings_sec\":[' || consecutive_readings_sec || ']'",
                   *map(_number, ("consecutive_cycles", "min_wait_sec", "max_wait_sec", "threshold_sec")), _text("event_timestamp"))
_BUNCH_JSON = _json(*map(_text, ("alert_type", "route_id", "bus_1", "bus_2")), *map(_number, ("distance_m", "duration_min", "threshold_m")),
                    _text("event_timestamp"))
_ROUGH_SIGNALS = """rough as (
  select * exclude (junction_id, zone, avg_wait_sec, timestamp),
    case when bad then 'unknown' when event_id % 17 = 3 then 'unknown' else junction_id end as junction_id,
    case when bad then 'Unknown' else zone end as zone,
    case when bad then null when event_id % 17 <> 3 and event_id % 19 = 4 then null else avg_wait_sec end as avg_wait_sec,
    case when event_id % 17 <> 3 and event_id % 19 <> 4 and event_id % 29 = 11 then 'soon' else timestamp end as timestamp
  from (select *, event_id % 37 = 5 or event_id % 41 = 9 as bad from signals)),
waits as (select * from rough where avg_wait_sec is not null)"""
_ROUGH_METERS = """kept_meters as (
  select * from meters where not (event_id % 37 = 5 or event_id % 41 = 9 or event_id % 17 = 3 or event_id % 19 = 4 or event_id % 29 = 11))"""


def _rough_letters(view: str, topic: str, reason: str) -> str:
    return f"""select case when event_id % 37 = 5 or event_id % 41 = 9 then 'MALFORMED_JSON' else {reason} end as error_reason,
  '{topic}' as source_topic, cast(partition as varchar) as partition, cast("offset" as varchar) as "offset",
  case when event_id % 37 = 5 then 'not json ' || event_id when event_id % 41 = 9 then '1' else timestamp end as event from {view}"""


ORACLES: dict[str, str] = {
    "ward_energy": _with("meters", "select * from ward", _WARD),
    "ward_energy_lake": _with("meters", _LAKE, _WARD),
    "ward_energy_stream_update": _with("meters", "select * from ward", _WARD),
    "ward_energy_stream_append": _with("meters", _LAKE + """
where window_end <= (select max(event_time) from meters) - interval '45 minutes'""", _WARD),
    "ward_report_daily": _report("day"),
    "ward_report_weekly": _report("week"),
    "ward_report_monthly": _report("month"),
    "ward_history_one": _with("meters", _LAKE + " where ward_id = 'W03' and window_start >= '2024-01-01'", _WARD),
    "lake_wards": _with("meters", "select distinct ward_id from meters"),
    "low_power_factor": _with("meters", """select ward_id, window_start, window_end, avg_power_factor, 3 as windows_below
from (select *, max(avg_power_factor) over w as top, count(*) over w as n from ward
      window w as (partition by ward_id order by window_start rows between 2 preceding and current row))
where n = 3 and top < 0.85""", _WARD),
    "rolling_aqi": _with("air", f"select zone, window_start, window_end, {_AVERAGES} from rolling", _ROLLING),
    "health_advisories": _ADVISORIES,
    "health_advisories_sql": _ADVISORIES,
    "health_advisories_stream": _ADVISORIES,
    "dlq_air_quality": _with("air", _DLQ_AIR),
    "dlq_bus_gps": _with("gps", _DLQ_GPS),
    "dlq_all": _DLQ_ALL,
    "dlq_stream": _DLQ_ALL,
    "dlq_report": _with("air gps", f"""select error_reason, count(*) as errors from (
{_DLQ_AIR} union all {_DLQ_GPS}) group by error_reason"""),
    "valid_air_quality": _with("air", f"""select "offset", sensor_id, zone, pm25, pm10, no2, aqi, timestamp
from air where {_AIR_REASON} is null"""),
    "valid_bus_gps": _with("gps", f"select {_POSITION} from gps where {_GPS_REASON} is null"),
    "route_enriched": _with("gps routes", _enriched("routes")),
    "route_enriched_inner": _with("gps routes", f"""select {_POSITION}, route_name, terminal,
  scheduled_arrival_time as scheduled_arrival from gps join routes using (route_id)"""),
    "route_enriched_latest": _with("gps changes", _enriched("latest"), _LATEST_CHANGES),
    "route_enriched_stream": _with("gps changes", """select route_id as key, bus_id, route_id, lat, lon, speed_kmh,
  occupancy_pct, timestamp, coalesce(route_name, 'UNKNOWN') as route_name, coalesce(terminal, 'UNKNOWN') as terminal,
  coalesce(scheduled_arrival_time, 'UNKNOWN') as scheduled_arrival_time
from gps left join latest using (route_id)""", _LATEST_CHANGES),
    "route_schedule_latest": _with("changes", "select * from latest", _LATEST_CHANGES),
    "latest_bus_position": _with("gps", f"""select {_POSITION} from gps where {_GPS_REASON} is null
qualify row_number() over (partition by route_id, bus_id order by event_time desc) = 1"""),
    "aqi_emergency": _AQI,
    "aqi_emergency_stream": _AQI,
    "gridlock": _GRID,
    "gridlock_runs_stored": _with("signals", _GRID_SELECT.replace("grid_kept join stuck using (junction_id, event_time)", "stuck"), *_GRID_CTES[:2]),
    "gridlock_stream": _GRID,
    "bus_pair_distance": _with("gps", """select route_id, bus_1, bus_2, event_time, "offset", other_timestamp,
  round(distance_m, 2) as distance_m from apart where distance_m < 200""", *_PAIR_CTES),
    "bus_bunching": _BUNCH,
    "bus_bunching_stream": _BUNCH,
    "incidents": _with("air signals gps", "\nunion all ".join((
        _incident("a", "sensor_id", _AQI_JSON, _AQI_SELECT), _incident("g", "junction_id", _GRID_JSON, _GRID_SELECT),
        _incident("b", "route_id || '_' || bus_1 || '_' || bus_2", _BUNCH_JSON, _BUNCH_SELECT))),
                       *_AQI_CTES, *_GRID_CTES, *_BUNCH_CTES, recursive=True),
    "aqi_emergency_reordered_stream": _on_time("air", "air", 10, _AQI_SELECT, *_AQI_CTES),
    "gridlock_reordered_stream": _on_time("signals", "signals", 10, _GRID_SELECT, *_GRID_CTES),
    "bus_bunching_reordered_stream": _on_time("gps", "gps", 30, _BUNCH_SELECT, *_BUNCH_CTES),
    "bus_bunching_split_stream": _BUNCH,
    "late_air_rows_stream": _late("air", "air_quality", "sensor_id", 10),
    "late_meter_rows_stream": _late("meters", "smart_meters", "ward_id", 2700),
    "gridlock_rough_stream": _with("signals", _GRID_SELECT, _ROUGH_SIGNALS, *[c.replace("from signals", "from waits") for c in _GRID_CTES], recursive=True),
    "ward_energy_rough": _with("meters", "select * from ward", _ROUGH_METERS, _WARD.replace("from meters", "from kept_meters")),
    "ward_energy_records": _with("meters", f"""select ward_id as key, {_json(
        _text("ward_id"), *[f"""'"{c}":"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.000Z') || '"'""" for c in ("window_start", "window_end")],
        *map(_number, ("total_kwh_consumed", "avg_power_factor", "peak_voltage")))} as value from ward""", _WARD),
    "route_schedule_csv": _with("changes", "select * from latest", _LATEST_CHANGES),
    "route_changelog_records": _with("changes", f"""select route_id as key, {_json(*map(_text, (
        "route_id", "route_name", "terminal", "scheduled_arrival_time")))} as value, 'route_schedule' as topic from latest""", _LATEST_CHANGES),
    "dlq_records": _with("air gps", f"""select * from ({_rough_letters("air", "air_quality", _AIR_REASON)}
union all {_rough_letters("gps", "bus_gps", _GPS_REASON)}) where error_reason is not null"""),
    "signal_lanes_lag": _with("", f"{_lags('HIGH_PRIORITY', 1)} union all {_lags('STANDARD_PRIORITY', 4)}"),
    "signal_feed_high": _feed("HIGH_PRIORITY"),
    "signal_feed_standard": _feed("STANDARD_PRIORITY"),
    "signal_lane_high_stream": _feed("HIGH_PRIORITY"),
    "signal_lane_standard_stream": _feed("STANDARD_PRIORITY"),
    "decode_event_time": _with("air", """select "offset", text, try_strptime(text, '%Y-%m-%dT%H:%M:%SZ') as strict_time,
  try_cast(text as timestamp) as iso_time, coalesce(iso_time, event_time) as time_or_arrival
from (select "offset", event_time, case event_id % 4 when 0 then timestamp
      when 1 then substr(timestamp, 1, 19) || 'Z' when 2 then 'not a time' end as text from air)"""),
    "retained_bus_gps": _retained("gps", 1),
    "retained_air_quality": _retained("air", 90),
    "retained_traffic_signals": _retained("signals", 7),
    "retained_smart_meters": _retained("meters", 365),
    "retained_dlq": _retained("air", 30, f", {_AIR_REASON} as error_reason", f"({_AIR_REASON}) is not null"),
}
