"""Record layouts of the input streams and reference tables."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()

BUS_GPS = _struct(
    ("bus_id", _S), ("route_id", _S), ("lat", _D), ("lon", _D),
    ("speed_kmh", _I), ("occupancy_pct", _I), ("timestamp", _S),
)
AIR_QUALITY = _struct(
    ("sensor_id", _S), ("zone", _S), ("pm25", _D), ("pm10", _D), ("no2", _D),
    ("aqi", _D), ("timestamp", _S),
)
TRAFFIC_SIGNALS = _struct(
    ("junction_id", _S), ("zone", _S), ("vehicle_count", _I), ("avg_wait_sec", _D),
    ("signal_phase", _S), ("timestamp", _S),
)
SMART_METERS = _struct(
    ("meter_id", _S), ("ward_id", _S), ("kwh_consumed", _D), ("power_factor", _D),
    ("voltage", _D), ("timestamp", _S),
)
ROUTE_SCHEDULE = _struct(
    ("route_id", _S), ("route_name", _S), ("terminal", _S), ("scheduled_arrival_time", _S),
)
ZONE_PROFILE = _struct(
    ("zone", _S), ("zone_name", _S), ("population", _I), ("num_schools", _I),
    ("num_hospitals", _I), ("area_sq_km", _I),
)
# Transport record: what a broker source yields, and what file replays carry as columns.
ENVELOPE = _struct(
    ("key", _S), ("value", _S), ("topic", _S), ("partition", _I), ("offset", _L),
    ("timestamp", T.TimestampType()),
)

BY_TOPIC = {
    "bus_gps": BUS_GPS,
    "air_quality": AIR_QUALITY,
    "traffic_signals": TRAFFIC_SIGNALS,
    "smart_meters": SMART_METERS,
    "route_schedule": ROUTE_SCHEDULE,
}
