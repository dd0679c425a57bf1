"""JSON text to typed rows with an event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream import schemas
from citystream.functions import times

CARRIED = ["topic", "partition", "offset"]


def from_json_value(raw: DataFrame, schema: T.StructType, carry: list[str] | None = None) -> DataFrame:
    """Permissive decode: malformed text or a mistyped field becomes NULL, never an error.

    The transport time is kept as ``arrived_at``, since the payload has its own ``timestamp``.
    """
    carried = [c for c in (CARRIED if carry is None else carry) if c in raw.columns]
    arrived = [F.col("timestamp").alias("arrived_at")] if "timestamp" in raw.columns else []
    return raw.select(*carried, *arrived, "value", once(F.from_json(F.col("value").cast("string"), schema)))


def once(parsed: Column) -> Column:
    """The fields of a parsed struct as columns.

    Going through a generator keeps later filters above the parse. As a plain projection they
    would be pushed below it, and every condition would parse the text again.
    """
    return F.inline_outer(F.array(parsed))


def with_event_time(df: DataFrame, parse=times.iso) -> DataFrame:
    """Adds ``event_time`` and drops the rows whose text does not parse."""
    return df.withColumn("event_time", parse(F.col("timestamp"))).where(F.col("event_time").isNotNull())


def with_event_time_or_arrival(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", times.iso_or(F.col("timestamp"), F.col("arrived_at")))


def smart_meters(raw: DataFrame) -> DataFrame:
    df = from_json_value(raw, schemas.SMART_METERS)
    return with_event_time(usable_meter_readings(df), times.strict_utc)


def air_quality(raw: DataFrame) -> DataFrame:
    return with_event_time(usable_air_readings(from_json_value(raw, schemas.AIR_QUALITY)))


def detector_input(raw: DataFrame, topic: str) -> DataFrame:
    """Alert rules see every decodable record and fall back to its transport time."""
    return with_event_time_or_arrival(from_json_value(raw, schemas.BY_TOPIC[topic]))


def usable_meter_readings(df: DataFrame) -> DataFrame:
    return df.where(F.col("ward_id").isNotNull() & F.col("kwh_consumed").isNotNull())


def usable_air_readings(df: DataFrame) -> DataFrame:
    return df.where(F.col("zone").isNotNull() & F.col("aqi").isNotNull() & F.col("aqi").between(0, 500))


def or_default(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))
