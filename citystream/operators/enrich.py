"""Adding timetable columns to bus positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream import schemas
from citystream.operators.decode import once
from citystream.operators.latest import compact, latest_by_key
from citystream.operators.quality import is_json_object

ADDED = ["route_name", "terminal", "scheduled_arrival_time"]
FAILED = '{"error":"ENRICHMENT_FAILED"}'


def current_schedule(changes: DataFrame) -> DataFrame:
    """Typed changelog rows (with ``offset``) to one row per route."""
    return latest_by_key(changes.select("route_id", *ADDED, "offset"), ["route_id"], ["offset"], unique=True).drop("offset")


def schedule_from_topic(raw: DataFrame) -> DataFrame:
    """Changelog envelope to a table keyed by the record key."""
    return schedule_from_content(compact(raw))


def schedule_from_content(compacted: DataFrame) -> DataFrame:
    """A changelog's content, one record per key, to a table keyed by the record key."""
    content = compacted.select("key", once(F.from_json("value", schemas.ROUTE_SCHEDULE)))
    return content.select(F.col("key").alias("route_id"), *ADDED)


def with_route(gps: DataFrame, schedule: DataFrame) -> DataFrame:
    """Every position; routes missing from the timetable get ``UNKNOWN``."""
    found = schedule.select("route_id", *ADDED, F.lit(True).alias("_found"))
    joined = gps.join(found, "route_id", "left")
    filled = {c: F.when(F.col("_found"), F.col(c)).otherwise(F.lit("UNKNOWN")) for c in ADDED}
    return joined.withColumns(filled).drop("_found").select(*gps.columns, *ADDED)


def with_known_route(gps: DataFrame, schedule: DataFrame) -> DataFrame:
    """Only positions of routes in the timetable; here the column is ``scheduled_arrival``."""
    return gps.join(schedule.select("route_id", *ADDED), "route_id").select(
        *gps.columns, "route_name", "terminal", F.col("scheduled_arrival_time").alias("scheduled_arrival"))


def enriched_records(raw_gps: DataFrame, schedule: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Envelope in, outgoing records out: text join on the record key.

    A payload that is no JSON object, or a matched timetable row that lacks a field, becomes
    the fixed error record instead of failing the job. The event's own text is kept as it came, fields the
    schema does not know included; the timetable's fields are put before its closing brace. ``carry`` names columns to keep.
    """
    carried = [c for c in carry if c in raw_gps.columns]
    gps = raw_gps.select("key", "value", *carried, is_json_object(F.col("value")).alias("_ok"))
    found = schedule.select(F.col("route_id").alias("key"), *ADDED, F.lit(True).alias("_found"))
    joined = gps.join(found, "key", "left")
    usable = F.lit(True)
    for c in ADDED:
        usable &= F.col(c).isNotNull()
    usable |= F.col("_found").isNull()
    filled = [F.when(F.col("_found"), F.col(c)).otherwise(F.lit("UNKNOWN")).alias(c) for c in ADDED]
    own = F.regexp_replace("value", r"\s*\}\s*$", "")
    added = F.substr(F.to_json(F.struct(*filled), {"ignoreNullFields": "false"}), F.lit(2))
    text = F.concat(own, F.when(F.rlike(own, F.lit(r"^\s*\{$")), F.lit("")).otherwise(F.lit(",")), added)
    return joined.select(
        "key", F.when(F.col("_ok") & usable, text).otherwise(F.lit(FAILED)).alias("value"), *carried)
