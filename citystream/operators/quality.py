"""Validation rules per topic, dead-letter rows, and the error report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream import schemas
from citystream.operators.decode import once

# Per topic: (reason, condition), the first one that holds names the error.
RULES: dict[str, list[tuple[str, str]]] = {
    "air_quality": [
        ("NULL_AQI", "aqi is null"),
        ("AQI_OUT_OF_RANGE", "(aqi < 0 or aqi > 500) and not isnan(aqi)"),
    ],
    "bus_gps": [
        ("NULL_GPS_COORDINATE", "lat is null or lon is null"),
        ("INVALID_GPS_COORDINATES", "((lat < -90 or lat > 90) and not isnan(lat)) or ((lon < -180 or lon > 180) and not isnan(lon))"),
    ],
}
MALFORMED = "MALFORMED_JSON"
UNTIMED = "NULL_EVENT_TIME"


def error_reason(topic: str) -> Column:
    """NULL for a valid row; topics without rules have only valid rows."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(RULES.get(topic, [])):
        reason = F.when(F.expr(condition), F.lit(name)).otherwise(reason)
    return reason


def is_json_object(text: Column) -> Column:
    return F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT").eqNullSafe(F.lit(True))


def check(df: DataFrame, topic: str, flag_malformed: bool = False) -> DataFrame:
    """Adds ``error_reason``.

    With ``flag_malformed``, text in ``value`` that is not a JSON object is reported as such
    instead of as missing values.
    """
    reason = error_reason(topic)
    if flag_malformed:
        reason = F.when(~is_json_object(F.col("value")), F.lit(MALFORMED)).otherwise(reason)
    return df.withColumn("error_reason", reason)


def valid_rows(df: DataFrame, topic: str) -> DataFrame:
    return check(df, topic).where(F.col("error_reason").isNull()).drop("error_reason")


def dead_letters(df: DataFrame, topic: str, original: Column | None = None,
                 flag_malformed: bool = False) -> DataFrame:
    """Rejected rows in one layout for all topics; the event itself is kept as JSON text.

    ``original`` defaults to the text in ``value`` where the frame has it, so that the value that caused the
    rejection is kept, else to the payload rebuilt from the typed columns, with nulls kept.
    """
    if original is None and dict(df.dtypes).get("value") == "string":
        original = F.col("value")
    if original is None:
        original = F.to_json(F.struct(*schemas.BY_TOPIC[topic].fieldNames()), {"ignoreNullFields": "false"})
    return check(df, topic, flag_malformed).where(F.col("error_reason").isNotNull()).select(
        "error_reason",
        F.lit(topic).alias("source_topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        original.alias("original_event"))


def untimed(df: DataFrame, topic: str) -> DataFrame:
    """Rows whose event time is unknown, in the layout of dead letters: the ordered rules cannot place them."""
    original = F.to_json(F.struct(*schemas.BY_TOPIC[topic].fieldNames()), {"ignoreNullFields": "false"})
    return df.where(F.col("event_time").isNull()).select(
        F.lit(UNTIMED).alias("error_reason"), F.lit(topic).alias("source_topic"), F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"), original.alias("original_event"))


def all_dead_letters(by_topic: dict[str, DataFrame], **how) -> DataFrame:
    parts = [dead_letters(df, topic, **how) for topic, df in by_topic.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def dead_letters_of_mixed(raw: DataFrame, flag_malformed: bool = False) -> DataFrame:
    """Rejected records of an envelope that mixes topics: one pass, one parse per record.

    Only the fields the rules look at are parsed; the event is passed on as it came.
    """
    needed = T.StructType([schemas.AIR_QUALITY["aqi"], schemas.BUS_GPS["lat"], schemas.BUS_GPS["lon"]])
    reason = F.lit(None).cast("string")
    for topic in RULES:
        reason = F.when(F.col("topic") == topic, error_reason(topic)).otherwise(reason)
    if flag_malformed:
        reason = F.when(F.col("topic").isin(list(RULES)) & ~is_json_object(F.col("value")),
                        F.lit(MALFORMED)).otherwise(reason)
    parsed = raw.select("topic", "partition", "offset", "value", once(F.from_json("value", needed)))
    return parsed.withColumn("error_reason", reason).where(F.col("error_reason").isNotNull()).select(
        "error_reason", F.col("topic").alias("source_topic"), "partition", "offset",
        F.col("value").alias("original_event"))


def dlq_json(dlq: DataFrame) -> DataFrame:
    """Dead letters as outgoing records, the original event nested rather than quoted.

    Text that is no JSON stays a quoted string.
    """
    return dlq.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(
            "error_reason", "source_topic", "partition", "offset",
            F.expr("coalesce(try_parse_json(original_event), to_variant_object(array(original_event)))")
            .alias("original_event")), {"ignoreNullFields": "false"}).alias("value"))


def reasons_of_topic(raw: DataFrame) -> DataFrame:
    """``error_reason`` of outgoing dead-letter records, NULL where a record has none."""
    return raw.select(F.get_json_object("value", "$.error_reason").alias("error_reason"))


def error_report(dlq: DataFrame) -> DataFrame:
    reason = F.coalesce(F.col("error_reason"), F.lit("UNKNOWN"))
    return dlq.groupBy(reason.alias("error_reason")).agg(F.count(F.lit(1)).alias("errors"))
