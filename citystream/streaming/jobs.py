"""The streaming jobs: the table operators applied to streams, with watermarks and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citystream.operators import advisory, decode, detect, energy, enrich, quality
from citystream.sources.snapshot import ChangelogSnapshot
from citystream.streaming import detectors, reorder, sinks

ADVISORY_TRIGGER = {"processingTime": "30 seconds"}


def ward_energy(raw: DataFrame) -> DataFrame:
    return energy.ward_summary(decode.smart_meters(raw), watermark=energy.WATERMARK)


def start_ward_energy(raw: DataFrame, servers: str, topic: str, lake: str, checkpoints: str) -> list[StreamingQuery]:
    """One aggregate, two sinks: running values to a topic, closed windows to the lake.

    The output modes differ, so these are two queries with a checkpoint each.
    """
    summary = ward_energy(raw)
    return [
        sinks.to_kafka(energy.summary_records(summary), servers, topic, f"{checkpoints}/ward_energy_topic", "update"),
        sinks.to_lake(energy.lake_rows(summary), lake, f"{checkpoints}/ward_energy_lake", ["ward_id", "date"]),
    ]


def health_advisories(raw: DataFrame, zones: DataFrame) -> DataFrame:
    return advisory.advisories(advisory.rolling_aqi(decode.air_quality(raw)), zones)


def health_advisories_sql(spark: SparkSession, raw: DataFrame, zones: DataFrame) -> DataFrame:
    """The same job through SQL; leaves the views behind for further queries."""
    decode.air_quality(raw).withWatermark("event_time", advisory.WATERMARK).createOrReplaceTempView("aqi_stream")
    zones.createOrReplaceTempView("zone_profile")
    return advisory.advisories_sql(spark)


def start_health_advisories(raw: DataFrame, zones: DataFrame, servers: str, topic: str,
                            checkpoint: str) -> StreamingQuery:
    return sinks.to_kafka(advisory.advisory_records(health_advisories(raw, zones)), servers, topic, checkpoint,
                          "update", ADVISORY_TRIGGER)


def rolling_means(raw: DataFrame) -> DataFrame:
    """The sliding means alone, for update mode: every version of a window's mean is written, whatever its level."""
    return advisory.rolling_aqi(decode.air_quality(raw))


def current_advisories(means: DataFrame, zones: DataFrame) -> DataFrame:
    """Advisories from a table of ``rolling_means``: the newest version of each window decides.

    A window whose mean has fallen back below the threshold has none any more.
    """
    newest = sinks.latest_updates(means, ["zone", "window_start", "window_end"])
    return advisory.advisories(newest, zones)


def dead_letters(raw: DataFrame, flag_malformed: bool = False) -> DataFrame:
    """Rejected rows of an envelope stream that mixes the validated topics."""
    return quality.dead_letters_of_mixed(raw, flag_malformed)


def start_dead_letters(raw: DataFrame, servers: str, topic: str, checkpoint: str, flag_malformed: bool = False,
                       trigger: dict | None = None) -> StreamingQuery:
    """Rejected records to a topic, each with its original event nested."""
    return sinks.to_kafka(quality.dlq_json(dead_letters(raw, flag_malformed)), servers, topic, checkpoint, trigger=trigger)


def enriched_gps(raw: DataFrame, schedule: DataFrame) -> DataFrame:
    """Positions with timetable columns; the timetable is fixed when the query starts."""
    return enrich.enriched_records(raw, schedule)


def start_enriched_gps_to_topic(raw: DataFrame, read_changes: Callable[[], DataFrame], snapshot: ChangelogSnapshot,
                                send: Callable[[DataFrame], None], sent: Callable[[], DataFrame] | None, path: str, checkpoint: str,
                                trigger: dict | None = None) -> StreamingQuery:
    """Positions with timetable columns to a topic, each once; every micro-batch takes in the changelog's new records only."""
    def enriched(batch: DataFrame) -> DataFrame:
        snapshot.advance(read_changes())
        schedule = enrich.schedule_from_content(snapshot.content())
        return enrich.enriched_records(batch, schedule, carry=[sinks.DEDUPLICATION])

    return sinks.to_topic_once(raw, send, sent, path, checkpoint, trigger, enriched)


def start_enriched_gps(raw: DataFrame, read_changes: Callable[[], DataFrame], path: str, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Positions with timetable columns; the changelog is read anew for every micro-batch."""
    return sinks.to_table(
        raw, path, checkpoint, trigger=trigger,
        each_batch=lambda batch: enrich.enriched_records(batch, enrich.schedule_from_topic(read_changes())))


def reordered_alerts(raw: DataFrame, topic: str, path: str, trigger: dict, bound_ms: int | None = None) -> DataFrame:
    """The alerts of a bounded replay whose records come out of order: back into order first, then the rule, as two streams.

    A running system starts ``reorder.start`` and the rule on ``reorder.released`` as queries side by side.
    """
    spark = raw.sparkSession
    sinks.await_all(reorder.start(raw, path, f"{path}/checkpoint", reorder.BOUND_MS[topic] if bound_ms is None else bound_ms, trigger))
    reorder.drain(spark, path)
    return alerts(reorder.released(spark, path), topic)


DETECTORS = {
    "air_quality": detectors.aqi_emergencies,
    "traffic_signals": detectors.gridlocks,
    "bus_gps": detectors.bus_bunching,
}


def alerts(raw: DataFrame, topic: str, **how) -> DataFrame:
    """The alerts of one topic's rule, each with the columns of its kind."""
    return DETECTORS[topic](decode.detector_input(raw, topic), **how)


def start_detectors(read: Callable[[str], DataFrame], servers: str, topic: str, checkpoints: str,
                    trigger: dict | None = None) -> list[StreamingQuery]:
    """All rules, one query and checkpoint each, into one topic of incidents."""
    return [
        sinks.to_kafka(detect.alert_records(alerts(read(source), source)), servers, topic,
                       f"{checkpoints}/{source}_alerts", trigger=trigger)
        for source in DETECTORS
    ]
