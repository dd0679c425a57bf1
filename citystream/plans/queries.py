"""Named queries over the driver's ``events`` table, one per capability."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas
from citystream.functions import times
from citystream.operators import advisory, decode, detect, energy, enrich, feed, proximity, quality, retention
from citystream.operators.decode import usable_air_readings, usable_meter_readings
from citystream.operators.latest import latest_by_key
from citystream.session import cut, scratch
from citystream.plans import city, replay
from citystream.sources import ordered_store, streams, tables
from citystream.sources.snapshot import ChangelogSnapshot
from citystream.streaming import bunching, jobs, lanes, reorder, sinks

NOW = {"availableNow": True}
AVG_DP = 9
POSITION = ["offset", "bus_id", "route_id", "lat", "lon", "speed_kmh", "occupancy_pct", "event_time"]
KEY_OF = replay.KEY_OF


def _view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.VIEWS[name](city.events(spark, sf_dir))


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _rounded(df: DataFrame, dp: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, dp) for c in columns})


# -- ward energy ---------------------------------------------------------------------------

def _ward_result(df: DataFrame) -> DataFrame:
    df = _rounded(_rounded(df, AVG_DP, "avg_power_factor"), 3, "total_kwh_consumed")
    return _naive(df, "window_start", "window_end")


def _summary(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return energy.ward_summary(usable_meter_readings(_view("smart_meters", spark, sf_dir)), **how)


def ward_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ward_result(_summary(spark, sf_dir))


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "ward-energy-lake")
    summary = _summary(spark, sf_dir)
    energy.write_lake(summary, path)
    schema = energy.lake_rows(summary).withColumn("date", F.col("date").cast("string")).schema
    return tables.read_lake(spark, path, schema)


def ward_energy_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ward_result(_lake(spark, sf_dir)).select(*energy.SUMMARY, "date")


def ward_history_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = energy.ward_history(_lake(spark, sf_dir), "W03", first_date="2024-01-01")
    return _ward_result(found).select(*energy.SUMMARY, "date")


def lake_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.lake_wards(_lake(spark, sf_dir))


def _report(period: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = energy.ward_report(_summary(spark, sf_dir, with_weights=True), period)
        return _rounded(_rounded(report, AVG_DP, "avg_power_factor"), 3, "total_kwh_consumed")
    return query


def low_power_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect.low_power_factor(_summary(spark, sf_dir, exact=True), energy.POWER_FACTOR_FLOOR, 3)
    return _rounded(found, AVG_DP, "avg_power_factor")


# -- streams -------------------------------------------------------------------------------

def _raw(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The topic as JSON records, read as a stream."""
    typed = city.VIEWS[topic](city.events_stream(spark, sf_dir))
    return streams.as_envelope(typed, topic, schemas.BY_TOPIC[topic].fieldNames(), key=KEY_OF.get(topic))


def _replay(rows: DataFrame, mode: str = "append", **how) -> DataFrame:
    """Runs a stream over all input there is and returns what it wrote."""
    spark = rows.sparkSession
    path = scratch(spark, "replay")
    with sinks.state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = sinks.to_table(rows, f"{path}/table", f"{path}/checkpoint", mode, NOW, **how)
    sinks.await_all(query)
    return sinks.read_table(spark, f"{path}/table", None if how else rows.schema)


def ward_energy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ward summaries as the keyed JSON records of the outgoing topic."""
    df = _rounded(_rounded(_summary(spark, sf_dir), AVG_DP, "avg_power_factor"), 3, "total_kwh_consumed")
    return energy.summary_records(df.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")}))


def timetable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last version of every route, a line each; of two lines of a route the last counts."""
    changes = city.schedule_changes(city.events(spark, sf_dir)).select("route_id", *enrich.ADDED, "offset")
    newest = enrich.current_schedule(changes)
    oldest = latest_by_key(changes.withColumn("_back", -F.col("offset")), ["route_id"], ["_back"], unique=True).select(*newest.columns)
    # a small reference table: two lines a route, in one file, where the order of lines has a meaning; only these lines go
    # to one task, the changes they are chosen from are read by all
    return (oldest.withColumn("line", F.lit(0)).unionByName(newest.withColumn("line", F.lit(1))).repartition(1).sortWithinPartitions("line")
            .select("route_id", *enrich.ADDED))


def route_schedule_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timetable kept as CSV: the first and the last version of every route, of which the last line counts."""
    path = scratch(spark, "timetable")
    timetable_lines(spark, sf_dir).write.option("header", "true").csv(path)
    return tables.route_schedule(spark, path)


def route_changelog_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current timetable as keyed records for its changelog topic."""
    return tables.changelog(route_schedule_latest(spark, sf_dir), "route_id", "route_schedule")


def _rough(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The topic's records with missing fields, nulls, unreadable times and malformed text among them."""
    raw = streams.as_envelope(_view(topic, spark, sf_dir), topic, schemas.BY_TOPIC[topic].fieldNames(), key=KEY_OF.get(topic))
    return raw.withColumn("value", F.expr(city.ROUGH[topic]))


def gridlock_rough_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "traffic_signals").withColumn("value", F.expr(city.ROUGH["traffic_signals"]))
    return _gridlock_result(_replay(jobs.alerts(raw, "traffic_signals")))


def ward_energy_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ward_result(energy.ward_summary(decode.smart_meters(_rough(spark, sf_dir, "smart_meters"))))


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of rough topics, malformed text among them, as outgoing records with the original event nested."""
    raw = _rough(spark, sf_dir, "air_quality").unionByName(_rough(spark, sf_dir, "bus_gps"))
    sent = quality.dlq_json(jobs.dead_letters(raw, flag_malformed=True))
    event = F.coalesce(F.get_json_object("value", "$.original_event[0]"), F.get_json_object("value", "$.original_event.timestamp"))
    fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in ("error_reason", "source_topic", "partition", "offset")]
    return sent.select(*fields, event.alias("event"))


def ward_energy_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _replay(jobs.ward_energy(_raw(spark, sf_dir, "smart_meters")), "update")
    return _ward_result(sinks.latest_updates(written, ["ward_id", "window_start", "window_end"]))


def ward_energy_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.ward_energy(_raw(spark, sf_dir, "smart_meters"))
    path = scratch(spark, "replay")
    with sinks.state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = sinks.to_lake(energy.lake_rows(rows), f"{path}/lake", f"{path}/checkpoint", ["ward_id", "date"], NOW)
    sinks.await_all(query)
    lake = tables.read_lake(spark, f"{path}/lake", energy.lake_rows(rows).schema)
    return _ward_result(lake).select(*energy.SUMMARY, "date")


def health_advisories_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches; windows that several of them change have several versions, of which the newest counts."""
    means = _replay(jobs.rolling_means(replay.in_order(spark, sf_dir, "air_quality")), "update")
    return _advisory_result(jobs.current_advisories(means, tables.zone_profile(spark)))


def dlq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "air_quality").unionByName(_raw(spark, sf_dir, "bus_gps"))
    return _replay(jobs.dead_letters(raw)).drop("batch_id")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = city.schedule_changes(city.events(spark, sf_dir)).withColumn("partition", F.lit(0))
    return streams.as_envelope(typed, "route_schedule", schemas.ROUTE_SCHEDULE.fieldNames(), key="route_id")


def route_enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions to a topic in four micro-batches, each joined with the changelog's content as it stands then."""
    path = scratch(spark, "enriched")
    query = jobs.start_enriched_gps_to_topic(
        replay.in_order(spark, sf_dir, "bus_gps"), lambda: _changes(spark, sf_dir), ChangelogSnapshot(spark, f"{path}/snapshot"),
        lambda rows: rows.write.mode("append").parquet(f"{path}/topic"), lambda: spark.read.parquet(f"{path}/topic"),
        path, f"{path}/checkpoint", NOW)
    sinks.await_all(query)
    wide = schemas._struct(*[(f.name, f.dataType) for f in schemas.BUS_GPS],
                           *[(c, schemas.ROUTE_SCHEDULE[c].dataType) for c in enrich.ADDED])
    rows = spark.read.schema("key string, value string").parquet(f"{path}/topic")
    return rows.select("key", F.from_json("value", wide).alias("d")).select("key", "d.*")


def _reordered(topic: str, result: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Six micro-batches of records out of order; a few come so late that they raise no alert."""
        raw = replay.disordered(spark, sf_dir, topic)
        return result(_replay(jobs.reordered_alerts(raw, topic, scratch(spark, "reordered"), NOW)))
    return query


def bus_bunching_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches whose rows, also those of one route, are spread over all tasks."""
    path = scratch(spark, "bunching")
    sinks.await_all(bunching.start(replay.in_order(spark, sf_dir, "bus_gps"), path, f"{path}/checkpoint", NOW))
    return bunching.alerts(spark, path).select(*detect.BUNCHING_ALERT)


def _late(topic: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The records that came behind the topic's bound, as dead letters."""
        path = scratch(spark, "late")
        sinks.await_all(reorder.start(replay.disordered(spark, sf_dir, topic), path, f"{path}/checkpoint", reorder.BOUND_MS[topic], NOW))
        field = {"smart_meters": "ward_id", "air_quality": "sensor_id"}[topic]
        return reorder.late_records(spark, path).select(
            "error_reason", "source_topic", "partition", "offset", F.get_json_object("original_event", f"$.{field}").alias("subject"))
    return query


def signal_lanes_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readers of one topic: one takes all there is at once, one a stretch at a time; how far each is behind after each batch."""
    path, n = replay.written(city.traffic_signals(city.events(spark, sf_dir)), "traffic_signals", 4, F.col("event_id") * 10)
    total = city.events(spark, sf_dir).count()
    out, rows = scratch(spark, "lanes"), []
    queries = {lane: lanes.start_lane(streams.from_files(spark, path, max_files=limit), lane, f"{out}/{lane}", f"{out}/checkpoint-{lane}", NOW)
               for lane, limit in ((lanes.HIGH, None), (lanes.STANDARD, n))}
    for lane, query in queries.items():
        query.awaitTermination()
        rows += lanes.lag(lane, query, total)
    return spark.createDataFrame(rows, "lane string, batch int, n_rows long, behind long")


def aqi_emergency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(jobs.alerts(_raw(spark, sf_dir, "air_quality"), "air_quality")).select(*detect.AQI_ALERT)


def gridlock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gridlock_result(_replay(jobs.alerts(_raw(spark, sf_dir, "traffic_signals"), "traffic_signals")))


def bus_bunching_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(jobs.alerts(_raw(spark, sf_dir, "bus_gps"), "bus_gps")).select(*detect.BUNCHING_ALERT)


def _lane(lane: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _replay(lanes.lane_feed(_raw(spark, sf_dir, "traffic_signals"), lane)).drop("batch_id")
    return query


# -- air quality ---------------------------------------------------------------------------

def _air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable_air_readings(_view("air_quality", spark, sf_dir))


def _advisory_result(df: DataFrame) -> DataFrame:
    return _naive(_rounded(df, AVG_DP, *advisory.METRICS.values()), "window_start", "window_end")


def rolling_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _advisory_result(advisory.rolling_aqi_from_panes(_air(spark, sf_dir)))


def health_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolling = advisory.rolling_aqi_from_panes(_air(spark, sf_dir))
    return _advisory_result(advisory.advisories(rolling, tables.zone_profile(spark)))


def health_advisories_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    # names of this call alone, so that two calls on two folders do not change each other's views
    names = [f"{v}_{uuid.uuid4().hex}" for v in ("aqi_stream", "zone_profile", "rolling_aqi")]
    _view("air_quality", spark, sf_dir).createOrReplaceTempView(names[0])
    tables.zone_profile(spark).createOrReplaceTempView(names[1])
    return _advisory_result(advisory.advisories_sql(spark, *names))


# -- data quality --------------------------------------------------------------------------

def _dlq(*topics: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.all_dead_letters({t: _view(t, spark, sf_dir) for t in topics})
    return query


def dlq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.error_report(_dlq("air_quality", "bus_gps")(spark, sf_dir))


def _valid(topic: str, columns: Sequence[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.valid_rows(_view(topic, spark, sf_dir), topic).select(*columns)
    return query


# -- enrichment ----------------------------------------------------------------------------

def route_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps = _view("bus_gps", spark, sf_dir).select(*POSITION)
    return enrich.with_route(gps, tables.route_schedule(spark))


def route_enriched_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps = _view("bus_gps", spark, sf_dir).select(*POSITION)
    return enrich.with_known_route(gps, tables.route_schedule(spark))


def route_enriched_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_route(_view("bus_gps", spark, sf_dir).select(*POSITION),
                             cut(route_schedule_latest(spark, sf_dir)))


def route_schedule_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.current_schedule(city.schedule_changes(city.events(spark, sf_dir)))


def latest_bus_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps = quality.valid_rows(_view("bus_gps", spark, sf_dir), "bus_gps").select(*POSITION)
    return latest_by_key(gps, ["route_id", "bus_id"], ["event_time", "offset"], unique=True)


# -- incidents -----------------------------------------------------------------------------

def aqi_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.aqi_emergencies(_view("air_quality", spark, sf_dir)).select(*detect.AQI_ALERT)


def _gridlock_result(df: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("consecutive_readings_sec").cast("array<string>"), ",")
    return df.withColumn("consecutive_readings_sec", listed).select(*detect.GRIDLOCK_ALERT)


def gridlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gridlock_result(detect.gridlocks(_view("traffic_signals", spark, sf_dir)))


def _signal_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detect.gridlock_input(_view("traffic_signals", spark, sf_dir))
    return ordered_store.write(rows, scratch(spark, "signals-in-order"), ["junction_id"], "event_time", "offset")


def gridlock_runs_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of long waits, before alerts are thinned, of signals kept in order on disk; read without a shuffle or a sort."""
    runs = detect.consecutive_above(_signal_store(spark, sf_dir), ["junction_id"], "avg_wait_sec", "event_time", "offset",
                                    detect.WAIT_LIMIT_SEC, detect.WAIT_CYCLES)
    return _gridlock_result(detect.gridlock_alert_columns(runs))


def bus_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = proximity.contacts(_view("bus_gps", spark, sf_dir))
    return _rounded(met.select(*proximity.PAIR, "event_time", "offset", "other_timestamp", "distance_m"),
                    2, "distance_m")


def bus_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.bus_bunching(_view("bus_gps", spark, sf_dir)).select(*detect.BUNCHING_ALERT)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no rule needs another's steps, so those of one run while another's last tasks do
    rules = ((detect.aqi_emergencies, "air_quality"), (detect.gridlocks, "traffic_signals"), (proximity.bus_bunching, "bus_gps"))
    with ThreadPoolExecutor(len(rules)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(copy_context().run), rule, _view(topic, spark, sf_dir)) for rule, topic in rules]
        return detect.incidents(*[one.result() for one in begun])


# -- single functions ----------------------------------------------------------------------

def _feed(lane: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feed.signal_feed(_view("traffic_signals", spark, sf_dir), lane).select("offset", "line")
    return query


def decode_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time texts of every shape a producer may send, through the three parsers."""
    text = F.expr("case event_id % 4 when 0 then timestamp when 1 then substr(timestamp, 1, 19) || 'Z' "
                  "when 2 then 'not a time' end")
    made = _view("air_quality", spark, sf_dir).select("offset", text.alias("text"), "event_time")
    parsed = made.select(
        "offset", "text", times.strict_utc(F.col("text")).alias("strict_time"),
        times.iso(F.col("text")).alias("iso_time"),
        times.iso_or(F.col("text"), F.col("event_time").cast("timestamp")).alias("time_or_arrival"))
    return _naive(parsed, "strict_time", "iso_time", "time_or_arrival")


def _retained(topic: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return retention.retained(_view(topic, spark, sf_dir).select("offset", "ts"), topic)
    return query


def retained_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.check(_view("air_quality", spark, sf_dir), "air_quality").where("error_reason is not null")
    return retention.retained(bad.select("offset", "ts", "error_reason"), "dlq")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ward_energy": ward_energy,
    "ward_energy_lake": ward_energy_lake,
    "ward_energy_stream_update": ward_energy_stream_update,
    "ward_energy_stream_append": ward_energy_stream_append,
    "ward_report_daily": _report("day"),
    "ward_report_weekly": _report("week"),
    "ward_report_monthly": _report("month"),
    "ward_history_one": ward_history_one,
    "lake_wards": lake_wards,
    "low_power_factor": low_power_factor,
    "rolling_aqi": rolling_aqi,
    "health_advisories": health_advisories,
    "health_advisories_sql": health_advisories_sql,
    "health_advisories_stream": health_advisories_stream,
    "dlq_air_quality": _dlq("air_quality"),
    "dlq_bus_gps": _dlq("bus_gps"),
    "dlq_all": _dlq("air_quality", "bus_gps"),
    "dlq_stream": dlq_stream,
    "dlq_report": dlq_report,
    "valid_air_quality": _valid("air_quality", ["offset", "sensor_id", "zone", "pm25", "pm10", "no2", "aqi", "timestamp"]),
    "valid_bus_gps": _valid("bus_gps", POSITION),
    "route_enriched": route_enriched,
    "route_enriched_inner": route_enriched_inner,
    "route_enriched_latest": route_enriched_latest,
    "route_enriched_stream": route_enriched_stream,
    "route_schedule_latest": route_schedule_latest,
    "latest_bus_position": latest_bus_position,
    "aqi_emergency": aqi_emergency,
    "aqi_emergency_stream": aqi_emergency_stream,
    "gridlock": gridlock,
    "gridlock_runs_stored": gridlock_runs_stored,
    "gridlock_stream": gridlock_stream,
    "bus_pair_distance": bus_pair_distance,
    "bus_bunching": bus_bunching,
    "bus_bunching_stream": bus_bunching_stream,
    "incidents": incidents,
    "aqi_emergency_reordered_stream": _reordered("air_quality", lambda df: df.select(*detect.AQI_ALERT)),
    "gridlock_reordered_stream": _reordered("traffic_signals", lambda df: _gridlock_result(df)),
    "bus_bunching_reordered_stream": _reordered("bus_gps", lambda df: df.select(*detect.BUNCHING_ALERT)),
    "bus_bunching_split_stream": bus_bunching_split_stream,
    "late_air_rows_stream": _late("air_quality"),
    "late_meter_rows_stream": _late("smart_meters"),
    "gridlock_rough_stream": gridlock_rough_stream,
    "ward_energy_rough": ward_energy_rough,
    "ward_energy_records": ward_energy_records,
    "route_schedule_csv": route_schedule_csv,
    "route_changelog_records": route_changelog_records,
    "dlq_records": dlq_records,
    "signal_lanes_lag": signal_lanes_lag,
    "signal_feed_high": _feed(lanes.HIGH),
    "signal_feed_standard": _feed(lanes.STANDARD),
    "signal_lane_high_stream": _lane(lanes.HIGH),
    "signal_lane_standard_stream": _lane(lanes.STANDARD),
    "decode_event_time": decode_event_time,
    "retained_bus_gps": _retained("bus_gps"),
    "retained_air_quality": _retained("air_quality"),
    "retained_traffic_signals": _retained("traffic_signals"),
    "retained_smart_meters": _retained("smart_meters"),
    "retained_dlq": retained_dlq,
}
