"""Decoding, validation, enrichment, aggregates, retention."""

import json

import pytest
from helpers import T0, air, at, frame
from pyspark.sql import functions as F

from citystream import schemas
from citystream.functions import levels, times
from citystream.functions.json_rows import compact_json, full_json
from citystream.operators import advisory, decode, detect, energy, enrich, feed, latest, quality, retention
from citystream.sources import streams, tables

RAW = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def raw(spark, topic, values, keys=None):
    return frame(spark, [(keys[i] if keys else None, v if v is None or isinstance(v, str) else json.dumps(v),
                          topic, 0, i, T0) for i, v in enumerate(values)], RAW)


def test_time_parsers(spark):
    texts = ["2024-03-01T00:00:05Z", "2024-03-01T00:00:05.123456", "garbage", "", None]
    got = frame(spark, [(t,) for t in texts], "t string").select(
        times.strict_utc(F.col("t")), times.iso(F.col("t")), times.iso_or(F.col("t"), F.lit(T0))).collect()
    late = at(5.123456)
    assert [tuple(r) for r in got] == [(at(5), at(5), at(5)), (None, late, late)] + [(None, None, T0)] * 3


def test_decode_never_fails(spark):
    texts = ['{"sensor_id":"a","zone":"N","aqi":"7","timestamp":"2024-03-01T00:00:00"}', '{"aqi": ', "[1]", "", None,
             '{"sensor_id":"b","zone":"N","aqi":7,"timestamp":"2024-03-01T00:00:00","more":1}']
    rows = decode.from_json_value(raw(spark, "air_quality", texts), schemas.AIR_QUALITY).collect()
    assert [r.aqi for r in rows] == [None, None, None, None, None, 7.0]
    assert rows[0].zone == "N"
    assert [r.sensor_id for r in decode.air_quality(raw(spark, "air_quality", texts)).collect()] == ["b"]


def test_meter_times_are_strict(spark):
    base = {"meter_id": "M", "ward_id": "W01", "kwh_consumed": 1.0, "power_factor": .9, "voltage": 230.0}
    values = [{**base, "timestamp": t} for t in ("2024-03-01T00:00:05Z", "2024-03-01T00:00:05", "x")]
    values += [{**base, "ward_id": None, "timestamp": "2024-03-01T00:00:05Z"},
               {**base, "kwh_consumed": None, "timestamp": "2024-03-01T00:00:05Z"}]
    assert decode.smart_meters(raw(spark, "smart_meters", values)).count() == 1


def test_detector_input_falls_back_to_arrival(spark):
    got = decode.detector_input(raw(spark, "air_quality", [{"sensor_id": "a", "aqi": 400, "timestamp": "?"}]), "air_quality")
    assert got.first().event_time == T0


@pytest.mark.parametrize("aqi,reason", [(None, "NULL_AQI"), (-0.1, "AQI_OUT_OF_RANGE"), (0, None), (500, None),
                                        (500.1, "AQI_OUT_OF_RANGE")])
def test_air_rules(spark, aqi, reason):
    assert quality.check(air(spark, [("a", 0, aqi)]), "air_quality").first().error_reason == reason


@pytest.mark.parametrize("lat,lon,reason", [
    (None, 0.0, "NULL_GPS_COORDINATE"), (0.0, None, "NULL_GPS_COORDINATE"), (90.0, 180.0, None), (-90.0, -180.0, None),
    (90.1, 0.0, "INVALID_GPS_COORDINATES"), (0.0, -180.1, "INVALID_GPS_COORDINATES"), (None, 999.0, "NULL_GPS_COORDINATE")])
def test_gps_rules(spark, lat, lon, reason):
    df = frame(spark, [(lat, lon)], "lat double, lon double")
    assert quality.check(df, "bus_gps").first().error_reason == reason


MIXED = [("air_quality", {"sensor_id": "a", "aqi": None}), ("air_quality", {"sensor_id": "a", "aqi": 999}),
         ("air_quality", {"sensor_id": "a", "aqi": 9}), ("bus_gps", {"lat": 999, "lon": 0}), ("bus_gps", {"lat": 1}),
         ("bus_gps", {"lat": 1, "lon": 2}), ("bus_gps", '{"lat": 1,'), ("bus_gps", "[]"), ("other", {"aqi": 999})]


def mixed(spark):
    return frame(spark, [(None, v if isinstance(v, str) else json.dumps(v), t, 3, i, T0)
                         for i, (t, v) in enumerate(MIXED)], RAW)


def test_mixed_dead_letters(spark):
    got = {r.offset: r.error_reason for r in quality.dead_letters_of_mixed(mixed(spark)).collect()}
    assert got == {0: "NULL_AQI", 1: "AQI_OUT_OF_RANGE", 3: "INVALID_GPS_COORDINATES", 4: "NULL_GPS_COORDINATE",
                   6: "NULL_GPS_COORDINATE", 7: "NULL_GPS_COORDINATE"}
    flagged = {r.offset: r.error_reason for r in quality.dead_letters_of_mixed(mixed(spark), True).collect()}
    assert flagged == {**got, 6: "MALFORMED_JSON", 7: "MALFORMED_JSON"}


def test_dead_letter_records_and_report(spark):
    dlq = quality.dead_letters_of_mixed(mixed(spark))
    records = [json.loads(r.value) for r in quality.dlq_json(dlq).orderBy(F.get_json_object("value", "$.offset").cast("int")).collect()]
    assert records[0] == {"error_reason": "NULL_AQI", "source_topic": "air_quality", "partition": 3, "offset": 0,
                          "original_event": {"sensor_id": "a", "aqi": None}}
    sent = quality.dlq_json(dlq).unionByName(frame(spark, [(None, "{}")], "key string, value string"))
    assert {tuple(r) for r in quality.error_report(quality.reasons_of_topic(sent)).collect()} == {
        ("NULL_AQI", 1), ("AQI_OUT_OF_RANGE", 1), ("INVALID_GPS_COORDINATES", 1), ("NULL_GPS_COORDINATE", 3), ("UNKNOWN", 1)}
    unknown = frame(spark, [(None,), ("X",), (None,)], "error_reason string")
    assert {tuple(r) for r in quality.error_report(unknown).collect()} == {("UNKNOWN", 2), ("X", 1)}


def test_valid_and_rejected_make_up_the_input(spark):
    df = air(spark, [("a", i, a) for i, a in enumerate([None, -1, 0, 250, 500, 501])]).withColumn("partition", F.lit(0))
    assert quality.valid_rows(df, "air_quality").count() + quality.dead_letters(df, "air_quality").count() == 6
    typed = quality.dead_letters(df, "air_quality", flag_malformed=False).orderBy("offset").first()
    assert json.loads(typed.original_event)["aqi"] is None


GPS = {"bus_id": "B1", "route_id": "R10", "lat": 1.5, "lon": 2.5, "speed_kmh": 3, "occupancy_pct": 4, "timestamp": "t"}


def test_left_and_inner_enrichment(spark):
    gps = frame(spark, [("B1", "R10"), ("B2", "R15")], "bus_id string, route_id string")
    table = tables.route_schedule(spark)
    left = {r.bus_id: r.terminal for r in enrich.with_route(gps, table).collect()}
    assert left == {"B1": "Airport", "B2": "UNKNOWN"}
    inner = enrich.with_known_route(gps, table)
    assert inner.columns[-1] == "scheduled_arrival" and [r.bus_id for r in inner.collect()] == ["B1"]


def test_enriched_records(spark):
    source = raw(spark, "bus_gps", [GPS, GPS, "not json", GPS], keys=["R10", "R15", "R10", "R16"])
    table = tables.route_schedule(spark).unionByName(
        frame(spark, [("R16", "n", None, "1")], schemas.ROUTE_SCHEDULE))
    got = [r.value for r in enrich.enriched_records(source, table).orderBy("key").collect()]
    ok = [json.loads(v) for v in got if "terminal" in v]
    assert {**GPS, "route_name": "Airport Express", "terminal": "Airport", "scheduled_arrival_time": "08:45"} in ok
    assert {**GPS, "route_name": "UNKNOWN", "terminal": "UNKNOWN", "scheduled_arrival_time": "UNKNOWN"} in ok
    assert got.count(enrich.FAILED) == 2


def test_enriched_record_keeps_the_event_as_it_came(spark):
    source = raw(spark, "bus_gps", ['{"bus_id":"B","lat":1,"driver":"x"}', "{ }"], keys=["R10", "R11"])
    got = [r.value for r in enrich.enriched_records(source, tables.route_schedule(spark)).orderBy("key").collect()]
    assert got[0] == ('{"bus_id":"B","lat":1,"driver":"x","route_name":"Airport Express","terminal":"Airport",'
                      '"scheduled_arrival_time":"08:45"}')
    assert json.loads(got[1]).keys() == {"route_name", "terminal", "scheduled_arrival_time"}


def test_last_line_of_a_route_counts(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text("route_id,route_name,terminal,scheduled_arrival_time\nR10,Old,T,1\n\nR11,Other,T,2\nR10,New,T,3\n")
    got = {r.route_id: r.route_name for r in tables.route_schedule(spark, str(path)).collect()}
    assert got == {"R10": "New", "R11": "Other"}


def test_nan_is_in_range(spark):
    df = frame(spark, [(float("nan"),), (600.0,), (10.0,)], "aqi double")
    assert [r.e for r in df.select(quality.error_reason("air_quality").alias("e")).collect()] == [None, "AQI_OUT_OF_RANGE", None]
    assert df.select(levels.severity(F.col("aqi")).alias("s")).first().s == "HAZARDOUS"


def test_rows_without_time_are_dead_letters(spark):
    rows = [("a", None, 0, 0), ("b", T0, 0, 1)]
    df = frame(spark, rows, "sensor_id string, event_time timestamp, partition int, offset bigint")
    rest = [f.name for f in schemas.AIR_QUALITY if f.name != "sensor_id"]
    found = quality.untimed(df.select("*", *[F.lit(None).cast(schemas.AIR_QUALITY[c].dataType).alias(c) for c in rest]), "air_quality")
    assert [(r.error_reason, r.offset) for r in found.collect()] == [(quality.UNTIMED, 0)]


def test_changelog_round_trip(spark):
    first = tables.changelog(tables.route_schedule(spark), "route_id", "route_schedule")
    assert first.count() == 5
    newer = json.dumps({"route_id": "R10", "route_name": "New", "terminal": "T", "scheduled_arrival_time": "1"})
    log = (first.select("key", "value").withColumn("offset", F.lit(0))
           .unionByName(frame(spark, [("R10", newer, 1), ("R11", None, 1)], "key string, value string, offset int"))
           .withColumn("partition", F.lit(0)))
    got = {r.route_id: r.route_name for r in enrich.schedule_from_topic(log).collect()}
    assert got["R10"] == "New" and "R11" not in got and len(got) == 4


def test_latest_by_key(spark):
    df = frame(spark, [("a", 1, 10), ("a", 2, 5), ("b", 1, 7)], "k string, o int, v int")
    assert {tuple(r) for r in latest.latest_by_key(df, ["k"], ["o"]).collect()} == {("a", 2, 5), ("b", 1, 7)}


def meters(spark, rows):
    return frame(spark, [(w, at(t), k, p, v) for w, t, k, p, v in rows],
                 "ward_id string, event_time timestamp, kwh_consumed double, power_factor double, voltage double")


def test_ward_summary_and_reports(spark, tmp_path):
    rows = [("W01", 0, 1.0, .8, 230.0), ("W01", 899, 2.0, .9, 240.0), ("W01", 900, 4.0, None, 220.0), ("W02", 0, 8.0, .7, 1.0)]
    summary = energy.ward_summary(meters(spark, rows), with_weights=True)
    got = {(r.ward_id, r.window_start): (r.total_kwh_consumed, r.avg_power_factor, r.peak_voltage) for r in summary.collect()}
    assert got[("W01", at(0))] == (3.0, pytest.approx(.85), 240.0)
    assert got[("W01", at(900))] == (4.0, None, 220.0)
    day = {r.ward_id: r for r in energy.ward_report(summary, "day").collect()}
    assert day["W01"].total_kwh_consumed == 7.0 and day["W01"].avg_power_factor == pytest.approx(.85)
    path = str(tmp_path / "lake")
    energy.write_lake(summary.select(*energy.SUMMARY), path)
    lake = tables.read_lake(spark, path)
    assert {r.ward_id for r in tables.lake_wards(lake).collect()} == {"W01", "W02"}
    assert energy.ward_history(lake, "W01", "2024-03-01", "2024-03-01").count() == 2
    assert json.loads(energy.summary_records(summary).where("avg_power_factor is null").first().value).keys() == {
        "ward_id", "window_start", "window_end", "total_kwh_consumed", "peak_voltage"}


def test_mean_of_decimal_readings_is_exact(spark):
    """Readings of 0.85 in the mean are not below 0.85, though their doubles add up to a little less."""
    rows = [("W01", 900 * w + i, 1.0, p, 230.0) for w in range(3) for i, p in enumerate([.938, .741, .989, .732])]
    rows += [("W02", 900 * w + i, 1.0, p, 230.0) for w in range(3) for i, p in enumerate([.938, .741, .989, .731])]
    rows += [("W03", 0, 1.0, p, 230.0) for p in (.8, float("inf"))] + [("W04", 0, 1.0, None, 230.0)]
    readings = meters(spark, rows).coalesce(1)
    summary = energy.ward_summary(readings, exact=True)
    assert {(r.ward_id, r.avg_power_factor) for r in summary.collect()} == {
        ("W01", .85), ("W02", .84975), ("W03", float("inf")), ("W04", None)}
    assert [r.ward_id for r in detect.low_power_factor(summary, .85, 3).collect()] == ["W02"]
    plain = energy.ward_summary(readings)
    assert [r.ward_id for r in detect.low_power_factor(plain.where("ward_id = 'W01'"), .85, 3).collect()] == ["W01"]


def test_panes_equal_sliding_windows(spark):
    df = frame(spark, [("N" if i % 3 else None, at(i * 37), float(i * 7 % 300), float(i) if i % 5 else None, None)
                       for i in range(200)], "zone string, event_time timestamp, aqi double, pm25 double, pm10 double")
    df = decode.usable_air_readings(df)
    a = {(r[0], r[1], r[2]): r[3:] for r in advisory.rolling_aqi(df, None).collect()}
    b = {(r[0], r[1], r[2]): r[3:] for r in advisory.rolling_aqi_from_panes(df).collect()}
    assert a.keys() == b.keys()
    assert all(x == pytest.approx(y) for k in a for x, y in zip(a[k], b[k]))


def test_levels(spark):
    values = [150.5, 200.0, 200.1, 300.0, 300.1, 400.0, 400.1]
    got = frame(spark, [(v,) for v in values], "v double").select(
        levels.advisory_level(F.col("v")), levels.severity(F.col("v"))).collect()
    assert [r[0] for r in got] == ["UNHEALTHY"] * 2 + ["VERY_UNHEALTHY"] * 2 + ["HAZARDOUS"] * 3
    assert [r[1] for r in got] == ["HAZARDOUS"] * 6 + ["CRITICAL"]


def test_advisory_threshold_and_unknown_zone(spark):
    rolling = frame(spark, [(z, at(0), at(600), a, 1.0, 1.0) for z, a in [("North", 150.0), ("North", 150.01), ("Harbour", 301.0)]],
                    "zone string, window_start timestamp, window_end timestamp, rolling_avg_aqi double, "
                    "rolling_avg_pm25 double, rolling_avg_pm10 double")
    got = {r.zone: r for r in advisory.advisories(rolling, tables.zone_profile(spark)).collect()}
    assert got.keys() == {"North", "Harbour"}
    assert got["North"].population == 125000 and got["Harbour"].zone_name is None
    assert "zone_name" not in json.loads(advisory.advisory_records(
        advisory.advisories(rolling, tables.zone_profile(spark))).where("key = 'Harbour'").first().value)


def test_json_null_conventions(spark):
    row = frame(spark, [(1, None)], "a int, b int").select(compact_json("a", "b").alias("c"), full_json("a", "b").alias("f")).first()
    assert (row.c, row.f) == ('{"a":1}', '{"a":1,"b":null}')


def test_retention(spark, tmp_path):
    df = frame(spark, [(at(0),), (at(86_400),), (at(86_401),), (at(2 * 86_400),)], "ts timestamp")
    assert retention.retained(df, "bus_gps").count() == 3
    lake = frame(spark, [("W01", d) for d in ("2024-01-01", "2024-01-09", "2024-01-10")], "ward_id string, date string")
    assert {r.date for r in retention.retained_lake(lake, 1).collect()} == {"2024-01-09", "2024-01-10"}


def test_feed_and_order(spark):
    df = frame(spark, [("J1", 5, "RED", i) for i in range(20)] + [("J0", 1, "GREEN", 3)],
               "junction_id string, vehicle_count int, signal_phase string, offset int")
    assert feed.signal_feed(df, feed.LANES[0]).first().line == "[HIGH_PRIORITY] junction=J1 vehicles=5 phase=RED"
    ordered = feed.ordered_within_key(df, "junction_id", "offset").select("junction_id", "offset").collect()
    assert ordered == sorted(ordered)


def test_csv_tables(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text("route_id,route_name,terminal,scheduled_arrival_time\nR1,A,T,08:00\n\nR2,B,T,09:00\n")
    table, n = tables.cached_reference(tables.route_schedule(spark, str(path)), "route_table")
    assert n == 2 and spark.sql("select count(*) from route_table").first()[0] == 2
    table.unpersist()
    zone = tmp_path / "zones.csv"
    zone.write_text("zone,zone_name,population,num_schools,num_hospitals,area_sq_km\nNorth,North Zone,1,2,3,4\n")
    assert tables.zone_profile(spark, str(zone)).first().population == 1


def test_kafka_options():
    latest_start = streams.kafka_read_options("h:1", ["a", "b"])
    assert latest_start == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
                            "failOnDataLoss": "false"}
    assert streams.kafka_read_options("h:1", ["a"], max_offsets=5)["maxOffsetsPerTrigger"] == "5"
    bounded = streams.kafka_read_options("h:1", ["dlq"], streaming=False)
    assert (bounded["startingOffsets"], bounded["endingOffsets"]) == ("earliest", "latest")
    assert "maxOffsetsPerTrigger" not in streams.kafka_read_options("h:1", ["a"], streaming=False, max_offsets=5)


def test_read_topics(spark, tmp_path):
    mixed(spark).createOrReplaceTempView("mixed_topics")
    assert streams.read_topics(spark, "table", "mixed_topics", ["bus_gps"]).count() == 5
    for topic in ("air_quality", "bus_gps"):
        mixed(spark).where(F.col("topic") == topic).write.parquet(str(tmp_path / topic))
    both = streams.read_topics(spark, "file", str(tmp_path), ["air_quality", "bus_gps"], streaming=False)
    assert both.count() == 8 and both.columns == streams.ENVELOPE_COLUMNS
    with pytest.raises(ValueError):
        streams.read_topics(spark, "tape", "", [])
    binary = frame(spark, [(bytearray(b"k"), bytearray(b"v"), "t", 0, 0, T0)],
                   "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    assert streams.text_envelope(binary).first().value == "v"
