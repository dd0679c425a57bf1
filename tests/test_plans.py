"""The physical plans: what is pushed down, pruned, broadcast, reused."""

import re

import pytest
from helpers import at, frame

from citystream import schemas
from citystream.operators import advisory, decode, energy, enrich, proximity, quality
from citystream.plans.queries import QUERIES, _air, _view
from citystream.plans import city
from citystream.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(QUERIES["ward_energy"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(QUERIES["valid_bus_gps"](spark, SF))


def test_lake_query_opens_only_the_wards_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    energy.write_lake(energy.ward_summary(_view("smart_meters", spark, SF)), path)
    text = plan(energy.ward_history(tables.read_lake(spark, path), "W03", "2024-01-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*ward_id[^\]]*date", text)


def test_event_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "air")
    _view("air_quality", spark, SF).write.parquet(path)
    text = plan(decode.usable_air_readings(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(aqi,0.0)" in text and "IsNotNull(zone)" in text


def test_aggregates_reduce_before_the_shuffle(spark):
    text = plan(QUERIES["ward_energy"](spark, SF))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1


def test_panes_shuffle_instead_of_readings(spark):
    """The tenfold repetition happens after the first aggregate."""
    text = plan(advisory.rolling_aqi_from_panes(_air(spark, SF)))
    lines = [line for line in text.splitlines() if "Generate" in line or "HashAggregate" in line or "Exchange" in line]
    kinds = [re.search(r"Generate|HashAggregate|Exchange", line).group() for line in lines]
    assert kinds.index("Generate") < kinds.index("Exchange") + 3
    assert kinds[-3:] == ["HashAggregate", "Exchange", "HashAggregate"]


def test_small_tables_are_broadcast_by_size_not_by_hint(spark):
    rolling = advisory.rolling_aqi_from_panes(_air(spark, SF))
    assert "BroadcastHashJoin" in plan(advisory.advisories(rolling, tables.zone_profile(spark)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(enrich.with_route(_view("bus_gps", spark, SF), tables.route_schedule(spark)))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert "BroadcastHashJoin" not in plan(proximity.contacts(city.bus_gps(city.events(spark, SF))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_threshold_is_applied_below_the_zone_join(spark):
    rolling = advisory.rolling_aqi_from_panes(_air(spark, SF))
    text = plan(advisory.advisories(rolling, tables.zone_profile(spark)))
    assert text.index("BroadcastHashJoin") < text.index("> 150.0")


def test_json_is_parsed_once(spark):
    raw = spark.createDataFrame([], schemas.ENVELOPE)
    for df in (decode.smart_meters(raw), decode.air_quality(raw), quality.dead_letters_of_mixed(raw)):
        assert plan(df).count("from_json") <= 1


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_stream") and "_stream_" not in n
                                  and n not in ("aqi_emergency", "gridlock", "bus_bunching", "incidents")])
def test_no_python_in_table_queries(spark, name):
    assert "Python" not in plan(QUERIES[name](spark, SF)) and "InPandas" not in plan(QUERIES[name](spark, SF))


def test_no_cross_joins(spark):
    for name in ("bus_pair_distance", "aqi_emergency", "retained_bus_gps", "health_advisories"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hot_keys_are_spread_over_slices(spark):
    """No window or group of the rules over whole histories is keyed by device alone before reduction."""
    text = plan(QUERIES["aqi_emergency"](spark, SF))
    assert re.search(r"hashpartitioning\(sensor_id#\d+, _slice", text)


@pytest.mark.parametrize("every_s", [1, 30, 120, 7_200])
def test_few_pairs_beyond_contacts(spark, every_s):
    """Whatever the reporting rate, reports meet at most three positions for one that counts."""
    rows = [("R", f"b{b}", 12.97, 77.59, "", at(every_s * (i + b / 6)), 6 * i + b) for b in range(6) for i in range(120)]
    gps = frame(spark, rows, "route_id string, bus_id string, lat double, lon double, timestamp string, "
                             "event_time timestamp, offset bigint")
    assert proximity.meetings(gps).count() <= 3 * proximity.contacts(gps).count()
