"""State that streams keep as tables: the reorder buffer, changelog snapshots, records sent once, bunching split within a route."""

import itertools
import json
import random

import pytest
from helpers import at, gps
from pyspark.sql import functions as F

from citystream import schemas
from citystream.operators import advisory, proximity
from citystream.operators.latest import latest_by_key
from citystream.operators.ordered import running_max
from citystream.sources import files, streams, tables
from citystream.sources.snapshot import ChangelogSnapshot
from citystream.streaming import bunching, jobs, reorder, sinks

NOW = {"availableNow": True}


def envelope(spark, rows):
    """rows: (key, value, partition, offset, arrival in seconds)"""
    return spark.createDataFrame([(k, v, "t", p, o, at(s)) for k, v, p, o, s in rows], schemas.ENVELOPE)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_max(spark):
    rng = random.Random(1)
    values = [rng.choice([None, rng.randrange(1000)]) for _ in range(500)]
    rows = list(enumerate(values))
    got = {r.i: r.top for r in running_max(spark.createDataFrame(rng.sample(rows, 500), "i long, v long"), ["i"], "v", "top").collect()}
    best = None
    for i, v in rows:
        assert got[i] == best
        best = v if best is None else best if v is None else max(best, v)


@pytest.mark.parametrize("batches", [1, 5])
def test_records_out_of_order(spark, tmp_path, batches):
    """Released batches lie one behind the other, and what is late does not depend on the micro-batches."""
    rng = random.Random(4)
    rows, text = [], {}
    for i in range(400):
        late = i % 37 == 11
        arrival = i + rng.random() * 5 + (60 if late else 0)
        rows.append((f"s{i % 3}", json.dumps({"timestamp": at(i).isoformat(), "n": i}) if i % 50 != 9 else "no json", 0, i, arrival))
    rows.sort(key=lambda r: r[4])
    folder, path = str(tmp_path / "topic"), str(tmp_path / "state")
    for part in itertools.batched(rows, -(-len(rows) // batches)):
        envelope(spark, part).coalesce(1).write.mode("append").parquet(folder)
    raw = streams.from_files(spark, folder, max_files=1)
    sinks.await_all(reorder.start(raw, path, f"{path}/checkpoint", 10_000, NOW))
    reorder.drain(spark, path)

    seen, want_late = None, set()
    for k, v, _, o, arrival in rows:
        event = o if v != "no json" else arrival        # text without a time counts from its arrival
        if seen is not None and event < seen - 10:
            want_late.add(o)
        seen = event if seen is None else max(seen, event)
    late = reorder.late_records(spark, path).collect()
    assert {r.offset for r in late} == want_late and all(r.error_reason == reorder.LATE for r in late)
    folders = sorted({r.f for r in spark.read.parquet(f"{path}/ready/*").select(F.regexp_extract(F.input_file_name(), "ready/([^/]*)", 1).alias("f")).collect()})
    ready = [spark.read.parquet(f"{path}/ready/{f}").select(reorder.event_ms().alias("ms"), "offset").collect() for f in folders]
    assert {r.offset for part in ready for r in part} == {r[3] for r in rows} - want_late
    assert all(max(r.ms for r in a) <= min(r.ms for r in b) for a, b in itertools.pairwise(ready))
    counts = reorder.progress(spark, path).agg(F.sum("arrived"), F.sum("late"), F.count("*")).first()
    assert tuple(counts) == (400, len(want_late), batches)


def test_a_topic_without_records(spark, tmp_path):
    folder, path = str(tmp_path / "topic"), str(tmp_path / "state")
    envelope(spark, []).write.parquet(folder)
    sinks.await_all(reorder.start(streams.from_files(spark, folder), path, f"{path}/checkpoint", 10_000, NOW))
    reorder.drain(spark, path)
    assert reorder.late_records(spark, path).count() == 0 and reorder.progress(spark, path).where("arrived > 0").count() == 0
    assert sinks.read_table(spark, f"{path}/nothing", schemas.ENVELOPE).count() == 0


def test_snapshot_takes_in_new_records_only(spark, tmp_path):
    topic, path = str(tmp_path / "changes"), str(tmp_path / "snapshot")
    snapshot = ChangelogSnapshot(spark, path)
    assert snapshot.version() is None and snapshot.content().count() == 0

    def publish(*rows):
        envelope(spark, [(k, v, p, o, 0) for k, v, p, o in rows]).coalesce(1).write.mode("append").parquet(topic)

    read = lambda: streams.from_files(spark, topic, streaming=False)
    publish(("a", "1", 0, 0), ("b", "1", 1, 0), ("a", "2", 0, 1), (None, "lost", 0, 2))
    assert snapshot.advance(read()) == 0 and snapshot.advance(read()) == 0
    assert {(r.key, r.value) for r in snapshot.content().collect()} == {("a", "2"), ("b", "1")}
    publish(("a", None, 0, 3), ("c", "1", 2, 7), ("b", "2", 1, 1))
    fresh = read().where(snapshot.beyond(snapshot.marks()))
    assert sorted(r.offset for r in fresh.where("key is not null").collect()) == [1, 3, 7]
    assert "GreaterThan(offset" in plan_of(fresh)       # reaches the scan, where whole files are passed over
    old = snapshot.content()
    assert snapshot.advance(read()) == 1
    assert {(r.key, r.value) for r in snapshot.content().collect()} == {("b", "2"), ("c", "1")}
    assert old.count() == 2     # who reads the version before can go on
    assert json.loads(snapshot.starting_offsets("t")) == {"t": {"0": 4, "1": 2, "2": 8}}
    snapshot.content().write.parquet(f"{path}/version=9")
    files.remove(spark, f"{path}/version=9/_SUCCESS")     # a run that died
    assert snapshot.version() == 1


def test_records_are_sent_once_though_a_batch_runs_twice(spark, tmp_path):
    topic, out, path = str(tmp_path / "topic"), str(tmp_path / "out"), str(tmp_path / "state")
    for part in range(3):
        envelope(spark, [("k", f"v{part}-{i}", 0, part * 10 + i, part) for i in range(10)]).coalesce(1).write.mode("append").parquet(topic)
    sent = {"batches": 0}

    def send(rows):
        sent["batches"] += 1
        if sent["batches"] == 2:    # half of the second batch gets through
            rows.where("cast(split(source_position, '-')[2] as int) % 2 = 0").write.mode("append").parquet(out)
            raise RuntimeError("broker gone")
        rows.write.mode("append").parquet(out)

    def run():
        raw = streams.from_files(spark, topic, max_files=1)
        return sinks.to_topic_once(raw, send, lambda: spark.read.parquet(out), path, f"{path}/checkpoint", NOW)

    with pytest.raises(Exception, match="broker gone"):
        run().awaitTermination()
    run().awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.value for r in rows) == sorted(f"v{p}-{i}" for p in range(3) for i in range(10))


@pytest.mark.parametrize("order", [["ts", "n"], ["n"], ["p", "n"]])
def test_latest_by_hash(spark, order):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), at(rng.randrange(20)), rng.randrange(3), n, f"v{n}") for n in range(200)] + [("c", None, None, 500, "only")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, p int, n long, v string")
    got = latest_by_key(df, ["k"], order, unique=True)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, latest_by_key(df, ["k"], order).collect()), key=str)
    ran = got._jdf.queryExecution().executedPlan().executedPlan().toString()    # few keys: their orders are broadcast, nothing is sorted
    assert "HashAggregate" in ran and "BroadcastHashJoin" in ran and "SortAggregate" not in ran and "Sort [" not in ran


def test_a_window_that_falls_back_has_no_advisory(spark):
    means = [("North", at(0), at(600), aqi, 1.0, 1.0, batch) for batch, aqi in enumerate([160.0, 150.0])] + [("East", at(0), at(600), 151.0, 1.0, 1.0, 0)]
    df = spark.createDataFrame(means, "zone string, window_start timestamp, window_end timestamp, rolling_avg_aqi double, "
                                      "rolling_avg_pm25 double, rolling_avg_pm10 double, batch_id int")
    assert [r.zone for r in jobs.current_advisories(df, tables.zone_profile(spark)).collect()] == ["East"]


def test_advisories_over_a_table_repeat_no_readings(spark):
    spark.createDataFrame([("North", at(5), 200.0, 1.0, None)], "zone string, event_time timestamp, aqi double, pm25 double, pm10 double").createOrReplaceTempView("readings")
    tables.zone_profile(spark).createOrReplaceTempView("profiles")
    found = advisory.advisories_sql(spark, "readings", "profiles", "means")
    rows = found.collect()
    assert "Expand" not in plan_of(found) and len(rows) == 10 and all(r.rolling_avg_pm10 is None and r.rolling_avg_aqi == 200 for r in rows)


def test_bunching_in_steps_equals_the_table(spark, tmp_path):
    """Any division into batches, an empty one and one without usable reports among them; one route has nearly all rows."""
    rng = random.Random(7)
    rows, place = [], {}
    for i in range(700):
        bus = f"B{rng.randrange(6)}"
        place[bus] = place.get(bus, 12.9) + rng.choice([-0.0009, 0, 0, 0.0009])
        rows.append(("R1" if i % 15 else "R2", bus, i * 11.0, place[bus], 77.5))
    whole = gps(spark, rows)
    want = sorted(map(tuple, proximity.bus_bunching(whole).drop("event_time").collect()))
    path = str(tmp_path / "state")
    cuts = [0, 150, 150, 420, 700]
    for batch, (a, b) in enumerate(itertools.pairwise(cuts)):
        bunching.step(whole.where(f"offset >= {a} and offset < {b}"), path, batch)
    bunching.step(gps(spark, [("R1", "B1", 8000.0, 999.0, 77.5)]), path, len(cuts) - 1)
    got = sorted(map(tuple, bunching.alerts(spark, path).collect()))
    assert want and got == want
    assert spark.read.parquet(f"{path}/told/version={len(cuts) - 1}").count() <= 15
