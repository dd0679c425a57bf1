"""Topics written for a replay: many files and tasks a stretch, one stretch a micro-batch."""

from helpers import T0, frame
from pyspark.sql import functions as F

from citystream import schemas
from citystream.plans import city, queries, replay
from citystream.sources import files, streams
from citystream.streaming import reorder, sinks

SF = "/root/testdata/sf0.001"


def batch_sizes(spark, path, n, checkpoint):
    sizes = []
    query = (streams.from_files(spark, path, max_files=n).writeStream.foreachBatch(lambda b, i: sizes.append(b.count()))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    sinks.await_all(query)
    return sizes


def test_a_stretch_is_several_files(spark, tmp_path):
    typed = city.bus_gps(city.events(spark, SF))
    path, n = replay.written(typed, "bus_gps", 4, F.col("event_id") * 10, rows_per_file=50)
    assert n == 5 and files.count(spark, path, "part-*") == 20
    assert batch_sizes(spark, path, n, str(tmp_path / "c")) == [250] * 4
    whole, one = replay.written(typed, "bus_gps", 4, F.col("event_id") * 10)
    assert one == 1 and files.count(spark, whole, "part-*") == 4
    got, want = spark.read.schema(schemas.ENVELOPE).parquet(path), spark.read.schema(schemas.ENVELOPE).parquet(whole)
    assert got.count() == 1000 and got.exceptAll(want).isEmpty()


def test_stretches_of_few_rows_keep_their_files(spark, tmp_path):
    typed = city.bus_gps(city.events(spark, SF).where("event_id < 11 or event_id = 999"))
    path, n = replay.written(typed, "bus_gps", 4, F.col("event_id") * 10, rows_per_file=1)
    assert n == 3 and files.count(spark, path, "part-*") == 12
    assert batch_sizes(spark, path, n, str(tmp_path / "c")) == [11, 0, 0, 1]


def test_timetable_is_chosen_by_all_tasks(spark):
    lines = queries.timetable_lines(spark, SF)
    assert "Coalesce 1" not in lines._jdf.queryExecution().executedPlan().toString()
    assert lines.rdd.getNumPartitions() == 1 and lines.count() == 10


def test_a_batch_is_judged_once(spark, tmp_path, monkeypatch):
    made, real = spark.sparkContext.accumulator(0), reorder.running_max

    def counted(value):
        made.add(1)
        return value

    count = F.udf(counted, "long").asNondeterministic()
    monkeypatch.setattr(reorder, "running_max", lambda *how: real(*how).withColumn("top", count("top")))
    rows = [(None, f'{{"timestamp":"2024-03-01T00:00:{s:02}"}}', "t", 0, i, T0) for i, s in enumerate([5, 9, 1, 40, 41])]
    raw = frame(spark, rows, schemas.ENVELOPE)
    raw.coalesce(1).write.parquet(str(tmp_path / "topic"))
    path = str(tmp_path / "out")
    sinks.await_all(reorder.start(streams.from_files(spark, str(tmp_path / "topic")), path, str(tmp_path / "c"), 5_000, {"availableNow": True}))
    assert made.value == len(rows)
    assert [r.offset for r in reorder.late_records(spark, path).collect()] == [2]
    assert not files.exists(spark, f"{path}/judged")
