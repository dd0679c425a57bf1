"""Topics replayed from files, batch by batch, in the order in which their records arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas
from citystream.plans import city
from citystream.session import scratch
from citystream.sources import files, streams

KEY_OF = {"bus_gps": "route_id"}
ROWS_PER_FILE = 100_000     # a stretch of more rows is in several files, which are written and read by a task each
# Tenths of a second from an event to its arrival: under 9 s for all, and ten or fifty minutes more for a few.
DELAY = "(event_id * 7919) % 89 + case when event_id % 211 = 7 then 6000 else 0 end + case when event_id % 509 = 11 then 30000 else 0 end"


def arrived() -> Column:
    return F.expr(f"event_id * 10 + {DELAY}")


def written(typed: DataFrame, topic: str, batches: int, arrival: Column, rows_per_file: int = ROWS_PER_FILE) -> tuple[str, int]:
    """The records of a topic as equal stretches of their order of arrival; returns the folder, and how many files a stretch has.

    A file source takes files in order of their modification, so the stretches are written one after another. Each is
    written by as many tasks as it has files, and has exactly that many, so that a reader that takes so many at once gets
    one stretch; where it has fewer rows than files, the others are empty.
    """
    spark = typed.sparkSession
    path = scratch(spark, f"topic-{topic}")
    placed = typed.withColumn("arrival", arrival)
    last, total = placed.agg(F.max("arrival"), F.count("*")).first()
    end, n = (last or 0) + 1, max(1, -(-total // (batches * rows_per_file)))
    placed = placed.withColumn("arrived_at", F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, arrival / 10.0D)"))
    for batch in range(batches):
        part = placed.where(F.floor(F.col("arrival") * batches / end) == batch)
        # dealt before they become text: a stretch lies in few parts of the table
        part = part.coalesce(1) if n == 1 else part.repartition(n, "offset")
        records = streams.as_envelope(part, topic, schemas.BY_TOPIC[topic].fieldNames(), key=KEY_OF.get(topic), arrived="arrived_at")
        records.write.mode("append").parquet(path)
        for _ in range((batch + 1) * n - files.count(spark, path, "part-*")):
            records.limit(0).coalesce(1).write.mode("append").parquet(path)
    return path, n


def disordered(spark: SparkSession, sf_dir: str, topic: str, batches: int = 6) -> DataFrame:
    """A stream of one stretch a micro-batch whose records come out of order, a few of them very late."""
    path, n = written(city.VIEWS[topic](city.events(spark, sf_dir)), topic, batches, arrived())
    return streams.from_files(spark, path, max_files=n)


def in_order(spark: SparkSession, sf_dir: str, topic: str, batches: int = 4) -> DataFrame:
    """The same in order of event time, one stretch a micro-batch."""
    path, n = written(city.VIEWS[topic](city.events(spark, sf_dir)), topic, batches, F.col("event_id") * 10)
    return streams.from_files(spark, path, max_files=n)
