"""Bringing a topic back into event-time order before the ordered rules see it.

A record is late if its event time lies more than the bound behind the greatest event time of the records that
arrived before it; arrival order is transport time, partition, offset. That does not depend on how the stream is cut
into micro-batches. Records that are not late wait until the greatest event time seen is the bound ahead of them: no record that is on
time can then come before them. So every released batch lies behind the ones released earlier, and the rules,
which order a micro-batch themselves, give what they would give on a table. Late records go to a side table.

The buffer is a table with a version per micro-batch, written with the batch's marks; nothing is held in a task or per key,
and a hot key is spread like any other rows. A batch that is run again after a failure starts from the version before
it and writes the same. Released batches appear in one step, by a rename. A record without any event time is late.

    <path>/ready/b-N    released records, the input of the rules     <path>/late/batch_id=N    late records
    <path>/held/version=N    records that wait                       <path>/marks/version=N    what was seen, and counts
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citystream import schemas
from citystream.functions.times import epoch_ms, iso_or
from citystream.operators.ordered import running_max
from citystream.session import cut
from citystream.sources import files, streams

BOUND_MS = {"air_quality": 10_000, "traffic_signals": 10_000, "bus_gps": 30_000, "smart_meters": 2_700_000}
ARRIVAL = ["timestamp", "partition", "offset"]
LATE = "LATE_EVENT"
MARKS = "seen_ms long, arrived long, late long, released long, held long"
KEPT = 2    # versions of the buffer that stay: the newest, and the one it was made from


def event_ms() -> Column:
    """Event time of a record, its transport time if the text has none."""
    return epoch_ms(iso_or(F.get_json_object("value", "$.timestamp"), F.col("timestamp")))


def _version(spark: SparkSession, path: str, name: str, version: int, schema) -> DataFrame:
    where = f"{path}/{name}/version={version}"
    if version < 0 or not files.exists(spark, where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(where)


def _release(rows: DataFrame, path: str, name: str) -> None:
    """Puts a batch of records where the rules find it, all at once; what is there already came from the same batch."""
    spark = rows.sparkSession
    if files.exists(spark, f"{path}/ready/{name}"):
        return
    rows.select(*streams.ENVELOPE_COLUMNS).write.mode("overwrite").parquet(f"{path}/staged/{name}")
    files.move(spark, f"{path}/staged/{name}", f"{path}/ready/{name}")


def start(raw: DataFrame, path: str, checkpoint: str, bound_ms: int, trigger: dict | None = None) -> StreamingQuery:
    """Splits the records of a topic into released, waiting and late ones, micro-batch by micro-batch."""
    held_schema = schemas.ENVELOPE.simpleString()[len("struct<"):-1].replace(":", " ") + ", ms bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _version(spark, path, "marks", batch_id - 1, MARKS).first()
        seen = marks.seen_ms if marks else None
        # ordered and judged once; what follows only scans the result
        judged = cut(running_max(batch.select(*streams.ENVELOPE_COLUMNS, event_ms().alias("ms")), ARRIVAL, "ms", "top"),
                     f"{path}/judged/version={batch_id}-{uuid.uuid4().hex}")
        ahead = F.greatest(F.col("top"), F.lit(seen).cast("long"))
        is_late = F.col("ms").isNull() | F.coalesce(F.col("ms") < ahead - bound_ms, F.lit(False))
        arrived, late, top = judged.agg(F.count("*"), F.count_if(is_late), F.max("ms")).first()
        seen = max((x for x in (seen, top) if x is not None), default=None)
        judged.where(is_late).select(*streams.ENVELOPE_COLUMNS).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        waiting = (judged.where(~is_late).select(*streams.ENVELOPE_COLUMNS, "ms")
                   .unionByName(_version(spark, path, "held", batch_id - 1, held_schema)))
        ready = F.coalesce(F.col("ms") < F.lit(seen).cast("long") - bound_ms, F.lit(False))
        waiting.where(~ready).write.mode("overwrite").parquet(f"{path}/held/version={batch_id}")
        _release(waiting.where(ready), path, f"b-{batch_id:09}")
        held = _version(spark, path, "held", batch_id, held_schema).count()
        before = marks.held if marks else 0
        spark.createDataFrame([(seen, arrived, late, before + arrived - late - held, held)], MARKS).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/marks/version={batch_id}")
        files.remove(spark, f"{path}/held/version={batch_id - KEPT}")
        files.remove(spark, f"{path}/judged")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(spark: SparkSession, path: str) -> None:
    """At the end of a bounded replay: releases what still waits. A stream that goes on must not be drained."""
    found = files.versions(spark, f"{path}/held")
    if found:
        _release(spark.read.parquet(f"{path}/held/version={found[-1]}"), path, f"b-{found[-1]:09}-rest")


def released(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The released records as a stream."""
    return streams.from_files(spark, f"{path}/ready/*", max_files=max_files)


def late_records(spark: SparkSession, path: str) -> DataFrame:
    """Late records in the layout of dead letters."""
    if not files.exists(spark, f"{path}/late"):
        rows = spark.createDataFrame([], schemas.ENVELOPE)
    else:
        rows = spark.read.schema(schemas.ENVELOPE).parquet(f"{path}/late")
    return rows.select(F.lit(LATE).alias("error_reason"), F.col("topic").alias("source_topic"), "partition", "offset",
                       F.col("value").alias("original_event"))


def progress(spark: SparkSession, path: str) -> DataFrame:
    """Per micro-batch: the greatest event time seen, and how many records arrived, were late, were released and wait."""
    if not files.exists(spark, f"{path}/marks"):
        return spark.createDataFrame([], f"batch_id int, {MARKS}")
    return (spark.read.schema(f"{MARKS}, version int").parquet(f"{path}/marks").withColumnRenamed("version", "batch_id")
            .select("batch_id", "seen_ms", "arrived", "late", "released", "held"))
