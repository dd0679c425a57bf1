"""Where streams end: broker topics, the Parquet lake, batch tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from citystream.operators.latest import latest_by_key
from citystream.sources import files


def kafka_write_options(servers: str, topic: str, checkpoint: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if checkpoint:
        options["checkpointLocation"] = checkpoint
    return options


def _triggered(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def to_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append",
             trigger: dict | None = None) -> StreamingQuery:
    """Key/value records to a topic, at least once. Default trigger: as fast as batches finish."""
    writer = records.writeStream.format("kafka").options(**kafka_write_options(servers, topic, checkpoint))
    return _triggered(writer.outputMode(mode), trigger).start()


def publish(records: DataFrame, servers: str, topic: str) -> None:
    """A bounded table of key/value records to a topic, e.g. a changelog."""
    records.select("key", "value").write.format("kafka").options(**kafka_write_options(servers, topic)).save()


def to_lake(rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str],
            trigger: dict | None = None) -> StreamingQuery:
    """Finished rows to partitioned Parquet, exactly once."""
    writer = (rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy(*partition_by).outputMode("append"))
    return _triggered(writer, trigger).start()


def to_table(rows: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None,
             each_batch: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Every micro-batch to its own ``batch_id`` folder of a Parquet table.

    Writing a batch again after a failure replaces its folder, so nothing is counted twice.
    ``each_batch`` may transform the rows of a batch, e.g. join them with a re-read table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        done = each_batch(batch) if each_batch else batch
        done.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    return _triggered(writer, trigger).start()


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows written by ``to_table``, with ``batch_id``; none if nothing was written yet and ``schema`` says what rows look like."""
    if schema is not None and not files.exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("batch_id", T.IntegerType())]))
    return spark.read.option("basePath", path).parquet(path)


def latest_updates(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final state of an update-mode stream: per key the row of the newest batch."""
    return latest_by_key(table, keys, ["batch_id"], unique=True).drop("batch_id")


DEDUPLICATION = "source_position"


def to_topic_once(rows: DataFrame, send: Callable[[DataFrame], None], sent: Callable[[], DataFrame] | None, path: str, checkpoint: str,
                  trigger: dict | None = None, each_batch: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Every record of a topic to another one, written once however often a micro-batch is run.

    A micro-batch's records are first written to ``path`` with their source's position (topic, partition, offset) as
    ``source_position``; that outbox is the batch from then on, so a repeated run sends the same records. A batch with a
    ledger entry is not sent again. A run that died while sending has none: then the positions in ``sent()``, what the sink holds of
    them, are left out. Without ``sent`` (a sink that cannot be read) receivers drop repeated positions instead.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        outbox, entry = f"{path}/outbox/version={batch_id}", f"{path}/ledger/version={batch_id}"
        if files.exists(spark, f"{entry}/_SUCCESS"):
            return
        begun = files.exists(spark, f"{outbox}/_SUCCESS")
        if not begun:
            position = F.concat_ws("-", "topic", "partition", "offset").alias(DEDUPLICATION)
            (each_batch(batch.select("*", position)) if each_batch else batch.select("*", position)).write.mode("overwrite").parquet(outbox)
        records = spark.read.parquet(outbox)
        if begun and sent is not None:
            records = records.join(sent().select(DEDUPLICATION), DEDUPLICATION, "left_anti")
        send(records)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(entry)
        files.remove(spark, f"{path}/outbox/version={batch_id - 2}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def kafka_sender(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """Sends records with their position as a header, by which receivers can drop repeated ones."""
    def send(records: DataFrame) -> None:
        header = F.array(F.struct(F.lit(DEDUPLICATION).alias("key"), F.col(DEDUPLICATION).cast("binary").alias("value")))
        (records.select("key", "value", header.alias("headers")).write.format("kafka")
         .options(**kafka_write_options(servers, topic), includeHeaders="true").save())
    return send


def await_all(*queries: StreamingQuery) -> None:
    for query in queries:
        query.awaitTermination()


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Number of state partitions for queries started inside; a checkpoint keeps it for good."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if n:
        spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)

