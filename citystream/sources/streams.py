"""Reading topics: from a broker, from replay files, or from a table already at hand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas

ENVELOPE_COLUMNS = schemas.ENVELOPE.fieldNames()


def kafka_read_options(servers: str, topics: Sequence[str], *, streaming: bool = True,
                       starting: str | None = None, max_offsets: int | None = None,
                       fail_on_data_loss: bool = False) -> dict[str, str]:
    """Options of a broker scan.

    Streams start at the latest offset on their first run (afterwards the checkpoint decides);
    a bounded read goes from the earliest offset to the end seen at planning time.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting or ("latest" if streaming else "earliest"),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if not streaming:
        options["endingOffsets"] = "latest"
    elif max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def from_kafka(spark: SparkSession, servers: str, topics: Sequence[str], *,
               streaming: bool = True, **how) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(
        **kafka_read_options(servers, topics, streaming=streaming, **how)).load()
    return text_envelope(raw)


def text_envelope(raw: DataFrame) -> DataFrame:
    """Broker bytes to text; topic, partition, offset and transport time stay as columns."""
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")


def from_files(spark: SparkSession, path: str, *, streaming: bool = True,
               max_files: int | None = None) -> DataFrame:
    """Replay of envelope rows kept as Parquet.

    Files are taken in order of modification time; ``max_files`` limits one micro-batch.
    """
    if not streaming:
        return spark.read.schema(schemas.ENVELOPE).parquet(path)
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_topics(spark: SparkSession, kind: str, location: str, topics: Sequence[str],
                **how) -> DataFrame:
    """One or several topics as envelope rows.

    ``kind`` is ``kafka`` (``location`` = bootstrap servers), ``file`` (``location`` = folder
    with one subfolder per topic) or ``table`` (``location`` = table or view name).
    """
    if kind == "kafka":
        return from_kafka(spark, location, topics, **how)
    if kind == "table":
        return spark.table(location).where(F.col("topic").isin(list(topics)))
    if kind != "file":
        raise ValueError(f"unknown source kind: {kind}")
    parts = [from_files(spark, f"{location}/{topic}", **how) for topic in topics]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def as_envelope(df: DataFrame, topic: str, value: Sequence[str], *, key: str | None = None,
                partition: str = "partition", offset: str = "offset",
                arrived: str = "event_time") -> DataFrame:
    """Typed rows back to transport rows, nulls kept: what a producer would have sent."""
    return df.select(
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        F.to_json(F.struct(*value), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"),
        F.col(partition).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        F.col(arrived).cast("timestamp").alias("timestamp"))
