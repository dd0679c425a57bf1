"""Histories kept in order on disk: bucketed by key and slice, sorted by time.

Records of one key must be seen in order, which costs a shuffle and a sort each time a rule asks for it. A store
pays once: rows are cut into slices of about equal counts along key, time and sequence (a hot key into several),
and written in buckets of (keys, slice), each one file sorted by keys, slice, time and sequence. Windows per
(keys, slice), as in ``operators.ordered``, then run on the files as they lie.

A store holds a closed stretch of history and is not appended to. Its layout is known to the session's catalog;
``attach`` makes it known to another session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE = "_slice"
SLICES_A_BUCKET = 4     # several small ones fill buckets more evenly than one large one


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write(rows: DataFrame, path: str, keys: Sequence[str], ts: str, seq: str, buckets: int | None = None) -> DataFrame:
    """Writes ``rows`` in order to the new folder ``path`` and returns them as stored, with their slice.

    ``buckets`` is the number of files and of tasks that read them; without it, that of shuffle partitions.
    """
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = rows.repartitionByRange(n * SLICES_A_BUCKET, *keys, ts, seq).withColumn(SLICE, F.spark_partition_id())
    by = [*keys, SLICE]
    name = f"ordered_{uuid.uuid4().hex}"
    # one task a bucket, hence one file
    (sliced.repartition(n, *by).write.format("parquet").option("path", path).bucketBy(n, by).sortBy([*by, ts, seq]).saveAsTable(name))
    return _read(spark, name)


def attach(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], ts: str, seq: str, buckets: int) -> DataFrame:
    """The store in ``path``, written with the same keys and buckets; ``schema`` is that of its rows with their slice."""
    name = f"ordered_{uuid.uuid4().hex}"
    by = [*keys, SLICE]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({_quoted(by)}) sorted by ({_quoted([*by, ts, seq])}) "
              f"into {buckets} buckets location '{place}'")
    return _read(spark, name)


def _read(spark: SparkSession, name: str) -> DataFrame:
    # a bucket is one file here, so that the order of its rows is that of the scan
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(name)
