"""The current content of a changelog topic, kept up to date by its new records alone.

Every version is a compacted table in its own folder, with the deletions still in it; the greatest offset of each
partition that a version has taken in is therefore in the version itself. Moving on reads the records beyond these marks, merges them
with the version before, and writes the next one. A version counts once its writing is finished, so readers see an old or
the new content, never a part, and a run that dies leaves the old one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.operators.latest import latest_by_key
from citystream.sources import files

COLUMNS = ["key", "value", "partition", "offset"]
SCHEMA = "key string, value string, partition int, offset bigint"
KEPT = 2


class ChangelogSnapshot:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def version(self) -> int | None:
        found = files.versions(self.spark, self.path)
        return found[-1] if found else None

    def compacted(self, version: int | None = None) -> DataFrame:
        """The newest record of every key, deletions included."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/version={version}")

    def content(self) -> DataFrame:
        return self.compacted().where(F.col("value").isNotNull())

    def marks(self) -> dict[int, int]:
        """Per partition of the topic, the greatest offset taken in."""
        return {r["partition"]: r["top"] for r in self.compacted().groupBy("partition").agg(F.max("offset").alias("top")).collect()}

    def starting_offsets(self, topic: str) -> str:
        """The broker option to read on from here, for the partitions known so far."""
        return json.dumps({topic: {str(p): top + 1 for p, top in sorted(self.marks().items())}})

    @staticmethod
    def beyond(marks: dict[int, int]) -> Column:
        """Records not taken in yet; plain comparisons, so that they reach the scan."""
        if not marks:
            return F.lit(True)
        new = ~F.col("partition").isin(list(marks))
        for partition, top in marks.items():
            new = new | ((F.col("partition") == partition) & (F.col("offset") > top))
        return new

    def advance(self, changes: DataFrame) -> int | None:
        """Takes in the records of ``changes`` (an envelope) that are new, and returns the version."""
        version = self.version()
        fresh = changes.where(self.beyond(self.marks())).where(F.col("key").isNotNull()).select(
            "key", "value", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"))
        if fresh.isEmpty():
            return version
        after = 0 if version is None else version + 1
        merged = latest_by_key(self.compacted(version).unionByName(fresh), ["key"], ["partition", "offset"], unique=True)
        merged.write.mode("overwrite").parquet(f"{self.path}/version={after}")
        files.remove(self.spark, f"{self.path}/version={after - KEPT}")
        return after
