"""Small reference tables: CSV files, changelogs, the energy lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream import schemas
from citystream.operators.latest import latest_by_key

# The five zones and five routes the city publishes.
ZONE_PROFILE_ROWS = [
    ("North", "North Zone", 125000, 12, 3, 48),
    ("South", "South Zone", 98000, 8, 2, 35),
    ("East", "East Zone", 145000, 15, 4, 52),
    ("West", "West Zone", 112000, 10, 2, 41),
    ("Central", "Central Zone", 200000, 25, 6, 28),
]
ROUTE_SCHEDULE_ROWS = [
    ("R10", "Airport Express", "Airport", "08:45"),
    ("R11", "Tech Park Shuttle", "Tech Park", "09:00"),
    ("R12", "City Center Loop", "City Center", "09:15"),
    ("R13", "Ring Road Service", "Ring Road", "09:30"),
    ("R14", "Metro Connector", "Metro Station", "09:45"),
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema; blank lines are skipped."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def _published(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as a relation whose size the planner knows, unlike that of an RDD."""
    values = ", ".join(str(row) for row in rows)
    names = ", ".join(schema.fieldNames())
    return spark.sql(f"select * from values {values} as t({names})").to(schema)


def zone_profile(spark: SparkSession, path: str | None = None) -> DataFrame:
    """From a CSV file, or the published five zones.

    Joins carry no broadcast hint: Spark broadcasts the table as long as its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it.
    """
    if path:
        return read_csv(spark, path, schemas.ZONE_PROFILE)
    return _published(spark, ZONE_PROFILE_ROWS, schemas.ZONE_PROFILE)


def route_schedule(spark: SparkSession, path: str | None = None) -> DataFrame:
    """From a CSV file, where the last of several lines of a route counts, or the published five routes."""
    if path:
        lines = read_csv(spark, path, schemas.ROUTE_SCHEDULE).withColumn("_line", F.monotonically_increasing_id())
        return latest_by_key(lines, ["route_id"], ["_line"]).drop("_line")
    return _published(spark, ROUTE_SCHEDULE_ROWS, schemas.ROUTE_SCHEDULE)


def cached_reference(df: DataFrame, view: str) -> tuple[DataFrame, int]:
    """Keep a reference table in memory, name it for SQL, and report its row count."""
    df = df.cache()
    df.createOrReplaceTempView(view)
    return df, df.count()


def changelog(table: DataFrame, key: str, topic: str) -> DataFrame:
    """A reference table as keyed records for a changelog topic."""
    return table.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"))


def read_lake(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def lake_wards(lake: DataFrame) -> DataFrame:
    return lake.select("ward_id").distinct()
