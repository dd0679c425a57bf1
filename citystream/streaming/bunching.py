"""Vehicles that stay close, over a stream, by the table operators and state kept as tables.

A micro-batch goes through the same steps as a table: contacts by route, grid cell and time bucket, runs, cooldown. So the
rows of one route are spread over as many tasks as they need, and nothing is looped over per key. What earlier
batches leave behind is three tables with a version per batch, which enter the steps as a few more rows:

    positions    the last report of every vehicle, as if it were a report of this batch
    runs         the last contact of every pair that is still near, and when its run began
    told         the last alert of every pair, for as long as the cooldown lasts

The state of a route is as large as its vehicles and near pairs, whatever it has seen. Rows must not come before those of
earlier batches; ``reorder`` sees to that. A batch that is run again starts from the version before it and writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citystream.functions.times import epoch_ms
from citystream.operators import decode, proximity
from citystream.operators.cooldown import cooldown
from citystream.operators.latest import latest_by_key
from citystream.session import cut
from citystream.sources import files

PAIR = proximity.PAIR
REPORT = "route_id string, bus_id string, lat double, lon double, timestamp string, event_time timestamp, offset bigint"
RUN = "route_id string, bus_1 string, bus_2 string, event_time timestamp, offset bigint, run_start bigint"
TOLD = "route_id string, bus_1 string, bus_2 string, event_time timestamp, offset bigint"
ALERT = ("alert_type string, route_id string, bus_1 string, bus_2 string, distance_m double, duration_min double, threshold_m int, "
         "event_timestamp string")
KEPT = 2


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _state(spark: SparkSession, path: str, name: str, version: int, schema: str) -> DataFrame:
    where = f"{path}/{name}/version={version}"
    if version < 0 or not files.exists(spark, where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(where)


def step(reports: DataFrame, path: str, batch_id: int, near_m: int = proximity.NEAR_M, near_for_ms: int = proximity.NEAR_FOR_MS,
         cooldown_ms: int = proximity.COOLDOWN_MS) -> None:
    """One micro-batch of position reports: writes its alerts and the state after it."""
    spark = reports.sparkSession
    positions, runs, told = (_state(spark, path, n, batch_id - 1, s) for n, s in (("positions", REPORT), ("runs", RUN), ("told", TOLD)))
    fresh = cut(proximity.usable_positions(reports).where("event_time is not null").select(*_columns(REPORT))
                .withColumn("event_time", F.col("event_time").cast("timestamp")))
    last = fresh.agg(F.max("event_time")).first()[0]
    if last is None:    # no usable report: the state goes on as it is
        for name, state in (("positions", positions), ("runs", runs), ("told", told)):
            state.write.mode("overwrite").parquet(f"{path}/{name}/version={batch_id}")
        return
    seen = cut(fresh.unionByName(positions))

    # contacts of the old reports were those of earlier batches
    met = proximity.contacts(seen, near_m).join(positions.select("route_id", "event_time", "offset"), ["route_id", "event_time", "offset"], "left_anti")
    rows = met.unionByName(runs.select(*PAIR, "event_time", "offset"), allowMissingColumns=True)
    near = cut(proximity.near_runs(cut(rows)))
    begun = runs.select(*PAIR, epoch_ms(F.col("event_time")).alias("joined_at"), F.col("run_start").alias("began"))
    near = cut(near.join(begun, PAIR, "left").withColumn("run_start", F.when(F.col("run_start") == F.col("joined_at"), F.col("began"))
                                                        .otherwise(F.col("run_start")))
               .withColumn("near_ms", epoch_ms(F.col("event_time")) - F.col("run_start")).drop("joined_at", "began"))
    found = (near.where((F.col("near_ms") >= near_for_ms) & F.col("distance_m").isNotNull())
             .select(*PAIR, "timestamp", "event_time", "offset", "distance_m", "near_ms"))
    kept = cut(cooldown(cut(found.unionByName(told, allowMissingColumns=True)), PAIR, "event_time", "offset", cooldown_ms))
    alerts = kept.where(F.col("distance_m").isNotNull())
    proximity.bunching_alert_columns(alerts, near_m).select(*_columns(ALERT)).write.mode("overwrite").parquet(f"{path}/alerts/batch_id={batch_id}")

    newest = cut(latest_by_key(seen, ["route_id", "bus_id"], ["event_time", "offset"], unique=True))
    newest.write.mode("overwrite").parquet(f"{path}/positions/version={batch_id}")
    # a run goes on only from a contact that was the last report of both its vehicles
    at = lambda side: newest.select("route_id", F.col("bus_id").alias(f"bus_{side}"),
                                    F.struct("event_time", "offset").alias(f"at_{side}"))
    (latest_by_key(near, PAIR, ["event_time", "offset"], unique=True).join(at(1), ["route_id", "bus_1"]).join(at(2), ["route_id", "bus_2"])
     .where(F.struct("event_time", "offset") == F.greatest("at_1", "at_2")).select(*_columns(RUN))
     .write.mode("overwrite").parquet(f"{path}/runs/version={batch_id}"))
    (latest_by_key(kept.select(*_columns(TOLD)), PAIR, ["event_time", "offset"], unique=True)
     .where(F.unix_millis("event_time") > F.unix_millis(F.lit(last)) - cooldown_ms)
     .write.mode("overwrite").parquet(f"{path}/told/version={batch_id}"))
    for name in ("positions", "runs", "told"):
        files.remove(spark, f"{path}/{name}/version={batch_id - KEPT}")


def start(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **rule) -> StreamingQuery:
    """The rule over an envelope stream of positions; alerts go to ``path``/alerts, a folder per micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        step(decode.detector_input(batch, "bus_gps"), path, batch_id, **rule)

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def alerts(spark: SparkSession, path: str) -> DataFrame:
    if not files.exists(spark, f"{path}/alerts"):
        return spark.createDataFrame([], ALERT)
    return spark.read.schema(ALERT).parquet(f"{path}/alerts").select(*_columns(ALERT))
