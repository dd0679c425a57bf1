"""Vehicles of one route that stay close to each other.

Every position report is compared with the last known position of the route's other vehicles,
but only with those near enough to matter: reports and position intervals meet on route, grid
cell and time bucket, so far-apart pairs are never formed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.geo import CELL_REACHES, haversine_m, with_cell, with_cells_within
from citystream.functions.times import epoch_ms
from citystream.operators.cooldown import cooldown
from citystream.operators.detect import BUNCHING_ALERT
from citystream.operators.ordered import neighbour_positions, run_starts
from citystream.session import cut

# Fixed values of the city's bunching rule.
NEAR_M = 200
NEAR_FOR_MS = 300_000
COOLDOWN_MS = 300_000

# Time buckets of level n last this long times 4 to the n. A position goes to the level that is at
# most as long as it stays current, and at least a quarter of that: so it lies in five buckets or
# fewer, which cover less than twice its time on average. Every report is looked up in every level;
# a level of few positions is not worth that, they lie in more buckets of one up to DEEPER below.
BUCKET_MS = 100
TOP_LEVEL = 15
DEEPER = 3
CELL = ["level", "bucket", "band", "cell"]
PAIR = ["route_id", "bus_1", "bus_2"]


def usable_positions(gps: DataFrame) -> DataFrame:
    return gps.where(
        F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
        & (F.col("bus_id") != "") & (F.col("route_id") != ""))


def _level() -> Column:
    stays = F.greatest(F.col("until") - F.col("ms"), F.lit(BUCKET_MS))
    return F.least(F.floor(F.log2(stays / BUCKET_MS) / 2), F.lit(TOP_LEVEL)).cast("int")


def _bucket(ms: Column, level: Column) -> Column:
    return F.floor(ms / (F.pow(F.lit(4.0), level) * BUCKET_MS))


def kept_levels(found: Mapping[int, tuple[int, float]]) -> list[int]:
    """The levels that are worth a copy of every report, given the number of positions of each and their time in all.

    Positions of the others go to the next kept level below, never above, where reports would meet more that are not
    current. So rare long silences, of which a longer history has more kinds, add no copies.
    """
    reports, kept = sum(n for n, _ in found.values()), []
    cells = (1 + 2 / CELL_REACHES) ** 2     # of one position, on average
    for level in sorted(found):
        if kept and level - kept[-1] <= DEEPER:
            buckets = found[level][1] / BUCKET_MS * (4.0 ** -kept[-1] - 4.0 ** -level)
            if buckets * cells < reports:
                continue
        kept.append(level)
    return kept


def meetings(gps: DataFrame, near_m: float = NEAR_M, slice_ms: int | None = None) -> DataFrame:
    """Reports and last known positions of other vehicles that share route, time bucket and grid cell."""
    seen = neighbour_positions(
        usable_positions(gps).select("route_id", "bus_id", "lat", "lon", "timestamp", "event_time", "offset"),
        ["route_id", "bus_id"], "event_time", "offset", "before", "after", slice_ms)
    seen = seen.where("event_time is not null").withColumns({
        "ms": epoch_ms(F.col("event_time")), "here": F.struct(F.col("event_time").alias("ts"), F.col("offset").alias("seq"))})

    # A vehicle without a later report keeps its position up to the end of the data.
    last_ms = seen.agg(F.max("ms")).scalar()
    seen = seen.withColumn("until", F.coalesce(epoch_ms(F.col("after.ts")), last_ms)).withColumn("level", _level())
    found = seen.groupBy("level").agg(F.count("*").alias("n"), F.sum((F.col("until") - F.col("ms")).cast("double")).alias("stay"))
    levels = kept_levels({r.level: (r.n, r.stay) for r in found.collect()})  # TOP_LEVEL + 1 rows at most
    seen = seen.withColumn("level", F.coalesce(*[F.when(F.col("level") >= x, x) for x in reversed(levels)], "level"))
    known = (
        seen.select("route_id", "level",
                    F.col("bus_id").alias("other_bus"), F.col("lat").alias("other_lat"),
                    F.col("lon").alias("other_lon"), F.col("timestamp").alias("other_timestamp"),
                    F.col("here").alias("known_at"), F.col("after").alias("replaced_at"),
                    F.explode(F.sequence(_bucket(F.col("ms"), F.col("level")),
                                         _bucket(F.col("until"), F.col("level")))).alias("bucket")))
    known = with_cells_within(known, "other_lat", "other_lon", near_m)
    reports = (
        with_cell(seen.select("route_id", "bus_id", "lat", "lon", "timestamp", "ms", "here", "before"), "lat", "lon", near_m)
        .withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
        .withColumn("bucket", _bucket(F.col("ms"), F.col("level"))).drop("ms"))

    met = reports.join(known, ["route_id", *CELL]).where(F.col("bus_id") != F.col("other_bus"))
    return met.withColumns({"event_time": F.col("here.ts"), "offset": F.col("here.seq")})


def contacts(gps: DataFrame, near_m: float = NEAR_M, slice_ms: int | None = None) -> DataFrame:
    """One row per report and other vehicle of the route that was last seen closer than ``near_m``.

    ``other_timestamp`` tells when that was. ``previous`` is the report that last changed the distance of this pair, or NULL at its first.
    """
    met = meetings(gps, near_m, slice_ms).where(
        (F.col("known_at") < F.col("here"))
        & (F.col("replaced_at").isNull() | (F.col("here") < F.col("replaced_at"))))
    far = haversine_m(F.col("lat"), F.col("lon"), F.col("other_lat"), F.col("other_lon"))
    return met.withColumn("distance_m", far).where(F.col("distance_m") < near_m).select(
        "route_id",
        F.least("bus_id", "other_bus").alias("bus_1"), F.greatest("bus_id", "other_bus").alias("bus_2"),
        "timestamp", "event_time", "offset", "distance_m", "other_timestamp",
        F.when(F.col("before").isNotNull(), F.greatest("before", "known_at")).alias("previous"))


def near_runs(met: DataFrame, slice_ms: int | None = None) -> DataFrame:
    """Adds ``near_ms``: how long the pair has been near without a report that parted it.

    A run goes on as long as the report that last changed the pair's distance was itself a
    contact; so separations need no rows of their own.
    """
    runs = run_starts(met, PAIR, "event_time", "offset", "previous", "run_start", slice_ms)
    return runs.withColumn("near_ms", epoch_ms(F.col("event_time")) - F.col("run_start"))


def bunching_alert_columns(df: DataFrame, near_m: int = NEAR_M) -> DataFrame:
    return df.withColumns({
        "alert_type": F.lit("BUS_BUNCHING"),
        "distance_m": F.round("distance_m", 2),
        "duration_min": F.round(F.col("near_ms") / 60_000, 2),
        "threshold_m": F.lit(near_m),
        "event_timestamp": F.col("timestamp"),
    })


def bus_bunching(gps: DataFrame, near_m: int = NEAR_M, near_for_ms: int = NEAR_FOR_MS,
                 cooldown_ms: int = COOLDOWN_MS, slice_ms: int | None = None) -> DataFrame:
    # written before the runs are sought: the ranges they are cut into take a pass of their own over the contacts
    met = cut(contacts(gps, near_m, slice_ms).drop("other_timestamp"))
    found = cut(near_runs(met, slice_ms).where(F.col("near_ms") >= near_for_ms).select(
        *PAIR, "timestamp", "event_time", "offset", "distance_m", "near_ms"))
    kept = cooldown(found, PAIR, "event_time", "offset", cooldown_ms)
    return bunching_alert_columns(kept, near_m).select(*BUNCHING_ALERT, "event_time")
