"""Rolling air quality per zone and the health advisories drawn from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.functions import levels
from citystream.functions.json_rows import compact_json

WIDTH = "10 minutes"
SLIDE = "1 minute"
WATERMARK = "10 minutes"
UNHEALTHY = 150
METRICS = {"aqi": "rolling_avg_aqi", "pm25": "rolling_avg_pm25", "pm10": "rolling_avg_pm10"}
ADVISORY = ["zone", "zone_name", "population", "num_schools", "num_hospitals", "window_start",
            "window_end", *METRICS.values(), "advisory_level", "advisory_message"]


def rolling_aqi(air: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """Sliding means as a stream keeps them: each reading belongs to ten windows."""
    if watermark:
        air = air.withWatermark("event_time", watermark)
    return (
        air.groupBy(F.window("event_time", WIDTH, SLIDE), "zone")
        .agg(*[F.avg(c).alias(out) for c, out in METRICS.items()])
        .select("zone", F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), *METRICS.values()))


def rolling_aqi_from_panes(air: DataFrame, panes: int = 10, pane: str = SLIDE) -> DataFrame:
    """The same means for a table, through one-slide panes.

    Readings are first reduced to sums and counts per zone and pane, and only these few rows
    are repeated for the windows they fall in; the input itself is never multiplied.
    """
    parts = [x for c in METRICS for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    reduced = (air.groupBy(F.window("event_time", pane).alias("pane"), "zone").agg(*parts)
               .withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(panes - 1)))))
    length = F.col("pane.end") - F.col("pane.start")
    start = F.col("pane.start") - F.col("back") * length
    means = [F.when(F.sum(f"{c}_n") > 0, F.sum(f"{c}_sum") / F.sum(f"{c}_n")).alias(out)
             for c, out in METRICS.items()]
    return (reduced.select("zone", start.alias("window_start"), (start + panes * length).alias("window_end"),
                           *[f"{c}_{p}" for c in METRICS for p in ("sum", "n")])
            .groupBy("zone", "window_start", "window_end").agg(*means))


def advisories(rolling: DataFrame, zones: DataFrame, threshold: float = UNHEALTHY) -> DataFrame:
    """Windows above the threshold with the zone's profile, level and advice."""
    aqi = F.col("rolling_avg_aqi")
    return (rolling.join(zones, "zone", "left").where(aqi > threshold)
            .withColumn("advisory_level", levels.advisory_level(aqi))
            .withColumn("advisory_message", levels.advisory_message(aqi))
            .select(*ADVISORY))


def advisory_records(found: DataFrame) -> DataFrame:
    return found.select(F.col("zone").cast("string").alias("key"), compact_json(*ADVISORY).alias("value"))


def _case(table: list[tuple[int | None, str]]) -> str:
    branches = " ".join(f"when rolling_avg_aqi > {bound} then '{text}'" for bound, text in table[:-1])
    return f"case {branches} else '{table[-1][1]}' end"


_USABLE = "zone is not null and aqi between 0 and 500"
_SLIDING = f"""
    select zone, window.start as window_start, window.end as window_end,
           avg(aqi) as rolling_avg_aqi, avg(pm25) as rolling_avg_pm25, avg(pm10) as rolling_avg_pm10
    from {{air_view}} where {_USABLE} group by zone, window(event_time, '{WIDTH}', '{SLIDE}')"""
_PANES = f"""
    with panes as (
      select zone, window.start as pane, sum(aqi) as aqi, count(aqi) as aqi_n, sum(pm25) as pm25, count(pm25) as pm25_n,
             sum(pm10) as pm10, count(pm10) as pm10_n
      from {{air_view}} where {_USABLE} group by zone, window(event_time, '{SLIDE}')),
    spread as (select *, explode(sequence(pane - interval {WIDTH} + interval {SLIDE}, pane, interval {SLIDE})) as window_start from panes)
    select zone, window_start, window_start + interval {WIDTH} as window_end, sum(aqi) / nullif(sum(aqi_n), 0) as rolling_avg_aqi,
           sum(pm25) / nullif(sum(pm25_n), 0) as rolling_avg_pm25, sum(pm10) / nullif(sum(pm10_n), 0) as rolling_avg_pm10
    from spread group by zone, window_start"""


def advisories_sql(spark: SparkSession, air_view: str = "aqi_stream", zone_view: str = "zone_profile",
                   rolling_view: str = "rolling_aqi") -> DataFrame:
    """The advisory as SQL over named views, for a table or a watermarked stream.

    ``air_view`` holds decoded readings; the rolling means are left behind as ``rolling_view``. Over a table they come from
    one-slide panes, so that readings are reduced before anything is repeated; a stream keeps its ten windows.
    """
    spark.sql(_SLIDING.format(air_view=air_view) if spark.table(air_view).isStreaming else _PANES.format(air_view=air_view)
              ).createOrReplaceTempView(rolling_view)
    return spark.sql(f"""
        select r.zone, zone_name, population, num_schools, num_hospitals, window_start, window_end,
               rolling_avg_aqi, rolling_avg_pm25, rolling_avg_pm10,
               {_case(levels.ADVISORY_LEVELS)} as advisory_level,
               {_case(levels.ADVISORY_MESSAGES)} as advisory_message
        from {rolling_view} r left join {zone_view} z on r.zone = z.zone
        where rolling_avg_aqi > {UNHEALTHY}
    """)
