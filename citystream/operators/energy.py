"""Ward energy: quarter-hour summaries, the lake layout, and reports over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.json_rows import compact_json

WINDOW = "15 minutes"
WATERMARK = "45 minutes"
POWER_FACTOR_FLOOR = 0.85
SUMMARY = ["ward_id", "window_start", "window_end", "total_kwh_consumed", "avg_power_factor", "peak_voltage"]


def exact_mean(column: str) -> Column:
    """The mean of readings as the decimal numbers they were sent as: 0.8 and 0.9 have 0.85, in whatever order they are added.

    The sum of doubles may end a little below or above, which matters where the mean is held against a limit. Readings
    that are no such number (NaN, infinite or huge) have the mean of doubles.
    """
    exact = F.col(column).try_cast("decimal(28,17)")
    return F.when(F.count(exact) == F.count(column), F.avg(exact).cast("double")).otherwise(F.avg(column))


def ward_summary(meters: DataFrame, window: str = WINDOW, watermark: str | None = None,
                 with_weights: bool = False, exact: bool = False) -> DataFrame:
    """Per ward and tumbling window: energy used, mean power factor, peak voltage.

    ``with_weights`` adds the sum and count behind the mean, which later roll-ups need. With ``exact``, the mean
    is that of decimal numbers, for rules that compare it with a limit.
    """
    if watermark:
        meters = meters.withWatermark("event_time", watermark)
    extra = [F.sum("power_factor").alias("power_factor_sum"),
             F.count("power_factor").alias("power_factor_count")] if with_weights else []
    return (
        meters.groupBy(F.window("event_time", window), "ward_id")
        .agg(F.sum("kwh_consumed").alias("total_kwh_consumed"),
             (exact_mean("power_factor") if exact else F.avg("power_factor")).alias("avg_power_factor"),
             F.max("voltage").alias("peak_voltage"), *extra)
        .select("ward_id", F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), "total_kwh_consumed", "avg_power_factor",
                "peak_voltage", *(["power_factor_sum", "power_factor_count"] if with_weights else [])))


def summary_records(summary: DataFrame) -> DataFrame:
    return summary.select(F.col("ward_id").cast("string").alias("key"),
                          compact_json(*SUMMARY).alias("value"))


def lake_rows(summary: DataFrame) -> DataFrame:
    return summary.withColumn("date", F.date_format("window_start", "yyyy-MM-dd"))


def write_lake(summary: DataFrame, path: str, mode: str = "append") -> None:
    """Partitioned by ward and date; rows are gathered per folder so each gets few files."""
    (lake_rows(summary).repartition("ward_id", "date")
     .write.mode(mode).partitionBy("ward_id", "date").parquet(path))


def ward_report(summary: DataFrame, period: str) -> DataFrame:
    """Roll quarter-hour rows with weights up to a ``day``, ``week`` or ``month``."""
    start = F.date_trunc(period, F.col("window_start")).cast("date")
    return summary.groupBy("ward_id", start.alias("period_start")).agg(
        F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
        (F.sum("power_factor_sum") / F.sum("power_factor_count")).alias("avg_power_factor"),
        F.max("peak_voltage").alias("peak_voltage"),
        F.count(F.lit(1)).alias("windows"))


def ward_history(lake: DataFrame, ward_id: str, first_date: str | None = None,
                 last_date: str | None = None) -> DataFrame:
    """One ward's rows; both conditions prune lake folders before any file is opened."""
    wanted = F.col("ward_id") == ward_id
    if first_date:
        wanted &= F.col("date") >= first_date
    if last_date:
        wanted &= F.col("date") <= last_date
    return lake.where(wanted)
