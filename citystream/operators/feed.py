"""Signal feed lines for the two priority lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANES = ("HIGH_PRIORITY", "STANDARD_PRIORITY")


def signal_feed(signals: DataFrame, lane: str) -> DataFrame:
    line = F.format_string(f"[{lane}] junction=%s vehicles=%d phase=%s",
                           "junction_id", "vehicle_count", "signal_phase")
    return signals.withColumn("line", line)


def ordered_within_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows in key order and, per key, in ``order``, as a keyed topic would deliver them.

    Range partitions on the whole sort key: a key with very many rows spreads over several
    neighbouring partitions instead of filling one.
    """
    return df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
