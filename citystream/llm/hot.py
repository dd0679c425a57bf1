"""Joins and running sums that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citystream.session import cut

MOST_HOT, ALWAYS_COLD = 10_000, 100


def lookup(rows: DataFrame, table: DataFrame, key: Sequence[str], size: str, n: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table`` for their key (not null, unique in ``table``); ``how``: inner or left.

    ``size`` says how many of the ``n`` rows have the key. Keys with more than n / MOST_HOT rows are MOST_HOT at
    most, whatever the data; they are broadcast and their rows stay where they are. The others are joined by a shuffle.
    """
    hot = F.col(size) > max(n / MOST_HOT, ALWAYS_COLD)
    few = F.broadcast(table.where(hot))
    # with no row of a hot key, Spark finds the broadcast empty and both joins on it vanish
    rest = rows.join(few.select(*key), list(key), "left_anti").join(table.where(~hot), list(key), how)
    return rows.join(few, list(key)).unionByName(rest)


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group before this one, in order.

    Groups are not null and ``order`` has no ties. Rows are cut into ranges of about equal counts and summed in
    each; a group that spans ranges carries one number from range to range.
    """
    sliced = cut(df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()))
    before = (W.unboundedPreceding, -1)
    local = W.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(*before)
    across = W.partitionBy(*group).orderBy("_slice").rowsBetween(*before)
    carried = (sliced.groupBy(*group, "_slice").agg(F.sum(value).alias("_total"))
               .select(*group, "_slice", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_carried")))
    return (sliced.withColumn(out, F.coalesce(F.sum(value).over(local), F.lit(0))).join(carried, [*group, "_slice"])
            .withColumn(out, F.col(out) + F.col("_carried")).drop("_slice", "_carried"))
