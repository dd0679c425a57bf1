"""Looking at neighbouring rows of a key without gathering the key in one task.

The rows, in order of key, time and ``seq``, are cut into slices of about equal row counts, and
window functions run per (keys, slice), so a key with a large share of all rows is spread over
as many tasks as its share asks for, whether its rows come evenly, in bursts or in one instant.
Only the rows at slice edges, a fixed few per slice, are then looked at once more across slices;
there are as many slices as shuffle partitions, and that bounds what one key can have there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.functions.times import epoch_ms, time_slice
from citystream.session import cut

SLICE_MS = 3_600_000


def in_slices(df: DataFrame, keys: Sequence[str], ts: str, seq: str, slice_ms: int | None = None) -> DataFrame:
    """Adds ``_slice``, which rises along the order of each key.

    Slices are ranges of equal row counts, written once so that every reader sees the same cuts.
    Rows known to be evenly spaced can be cut by time instead (``slice_ms``), without that step. Rows of an ordered
    store have their slices already.
    """
    if "_slice" in df.columns:
        return df
    if slice_ms:
        return df.withColumn("_slice", time_slice(F.col(ts), slice_ms))
    return cut(df.repartitionByRange(*keys, ts, seq).withColumn("_slice", F.spark_partition_id()))


def _position(ts: str, seq: str) -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))


def trailing_values(df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, n: int,
                    out: str, slice_ms: int | None = None) -> DataFrame:
    """Adds ``out``: the last ``n`` values of the key up to and including this row.

    Fewer than ``n`` entries while the key has not had that many rows. ``value`` must not be null.
    """
    sliced = in_slices(df, keys, ts, seq, slice_ms)
    local = Window.partitionBy(*keys, "_slice").orderBy(ts, seq)
    one = F.lit(1)
    marked = sliced.withColumns({
        out: F.collect_list(value).over(local.rowsBetween(-(n - 1), 0)),
        "_head": F.lag(one, n - 1).over(local).isNull(),
        "_tail": F.lead(one, n - 1).over(local).isNull(),
    })
    across = Window.partitionBy(*keys).orderBy(ts, seq).rowsBetween(-(n - 1), 0)
    inner = marked.where(~F.col("_head"))
    edge = (marked.where(F.col("_head") | F.col("_tail"))
            .withColumn(out, F.collect_list(value).over(across)).where("_head"))
    return inner.unionByName(edge).drop("_slice", "_head", "_tail")


def neighbour_positions(df: DataFrame, keys: Sequence[str], ts: str, seq: str, before: str, after: str,
                        slice_ms: int | None = None) -> DataFrame:
    """Adds ``before`` and ``after``: ``struct(ts, seq)`` of the key's adjacent rows, or NULL.

    Both parts of the result are written tables, to be read as often as needed.
    """
    sliced = in_slices(df, keys, ts, seq, slice_ms)
    here = _position(ts, seq)
    local = Window.partitionBy(*keys, "_slice").orderBy(ts, seq)
    across = Window.partitionBy(*keys).orderBy(ts, seq)
    found = cut(sliced.withColumns({before: F.lag(here).over(local), after: F.lead(here).over(local)}).drop("_slice"))
    open_end = F.col(before).isNull() | F.col(after).isNull()
    edge = cut(found.where(open_end).withColumns({
        before: F.coalesce(before, F.lag(here).over(across)),
        after: F.coalesce(after, F.lead(here).over(across)),
    }))
    return found.where(~open_end).unionByName(edge)


def run_starts(df: DataFrame, keys: Sequence[str], ts: str, seq: str, previous: str, out: str,
               slice_ms: int | None = None) -> DataFrame:
    """Adds ``out``: the time in milliseconds at which the row's run began.

    A row goes on with a run if ``previous`` (``struct(ts, seq)``) is the row of the key right
    before it; otherwise, or with NULL there, it begins a new one.
    """
    sliced = in_slices(df, keys, ts, seq, slice_ms)
    here, ms = _position(ts, seq), epoch_ms(F.col(ts))
    local = Window.partitionBy(*keys, "_slice").orderBy(ts, seq)
    inside = F.col("_before").isNotNull() & ~F.col("_before").eqNullSafe(F.col(previous))
    marked = cut(sliced.withColumn("_before", F.lag(here).over(local))
                 .withColumn("_start", F.when(inside, ms))
                 .withColumn("_local", F.max("_start").over(local.rowsBetween(Window.unboundedPreceding, 0))))

    # One row per slice says whether its first row goes on from an earlier slice, and since when.
    across = Window.partitionBy(*keys).orderBy("_slice")
    goes_on = F.lag("_last").over(across).eqNullSafe(F.col("_first.previous")) & F.col("_first.previous").isNotNull()
    carried = (
        marked.groupBy(*keys, "_slice").agg(
            F.min(F.struct(here.alias("here"), F.col(previous).alias("previous"))).alias("_first"),
            F.max(here).alias("_last"), F.max("_start").alias("_inside"))
        .withColumn("_head", F.when(~goes_on, epoch_ms(F.col("_first.here.ts"))))
        .withColumn("_earlier", F.max(F.greatest("_inside", "_head")).over(
            across.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*keys, "_slice", F.greatest("_head", "_earlier").alias("_carry")))
    return (marked.join(carried, [*keys, "_slice"]).withColumn(out, F.greatest("_local", "_carry"))
            .drop("_slice", "_before", "_start", "_local", "_carry"))


def running_max(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the greatest ``value`` of all rows before this one in ``order``, NULL at the first.

    One order over all rows: they are cut into ranges of equal row counts, and only one number per range goes on to the
    next ranges. ``order`` should have no ties.
    """
    sliced = cut(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    before = (Window.unboundedPreceding, -1)
    local = Window.partitionBy("_slice").orderBy(*order).rowsBetween(*before)
    tops = sliced.groupBy("_slice").agg(F.max(value).alias("_top"))     # a row per range, which are as many as shuffle partitions
    carried = tops.select("_slice", F.max("_top").over(Window.orderBy("_slice").rowsBetween(*before)).alias("_carried"))
    return (sliced.withColumn("_local", F.max(value).over(local)).join(F.broadcast(carried), "_slice", "left")
            .withColumn(out, F.greatest("_local", "_carried")).drop("_slice", "_local", "_carried"))
