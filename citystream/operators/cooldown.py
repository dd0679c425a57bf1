"""Alert thinning: after an alert of a key, further ones are held back for a while.

Which rows survive is a chain (each survivor decides the next), so it is computed in steps
that keep every group bounded, however many rows a key has and however long its history is:

1. Only distinct alert times matter. They are cut into slices per key; a slice holds at most
   one time per millisecond. Each slice is reduced to a step function: for every time that
   could be its first survivor, the time of its last one.
2. Step functions compose: those of ``FAN`` neighbouring slices are reduced to one of the same
   form, and again, until a key's history is a few slices long.
3. On the way back down, every slice learns when the last survivor before it was. One task
   follows the step functions of ``FAN`` slices at a time, never a key's whole history.
4. With that known, all slices find their survivors independently.

The surviving times are then joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream.functions.times import epoch_ms
from citystream.operators.ordered import SLICE_MS
from citystream.session import cut

#: Slices that are composed, and followed, together.
FAN = 64
NEVER = np.iinfo("int64").min


def whole_groups(batches: Iterator[pd.DataFrame], by: Sequence[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Re-cut batches of rows sorted by ``by`` so that no group spans two of them.

    Yields the rows and, per row, the number of its group. Holds back one group at most.
    """
    held: list[pd.DataFrame] = []

    def numbered(rows: pd.DataFrame) -> np.ndarray:
        changed = np.zeros(len(rows), dtype=bool)
        for name in by:
            column = rows[name].to_numpy()
            changed[1:] |= column[1:] != column[:-1]
        return np.cumsum(changed)

    for batch in batches:
        if batch.empty:
            continue
        number = numbered(batch)
        cut_at = int(np.searchsorted(number, number[-1]))
        same_as_held = bool(held) and all(held[-1][c].iloc[-1] == batch[c].iloc[0] for c in by)
        if cut_at == 0 and same_as_held:
            held.append(batch)
            continue
        complete = pd.concat([*held, batch.iloc[:cut_at]], ignore_index=True)
        held = [batch.iloc[cut_at:]]
        if not complete.empty:
            yield complete, numbered(complete)
    if held:
        rest = pd.concat(held, ignore_index=True)
        yield rest, numbered(rest)


def slice_steps(group: np.ndarray, offset: np.ndarray, interval: int, slice_ms: int,
                ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Step functions of many slices at once.

    ``offset`` is the time since the slice began, sorted within each ``group``. With ``ends``
    the rows are steps of shorter slices: a row taken at ``offset`` leaves the survivor ``ends``.
    Returns the rows that can be a slice's first survivor and, for each, the row of its last
    survivor. Neighbouring starts with the same outcome are given by the latest of them.
    """
    n = len(group)
    line = group * (slice_ms + interval + 1)
    hop = np.searchsorted(line + offset, line + (offset if ends is None else ends) + interval)
    within = hop < n
    within[within] = group[hop[within]] == group[within]
    last = np.where(within, hop, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    early = offset < interval
    begins = np.append(True, group[1:] != group[:-1])
    first_late = ~early & (begins | np.append(True, early[:-1]))
    starts = np.flatnonzero(early | first_late)
    outcome = last[starts]
    keep = np.append((outcome[1:] != outcome[:-1]) | (group[starts[1:]] != group[starts[:-1]]), True)
    return starts[keep], outcome[keep]


def entry_times(group: np.ndarray, slices: np.ndarray, start: np.ndarray, last: np.ndarray,
                entry: np.ndarray, interval: int) -> tuple[np.ndarray, np.ndarray]:
    """The last survivor before each slice, for many groups of slices at once.

    ``start`` and ``last`` are steps, sorted within ``group``; ``entry`` is the survivor before
    each group (``NEVER``: none). Returns the first row of each slice and the time, or ``NEVER``.
    """
    n, begins = len(group), np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    origin = start[begins]
    width = int((last - origin[group]).max()) + interval + 1
    line = group * width + start - origin[group]
    hop = np.searchsorted(line, group * width + last - origin[group] + interval)
    release = np.where(entry == NEVER, 0, np.clip(np.maximum(entry, 0 - 2**60) + interval - origin, 0, width - 1))
    owner = np.arange(len(begins))
    here = np.searchsorted(line, owner * width + release)
    survivor = np.full(n, NEVER)
    while True:  # at most once per slice, all groups together
        live = here < n
        live[live] = group[here[live]] == owner[live]
        here, owner = here[live], owner[live]
        if not len(here):
            break
        survivor[here] = last[here]
        here = hop[here]
    heads = np.flatnonzero(np.append(True, (slices[1:] != slices[:-1]) | (group[1:] != group[:-1])))
    before = np.append(NEVER, np.maximum.reduceat(survivor, heads)[:-1])
    before[np.isin(heads, begins)] = entry
    return heads, pd.Series(before).groupby(group[heads]).cummax().to_numpy()


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _steps(rows: DataFrame, keys: Sequence[str], interval_ms: int, slice_ms: int) -> DataFrame:
    """Times, or steps of shorter slices (``_start``, ``_last``), reduced to the steps of each slice."""
    slice_key = [*keys, "_slice"]

    def reduce_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, group in whole_groups(batches, slice_key):
            start, last, number = (part[c].to_numpy("int64") for c in ("_start", "_last", "_slice"))
            first, final = slice_steps(group, start - number * slice_ms, interval_ms, slice_ms, last - number * slice_ms)
            yield part.iloc[first][slice_key].assign(_start=start[first], _last=last[final])

    placed = rows.select(*keys, F.floor(F.col("_start") / slice_ms).alias("_slice"), "_start", "_last")
    fields = [*(rows.schema[k] for k in keys), _long("_slice"), _long("_start"), _long("_last")]
    return cut(placed.repartition(*slice_key).sortWithinPartitions(*slice_key, "_start")
               .mapInPandas(reduce_slices, T.StructType(fields)))


def _entries(steps: DataFrame, keys: Sequence[str], interval_ms: int, above: DataFrame | None) -> DataFrame:
    """``_before``, the last survivor before each slice, given that of the longer slices ``above``."""
    group_key, slice_key = [*keys, "_group"], [*keys, "_slice"]
    if above is None:
        known = steps.withColumns({"_group": F.lit(0).cast("bigint"), "_entry": F.lit(NEVER)})
    else:
        longer = above.select(*keys, F.col("_slice").alias("_group"), F.coalesce("_before", F.lit(NEVER)).alias("_entry"))
        known = steps.withColumn("_group", F.floor(F.col("_slice") / FAN)).join(longer, group_key)

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, group in whole_groups(batches, group_key):
            slices, start, last, entry = (part[c].to_numpy("int64") for c in ("_slice", "_start", "_last", "_entry"))
            first = np.append(True, group[1:] != group[:-1])
            heads, before = entry_times(group, slices, start, last, entry[first], interval_ms)
            yield part.iloc[heads][slice_key].assign(_before=pd.Series(before, dtype="Int64").mask(before == NEVER).array)

    fields = [*(steps.schema[k] for k in keys), _long("_slice"), _long("_before")]
    return (known.select(*group_key, "_slice", "_start", "_last", "_entry").repartition(*group_key)
            .sortWithinPartitions(*group_key, "_start").mapInPandas(follow, T.StructType(fields)))


def surviving_times(times: DataFrame, keys: Sequence[str], interval_ms: int,
                    slice_ms: int = SLICE_MS) -> DataFrame:
    """``times`` has the keys and distinct ``_t`` in milliseconds; the result has the survivors."""
    slice_key = [*keys, "_slice"]
    placed = times.select(*keys, "_t", F.floor(F.col("_t") / slice_ms).alias("_slice"))
    t = F.col("_t")
    levels, length = [_steps(times.select(*keys, t.alias("_start"), t.alias("_last")), keys, interval_ms, slice_ms)], slice_ms
    low, high = levels[0].agg(F.min("_slice"), F.max("_slice")).first()
    while low is not None and high - low >= FAN:
        length, low, high = length * FAN, low // FAN, high // FAN
        levels.append(_steps(levels[-1], keys, interval_ms, length))
    entries = None
    for level in reversed(levels):
        entries = _entries(level, keys, interval_ms, entries)

    def extend(found, t):
        free = found["last"].isNull() | (t >= found["last"] + interval_ms)
        return F.when(free, F.struct(t.alias("last"), F.concat(found["kept"], F.array(t)).alias("kept"))
                      ).otherwise(found)

    gathered = placed.groupBy(*slice_key).agg(F.array_sort(F.collect_list("_t")).alias("_ts"))
    start = F.struct(F.col("_before").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    return (gathered.join(entries, slice_key)
            .select(*keys, F.explode(F.aggregate("_ts", start, extend)["kept"]).alias("_t")))


def cooldown(df: DataFrame, keys: Sequence[str], ts: str, seq: str, interval_ms: int,
             slice_ms: int = SLICE_MS) -> DataFrame:
    """Rows of ``df`` that come at least ``interval_ms`` after the last kept row of their key.

    Rows are taken in order of time and ``seq``; of several rows in the same millisecond only
    the first can be kept; rows without a time have no place in the order and are not kept. ``df`` is read twice, so pass a table or a checkpointed result.
    """
    timed = df.where(F.col(ts).isNotNull()).withColumn("_t", epoch_ms(F.col(ts)))
    times = timed.select(*keys, "_t").distinct()
    kept = surviving_times(times, keys, interval_ms, slice_ms)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(ts, seq)).alias("_row")
    # Before the join, so that many copies of one reading are reduced where they are read.
    firsts = timed.groupBy(*keys, "_t").agg(first)
    return firsts.join(kept, [*keys, "_t"]).select(*keys, "_row.*").select(*df.columns)
