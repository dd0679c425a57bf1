"""Removal of long repeated byte strings with a logarithmic family of indexes over sparse suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in its own
document or another. Only strings of that length or more matter, so the index holds few suffixes:
every string of LENGTH bytes is represented by its anchor, the one of its ``GRAM``-byte substrings with the
smallest 64-bit hash, and neighbouring strings mostly share theirs. Equal strings have equal
anchors. An anchored suffix stands in the index by the fingerprint of its first GRAM bytes, and its place in the order of
suffixes is that of the fingerprint: suffixes that begin alike are neighbours, and only that is asked of the order.

``Levels`` is the index family. A level is a sorted array on disk: dealt to buckets by fingerprint, a file a bucket, each in
order. A new batch gets its own, is merge-scanned against every level bucket by bucket (neither side is shuffled or
sorted again), and then takes part in the geometric merging: two levels of a size are merged, in order, into one of
the next, so n batches are in at most log2(n) + 1 levels and an entry is moved log2(n) times. Levels and the tables of
finished steps are removed as soon as nothing reads them.

Matching fingerprints are candidates. They are made exact by hashes (128 bits) of whole strings:

1. a string whose anchor matches nothing is unique; the others are candidates,
2. the neighbouring strings with one anchor form a run, and what a run covers is compared as one string; equal
   runs settle all their strings, which keeps long copies cheap,
3. what is left, at the edges of shared passages, is compared string by string, also with one
   copy of each settled run that has the same anchor.

Counting is by key with map-side sums, so a passage in a third of all documents is one key with a count; the rows that hold
such a key learn that it repeats from a broadcast of the few keys that common (``hot.lookup``), not in the key's task.
Null and empty texts have no bytes. Rows may repeat (also their ids): every row is a document.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.hot import lookup
from citystream.llm.words import BLOCK, FACTOR, mix, powers, slices, text_bytes
from citystream.session import cut, removed_after, scratch

LENGTH, GRAM, BATCHES = 400, 300, 4
BUCKET_BYTES = 256 << 20    # of text to a bucket, if the session's shuffle partitions would make them larger
NEIGHBOURS = LENGTH - GRAM + 1
FACTORS = (FACTOR, 0xD1342543DE82EF95)


class Hasher:
    """Hashes of byte strings by their place; one instance per task."""

    def __init__(self, factor: int) -> None:
        self.power, self.inverse = powers(factor, BLOCK + (1 << 14))

    def all_of(self, data: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes at every position where there are so many."""
        n = len(data) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.empty(n, np.uint64)
        for first in range(0, n, BLOCK):
            last = min(first + BLOCK, n)
            part = data[first:last + size - 1].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.power[:len(part)], out=sums[1:])
            k = last - first
            out[first:last] = (sums[size:size + k] - sums[:k]) * self.inverse[:k]
        return mix(out)

    def some_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each string data[start:end]; starts are sorted and no string is longer than 16 KB."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            base = int(starts[i])
            j = int(np.searchsorted(starts, base + BLOCK, "left"))
            part = data[base:int(ends[i:j].max())].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.power[:len(part)], out=sums[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * self.inverse[s]
            i = j
        return mix(out ^ (ends - starts).astype(np.uint64))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, ~np.uint64(0), np.uint64)
    padded[:len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def runs(data: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the runs of one text's strings with one anchor, and its fingerprint.

    Of equal anchors of a string the first counts, so a run has NEIGHBOURS strings at most.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, own = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for i in range(0, n, BLOCK):
        j = min(i + BLOCK, n)
        h = hasher.all_of(data[i:j + LENGTH - 1], GRAM)
        low[i:j], own[i:j] = _least(h, NEIGHBOURS), h[:j - i]
    # a run ends where the smallest hash changes, or with the string that starts at its anchor
    first = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (own[:-1] == low[:-1])])
    return first, np.r_[first[1:] - 1, n - 1], low[first]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(FACTORS[0])
    with np.errstate(over="ignore"):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            found = [runs(data[a:b], hasher)[2] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            at = np.r_[0, np.cumsum([len(m) for m in found])].astype(np.int32)
            marks = pa.ListArray.from_arrays(at, pa.array(np.concatenate(found).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("uid"), marks], names=["uid", "mark"])


@contextmanager
def _settings(spark: SparkSession, **settings: str) -> Iterator[None]:
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files of steps whose result is written.

    Spark deletes them once the driver has collected the plans they belong to, which on a quiet driver may
    take half an hour; a job of many large steps would hold all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def buckets(docs: DataFrame) -> int:
    """The session's shuffle partitions, or more where a bucket would hold over BUCKET_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


class Levels:
    """The index family over ``mark``, the fingerprints of anchored suffixes.

    Used with as many shuffle partitions as ``n`` buckets, so that a bucket is written by one task as one file.
    """

    def __init__(self, spark: SparkSession, n: int) -> None:
        self.spark, self.n = spark, n
        self.levels: dict[int, list[DataFrame]] = {}
        self.names: list[str] = []

    def _array(self, marks: DataFrame) -> DataFrame:
        name = f"marks_{uuid.uuid4().hex}"
        marks.write.bucketBy(self.n, "mark").sortBy("mark").option("path", scratch(self.spark, "marks")).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def _merge(self) -> None:
        """Two arrays of a size become one of the next; done when the next batch comes, so the last merge is never in vain."""
        size = 0
        while size <= max(self.levels, default=-1):
            if len(self.levels.get(size, [])) == 2:
                one, other = self.levels.pop(size)
                self.levels.setdefault(size + 1, []).append(self._array(one.hint("merge").join(other, "mark", "full")))
            size += 1

    def scans(self, array: DataFrame) -> list[DataFrame]:
        """The rows of ``array`` whose mark each level holds."""
        return [array.join(level.hint("merge"), "mark", "left_semi") for same in self.levels.values() for level in same]

    def insert(self, suffixes: DataFrame) -> DataFrame:
        """Takes in a batch (mark, a row per suffix) and returns the marks now known to occur again.

        A mark is returned, with its count ``n`` in the batch, if the batch holds it twice or a level holds it.
        """
        self._merge()
        array = self._array(suffixes.groupBy("mark").agg(F.count("*").alias("n")))
        again = array.where("n > 1")
        for found in self.scans(array):
            again = again.union(found)
        self.levels.setdefault(0, []).append(array.select("mark"))
        return cut(again.distinct())

    def close(self) -> None:
        """Forgets the arrays; their files are scratch."""
        for name in self.names:
            self.spark.sql(f"drop table {name}")


def _repeated(suffixes: DataFrame, n: int, path: str) -> DataFrame:
    """Per uid the marks of its suffixes that occur again (``again``), written to ``path``. ``suffixes`` is (uid, mark array)."""
    spark = suffixes.sparkSession
    index, repeated = Levels(spark, n), None
    for batch in range(BATCHES):
        marks = suffixes.where(F.pmod(F.xxhash64("uid"), F.lit(BATCHES)) == batch).select(F.explode("mark").alias("mark"))
        again = index.insert(marks)
        repeated = again if repeated is None else repeated.unionAll(again)
        release_shuffles(spark)
    # counts lack one at most for each batch
    known = cut(repeated.groupBy("mark").agg(F.sum("n").alias("n")))
    total = suffixes.agg(F.sum(F.size("mark"))).first()[0] or 0
    again = cut(lookup(suffixes.select("uid", F.explode("mark").alias("mark")), known, ["mark"], "n", total)
                .groupBy("uid").agg(F.collect_list("mark").alias("again")), path)
    index.close()
    return again


def _numbers(column: pa.Array, k: int, field: str | None = None) -> np.ndarray:
    """The list of row ``k`` as an array, or one field of its structs; none for a null list."""
    values = column[k].values
    if values is None:
        return np.zeros(0, np.int64)
    return (values if field is None else values.field(field)).to_numpy(zero_copy_only=False).astype(np.int64)


KEYS = "uid long, first int, last int, mark long, h long, g long"


def _keys(of: str):
    """Keys of the candidate ``runs`` of each text, of the single strings that no run has settled (``edges``), or of all
    single strings in given ``spans``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [Hasher(f) for f in FACTORS]
        with np.errstate(over="ignore"):
            for part in slices(batches, "text"):
                data, offsets = text_bytes(part.column("text"))
                spans = None if of == "runs" else part.column("spans")
                again = None if of == "spans" else part.column("again")
                for k in range(part.num_rows):
                    text = data[offsets[k]:offsets[k + 1]]
                    first, last, mark = runs(text, hashers[0])
                    if of == "spans":
                        use = np.isin(first, _numbers(spans, k, "first"))
                    else:
                        use = np.isin(mark, _numbers(again, k).view(np.uint64))
                        if of == "edges":
                            use &= ~np.isin(first, _numbers(spans, k, "first"))
                    first, last, mark = first[use], last[use], mark[use]
                    if of != "runs":
                        size = last - first + 1
                        mark = np.repeat(mark, size)
                        first = last = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                    if len(first):
                        h = [x.some_of(text, first, last + LENGTH).view(np.int64) for x in hashers]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(first), part.column("uid")[k].as_py())), pa.array(first.astype(np.int32)),
                             pa.array(last.astype(np.int32)), pa.array(mark.view(np.int64)), *map(pa.array, h)],
                            names=[c.split()[0] for c in KEYS.split(", ")])
    return run


def _spans(rows: DataFrame) -> DataFrame:
    """Of (uid, first, last), a row per uid. A text has at most one span per byte."""
    return rows.groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for part in slices(batches, "text"):
        data, offsets = text_bytes(part.column("text"))
        columns: list[list] = [[], [], [], [], []]
        for k in range(part.num_rows):
            text = data[offsets[k]:offsets[k + 1]]
            first, last = (np.concatenate([_numbers(part.column(c), k, f) for c in "ab"]) for f in ("first", "last"))
            kept, runs = text, []
            if len(first):
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, first, 1)
                np.add.at(change, last + LENGTH, -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                runs = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept = text[~gone]
            for column, value in zip(columns, (len(text), len(text) - len(kept), len(runs), kept.tobytes(), runs), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary()),
             pa.array(columns[4], kind)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (bytes) and removed (start, end)."""
    spark = docs.sparkSession
    n = buckets(docs)
    # rows get ids of their own and lie in buckets, so that later joins move lists and never texts
    name, path = f"texts_{uuid.uuid4().hex}", scratch(spark, "texts")
    at = {label: scratch(spark, label) for label in ("settled", "strings")}
    with (_settings(spark, spark__sql__shuffle__partitions=str(n), spark__sql__legacy__bucketedTableScan__outputOrdering="true"),
          removed_after(spark)):
        (docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text").repartition(n, "uid")
         .write.bucketBy(n, "uid").option("path", path).option("compression", "zstd").saveAsTable(name))
        texts = spark.table(name)
        release_shuffles(spark)
        again = scratch(spark, "again")
        with removed_after(spark):
            suffixes = cut(texts.select("uid", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(
                _anchor_rows, "uid long, mark array<long>"))
            again = _repeated(suffixes, n, again)
        release_shuffles(spark)
        part = texts.select("uid", "text")
        with_again = part.join(again.hint("shuffle_hash"), "uid")
        compared = cut(with_again.mapInArrow(_keys("runs"), KEYS))
        equal = cut(compared.groupBy("h", "g").agg(
            F.count("*").alias("n"), F.min(F.struct("uid", "first", "last", "mark")).alias("one")).where("n > 1"))
        settled = cut(_spans(lookup(compared, equal.select("h", "g", "n"), ["h", "g"], "n", compared.count())), at["settled"])
        release_shuffles(spark)
        edges = cut(with_again.join(settled.hint("shuffle_hash"), "uid", "left").mapInArrow(_keys("edges"), KEYS)
                    .drop("last"))
        meant = cut(equal.groupBy("one.mark").agg(F.count("*").alias("n")).join(edges.select("mark").distinct(), "mark", "left_semi"))
        spelled = lookup(equal.select("one.*"), meant, ["mark"], "n", equal.count())
        inside = part.join(_spans(spelled).hint("shuffle_hash"), "uid").mapInArrow(_keys("spans"), KEYS)
        twice = cut(edges.select("h", "g", F.lit(1).alias("own")).unionAll(inside.select("h", "g", F.lit(0).alias("own")))
                    .groupBy("h", "g").agg(F.count("*").alias("n"), F.sum("own").alias("own")).where("n > 1"))
        strings = cut(_spans(lookup(edges.withColumn("last", F.col("first")), twice.select("h", "g", F.col("own").alias("n")), ["h", "g"], "n",
                                    edges.count())), at["strings"])
    result = (texts.join(settled.withColumnRenamed("spans", "a").hint("shuffle_hash"), "uid", "left")
              .join(strings.withColumnRenamed("spans", "b").hint("shuffle_hash"), "uid", "left").select("doc_id", "text", "a", "b")
              .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<start:int,end:int>>"))
    spark.sql(f"drop table {name}")  # the catalog's entry; its files are scratch like the rest
    return result


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
