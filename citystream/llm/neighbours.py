"""Nearest neighbours by cosine, with several shifted Hilbert orderings and exact reranking.

Equal vectors form a class that is searched once and keeps its smallest ids, so a huge group of
copies is one row. For each of ``CURVES`` curves, unit vectors are projected on ``DIMENSIONS`` random
directions, shifted, and put in the order of a Hilbert curve through that space; Spark sorts all
curves at once by range. A query's candidates are the rows within ``reach`` places of it on any curve.
They are compared block by block of the orderings, each block keeps its best, and those are merged.

``reach`` is measured, not guessed: for a bounded sample of queries the true neighbours are found by
comparing them with every row, and ``reach`` is how near on their nearest curve ``RECALL`` of them
are, plus a quarter. Data without structure thus get a long reach, and data with clusters a short one.

Vectors that are null, zero, or hold a null, NaN or infinite component take no part. There is no cosine between
vectors of different lengths: those of each length are searched by themselves. Ties go to the smaller id. A query with fewer candidates gets them all.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from citystream.session import cut

CURVES, DIMENSIONS, BITS = 8, 10, 6
FIT_ROWS, PROBES, RECALL = 5_000, 100, 0.98
LEAST_BLOCK, MOST_BLOCK = 256, 32_768


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, d) with coordinates below 2**bits.

    Coordinates are turned into the curve's own frame from the highest bit down (reflections and
    exchanges with the first axis), Gray-decoded across axes, and interleaved.
    """
    x = x.astype(np.int64).copy()
    d = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit = 1 << level
        low = bit - 1
        for k in range(d):
            flip = (x[:, k] & bit) != 0
            change = np.where(flip, 0, (x[:, 0] ^ x[:, k]) & low)
            x[:, 0] ^= np.where(flip, low, change)
            x[:, k] ^= change
    for k in range(1, d):
        x[:, k] ^= x[:, k - 1]
    fix = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        fix ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= fix[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for k in range(d):
            key = (key << 1) | ((x[:, k] >> level) & 1)
    return key


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _usable(vectors: DataFrame, dtype: str) -> DataFrame:
    e = F.col("embedding").cast(f"array<{dtype}>")
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
            .where("vec_id is not null and size(embedding) > 0").where(fine))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For every row of ``queries`` the ``k`` nearest other rows of ``vectors`` (both vec_id, embedding).

    Queries must be rows of ``vectors``. Returns query_id, rank (from 1), vec_id, score.
    """
    kind = vectors.schema["embedding"].dataType
    dtype, np_dtype = ("float", "<f4") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else ("double", "<f8")
    rows, asked = _usable(vectors, dtype), _usable(queries, dtype)
    size = F.size("embedding")
    lengths = sorted(r.n for r in asked.select(size.alias("n")).distinct().collect())   # of vectors: commonly one
    found = [_nearest(rows.where(size == n), asked.where(size == n), n, np_dtype, k) for n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, asked: DataFrame, size: int, np_dtype: str, k: int) -> DataFrame:
    """The same for usable vectors of one length."""
    # the k + 1 smallest ids of each class: whichever is the query's own, k are left
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    classes = cut(first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                  .select(F.element_at("ids", 1).alias("rep"), "ids", "embedding"))
    count = classes.count()
    wanted = cut(asked.join(classes.select("rep", "embedding"), "embedding").select("vec_id", "rep"))

    fit = classes.orderBy(F.xxhash64("rep"), "rep").limit(FIT_ROWS).select("embedding").toPandas()
    unit = _unit(np.array(fit["embedding"].tolist(), float))
    random = np.random.default_rng(5)
    dims = min(DIMENSIONS, size)
    frames = []
    for _ in range(CURVES):
        axes = np.linalg.qr(random.normal(size=(size, dims)))[0]
        seen = unit @ axes
        frames.append((axes, seen.mean(0), np.maximum(seen.std(0), 1e-9), random.uniform(0, 0.5, dims)))

    def order(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.array(batch.column("embedding").to_pylist(), np_dtype)
            packed = pa.array([r.tobytes() for r in raw], pa.binary())
            points = _unit(raw.astype(float))
            for c, (axes, mean, spread, shift) in enumerate(frames):
                # three standard deviations either way fill half the grid, the shift moves them in it
                place = np.clip(((points @ axes - mean) / spread + 3) / 12 + shift, 0, 1 - 1e-9)
                key = hilbert((place * (1 << BITS)).astype(np.int64), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key), batch.column("rep"), packed],
                                                 names=["curve", "key", "rep", "vector"])

    sorted_ = cut(classes.select("rep", "embedding").mapInArrow(order, "curve int, key long, rep long, vector binary")
                  .repartitionByRange("curve", "key", "rep").sortWithinPartitions("curve", "key", "rep")
                  .withColumn("at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(2**33 - 1)
    # a row per partition of the sort
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    offsets = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("offset"))
    ranked = cut(sorted_.withColumn("part", part).join(F.broadcast(offsets), "part")
                 .select("curve", "rep", "vector", (F.col("offset") + inside - F.col("curve") * F.lit(count)).alias("place")))

    searched = wanted.select(F.col("rep").alias("q")).distinct()
    places = cut(ranked.join(searched, F.col("rep") == F.col("q"), "left_semi").select(F.col("rep").alias("q"), "curve", "vector", "place"))
    reach = _reach(classes, places, ranked, count, np_dtype, k)
    side = int(min(max(reach // 4, LEAST_BLOCK), MOST_BLOCK))
    block = lambda p: F.floor(p / F.lit(side))
    spread = places.withColumn("block", F.explode(F.sequence(
        block(F.greatest(F.col("place") - reach, F.lit(0))), block(F.least(F.col("place") + reach, F.lit(count - 1))))))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "rep": [], "score": []}).astype({"q": "int64", "rep": "int64", "score": "float64"})
        x, y = (np.frombuffer(b"".join(f["vector"]), np_dtype).reshape(len(f), -1).astype(float) for f in (left, right))
        rep = right["rep"].to_numpy()
        norm = np.sqrt((y * y).sum(1))
        found = []
        for q, v in zip(left["q"].to_numpy(), x, strict=True):
            score = (y @ v) / (norm * np.sqrt((v * v).sum()))
            if len(score) > k + 1:      # the query's own class may be one of them
                near = np.flatnonzero(score >= np.partition(score, -k - 1)[-k - 1] - 1e-12)
            else:
                near = np.arange(len(score))
            exact = (y[near] * v).sum(1) / (norm[near] * np.sqrt((v * v).sum()))
            top = np.lexsort((rep[near], -exact))[:k + 1]
            found.append(pd.DataFrame({"q": q, "rep": rep[near[top]], "score": exact[top]}))
        return pd.concat(found)

    hits = (spread.groupBy("curve", "block").cogroup(ranked.withColumn("block", block(F.col("place"))).groupBy("curve", "block"))
            .applyInPandas(compare, "q long, rep long, score double"))
    best = W.partitionBy("q").orderBy(F.desc("score"), "rep")
    own = F.col("q") == F.col("rep")
    merged = (hits.dropDuplicates(["q", "rep"]).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
              .unionByName(searched.select("q", F.col("q").alias("rep"), F.lit(1.0).alias("score"), F.lit(0).alias("n")))
              .groupBy("q", "rep").agg(F.min("score").alias("score")).withColumn("score", F.when(own, F.least("score", F.lit(1.0))).otherwise(F.col("score"))))
    members = merged.join(classes.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    ranks = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (wanted.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("q")).join(members, "q")
            .where("query_id <> vec_id").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _reach(classes: DataFrame, places: DataFrame, ranked: DataFrame, count: int, np_dtype: str, k: int) -> int:
    """How many places apart, on their nearest curve, RECALL of a sample of true neighbours are."""
    probe = places.where("curve = 0").orderBy(F.xxhash64("q"), "q").limit(PROBES).select("q", "vector").toPandas()
    if not len(probe):
        return 1
    ids = probe["q"].to_numpy()
    asked = _unit(np.frombuffer(b"".join(probe["vector"]), np_dtype).reshape(len(probe), -1).astype(float))

    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rep = batch.column("rep").to_numpy()
            score = asked @ _unit(np.array(batch.column("embedding").to_pylist(), float)).T
            score[ids[:, None] == rep[None, :]] = -2
            near = np.argsort(-score, 1)[:, :k]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, near.shape[1])), pa.array(rep[near].ravel()),
                                              pa.array(np.take_along_axis(score, near, 1).ravel())], names=["q", "rep", "score"])

    scanned = classes.select("rep", "embedding").mapInArrow(scan, "q long, rep long, score double").where("score >= -1.5")
    true = (scanned.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "rep")))
            .where(F.col("n") <= k).select("q", "rep"))
    gaps = (ranked.select("curve", "rep", "place").join(F.broadcast(true), "rep")   # at most PROBES x k rows
            .join(places.select("q", "curve", F.col("place").alias("own")), ["q", "curve"])
            .groupBy("q", "rep").agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap")))
    gap = gaps.agg(F.percentile("gap", F.lit(RECALL))).first()[0]
    return int(min((gap or 0) * 1.25 + 1, count))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
