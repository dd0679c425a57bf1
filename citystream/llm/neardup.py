"""Near duplicates by MinHash, with sequential Bayesian verification of banded candidates.

A text's set holds its distinct runs of ``SIZE`` words (a shorter text is one run; a text without
words has none and is linked with nothing). Texts are linked when 100 x common >= 75 x united; groups are
the connected components of links.

Texts with equal sets form a class first, so copies cost one row each; all that follows is about
one representative per class (its smallest id). Representatives with an equal band of their
signatures are candidates. Signatures are compared a batch of hashes at a time: after m of n equal,
the posterior of the similarity (uniform prior) says how likely it reaches the threshold, and a pair
goes once that is under ``MISS``. Survivors are confirmed on their full sets.

Candidates come in two rounds, so that a bucket of n texts need not give n x n pairs. First every
member is paired with two hubs of its bucket (the smallest id, and the smallest hash of an id, which
is the same text in many buckets). Where a bucket still spans several components, its members of different
components are compared inside tasks, in two steps: on signatures alone, in blocks of ``WIDE``, which returns no pairs but the
members that have a partner in another component left; only these, few as a rule, get their sets and are compared
again in blocks of ``SIDE``. Only links that join components leave a task, one for a text and a
component, and they are confirmed like the others. The comparisons of a bucket of texts that are alike, but no links, remain the
square of its size; what is shipped for them is a signature per member and block.

Null and empty texts stand alone. Rows without a doc_id cannot be named by a component: they are linked with
nothing, have no component_id and stay. Rows that repeat a doc_id should not occur; they would be one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.graph import components
from citystream.llm.hot import lookup
from citystream.llm.words import Splitter, mix, shingles, slices, text_bytes
from citystream.session import cut

SIZE = 5
HASHES, ROWS = 128, 4       # 32 bands: a pair at 0.75 is missed once in 190,000
SHARE = 75                  # per cent
BATCH, MISS = 16, 1e-6
WIDE, SIDE = 4000, 500      # representatives per block of a bucket, with signatures and with sets

SIGNED = "doc_id long, n_shingles long, hi long, lo long, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = Splitter()
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    factors, shifts = seeds[:HASHES] | np.uint64(1), seeds[HASHES:]
    for part in slices(batches, "text", 1 << 20):
        _, _, hashes, rows = splitter.split(*text_bytes(part.column("text")))
        values, at = shingles(hashes, rows, SIZE)
        counts = np.diff(at)
        k, full = len(counts), np.flatnonzero(counts)
        n, hi, lo = np.zeros(k, np.int64), np.zeros(k, np.uint64), np.zeros(k, np.uint64)
        with np.errstate(over="ignore"):
            for i in full:
                own = np.unique(values[at[i]:at[i + 1]])
                n[i], hi[i], lo[i] = len(own), np.sum(own, dtype=np.uint64), np.bitwise_xor.reduce(mix(own))
            signature = np.zeros((k, HASHES), np.uint32)
            # a very long text goes through in pieces, so the scratch arrays stay small
            for first in range(0, len(values), 1 << 18):
                last = min(first + (1 << 18), len(values))
                i, j = np.searchsorted(at, first, "right") - 1, np.searchsorted(at, last, "left")
                own = np.arange(i, j)[counts[i:j] > 0]
                starts = np.maximum(at[own], first) - first
                piece = values[first:last]
                for h in range(HASHES):
                    low = np.minimum.reduceat(((piece * factors[h] + shifts[h]) >> np.uint64(32)).astype(np.uint32), starts)
                    fresh = at[own] >= first
                    signature[own, h] = np.where(fresh, low, np.minimum(signature[own, h], low))
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
            pa.array([s.tobytes() for s in signature], pa.binary())], names=["doc_id", "n_shingles", "hi", "lo", "signature"])


def _keys(signatures: np.ndarray) -> np.ndarray:
    """The bucket of every band of every signature."""
    bands = signatures.reshape(len(signatures), HASHES // ROWS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, HASHES // ROWS + 1, dtype=np.uint64)), bands.shape[:2])
        for r in range(ROWS):
            key = mix(key ^ (bands[:, :, r] + np.uint64(r << 40)))
    return key.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        key = _keys(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES))
        yield pa.RecordBatch.from_arrays([
            pa.array(key.ravel()), pa.array(np.repeat(batch.column("rep").to_numpy(), HASHES // ROWS))], names=["bucket", "rep"])


def least_equal(share: float = SHARE / 100, miss: float = MISS) -> np.ndarray:
    """For n = BATCH, 2 BATCH, ... hashes, how many must be equal for the posterior to allow ``share``."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(log - log.max())
            if density[grid >= share].sum() / density.sum() >= miss:
                break
        out.append(m)
    return np.array(out)


def _survive(x: np.ndarray, y: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Positions of the pairs of signatures that no batch rules out."""
    left = np.arange(len(x))
    equal = np.zeros(len(x), np.int64)
    for step, bound in enumerate(least):
        at = slice(step * BATCH, (step + 1) * BATCH)
        equal[left] += (x[left, at] == y[left, at]).sum(1)
        left = left[equal[left] >= bound]
    return left


def _prune(least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
            keep = pa.array(_survive(x, y, least))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("a", "b")], names=["a", "b"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's set as sorted hashes."""
    splitter = Splitter()
    for part in slices(batches, "text"):
        _, _, hashes, rows = splitter.split(*text_bytes(part.column("text")))
        values, at = shingles(hashes, rows, SIZE)
        own = [np.unique(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own, pa.binary())], names=["rep", "hashes"])


def _halves(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The two blocks of a group, and whether they are one."""
    i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    return frame[frame["block"] == i], frame[frame["block"] == j], i == j


def _signatures(block: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(block["signature"]), np.uint32).reshape(-1, HASHES)


def _partners(left: pd.DataFrame, right: pd.DataFrame, same: bool, least: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions on the right, in other components, that no batch of hashes rules out, for each position on the left that has some.

    A pair with several bands in common is a pair of the bucket of the first.
    """
    x, y = _signatures(left), np.ascontiguousarray(_signatures(right).T)
    band = int(np.argmax(_keys(x[:1])[0] == left["bucket"].iloc[0])) if len(x) else 0
    own, theirs, rep, other = (d[c].to_numpy() for c in ("component", "rep") for d in (left, right))
    for k in range(len(x)):
        equal = np.count_nonzero(y[:BATCH] == x[k, :BATCH, None], axis=0)
        at = np.flatnonzero((equal >= least[0]) & (theirs != own[k]) & ((other > rep[k]) if same else True))
        equal = equal[at]
        for step in range(1, len(least)):
            if not len(at):
                break
            part = slice(step * BATCH, (step + 1) * BATCH)
            equal += np.count_nonzero(y[part, at] == x[k, part, None], axis=0)
            keep = equal >= least[step]
            at, equal = at[keep], equal[keep]
        if len(at):
            same_band = (y[:, at] == x[k, :, None]).reshape(HASHES // ROWS, ROWS, -1).all(1)
            at = at[same_band.argmax(0) == band]
        if len(at):
            yield k, at


def _near(frame: pd.DataFrame, least: np.ndarray) -> pd.DataFrame:
    """The members of two blocks of a bucket (or of one) with a partner left in another component."""
    left, right, same = _halves(frame)
    found: set[int] = set()
    for k, at in _partners(left, right, same, least):
        found.add(int(left["rep"].iloc[k]))
        found.update(right["rep"].to_numpy()[at].tolist())
    return pd.DataFrame({"bucket": np.full(len(found), frame["bucket"].iloc[0], np.int64), "rep": np.array(sorted(found), np.int64)})


def _blocks(frame: pd.DataFrame, least: np.ndarray) -> pd.DataFrame:
    """Links between two blocks of a bucket (or within one) that join different components, one for a text and a component."""
    left, right, same = _halves(frame)
    mine = [np.frombuffer(h, np.uint64) for h in left["hashes"]]
    sizes = right["hashes"].str.len().to_numpy() // 8
    universe, place = np.unique(np.frombuffer(b"".join(right["hashes"]), np.uint64), return_inverse=True)
    bounds = np.r_[0, np.cumsum(sizes)]
    rep, other, theirs = left["rep"].to_numpy(), right["rep"].to_numpy(), right["component"].to_numpy()
    out = []
    for k, at in _partners(left, right, same, least):
        present = np.zeros(len(universe), bool)
        where = np.minimum(np.searchsorted(universe, mine[k]), len(universe) - 1)
        present[where[universe[where] == mine[k]]] = True
        done = set()
        for t in at:
            if theirs[t] in done:
                continue
            common = present[place[bounds[t]:bounds[t + 1]]].sum()
            if 100 * common >= SHARE * (len(mine[k]) + sizes[t] - common):
                done.add(theirs[t])
                out.append((rep[k], other[t]))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": pairs.min(1, initial=2**62), "b": pairs.max(1, initial=-1)})


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose full sets are alike enough."""
    splitter = Splitter()

    def sets(column: pa.Array) -> list[np.ndarray]:
        _, _, hashes, rows = splitter.split(*text_bytes(column))
        values, at = shingles(hashes, rows, SIZE)
        return [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    for part in slices(batches, "ta"):
        keep = []
        for k, (x, y) in enumerate(zip(sets(part.column("ta")), sets(part.column("tb")), strict=True)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            if len(x) and 100 * common >= SHARE * (len(x) + len(y) - common):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])


def _named(df: DataFrame, key: str, value: str, to: tuple[str, str]) -> DataFrame:
    return df.select(F.col(key).alias(to[0]), F.col(value).alias(to[1]))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of (a, b), the pairs linked by their full sets."""
    return cut(pairs.join(_named(texts, "doc_id", "text", ("a", "ta")), "a")
               .join(_named(texts, "doc_id", "text", ("b", "tb")), "b").mapInArrow(_confirm, "a long, b long"))


def _grouped(placed: DataFrame, side: int) -> DataFrame:
    """The members of buckets with several components, once for each pair of blocks (i, j) that theirs is one of."""
    mixed = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
             .where("low <> high").select("bucket", F.ceil(F.col("n") / side).cast("int").alias("blocks")))
    return (placed.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("bucket", "rep", "component", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_shingles, component_id, kept."""
    texts, least = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least_equal()
    signed = cut(texts.mapInArrow(_sign, SIGNED))
    shape = ["hi", "lo", "n_shingles"]
    classes = (signed.where("n_shingles > 0 and doc_id is not null").groupBy(*shape)
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")))
    copies = lookup(signed.select("doc_id", *shape), classes.where("size > 1"), shape, "size", signed.count(), "left")
    members = cut(copies.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")))
    reps = cut(signed.where("n_shingles > 0").select(F.col("doc_id").alias("rep"), "signature")
               .join(members.where("rep = doc_id").select("rep"), "rep", "left_semi"))
    bands = reps.mapInArrow(_bands, "bucket long, rep long")
    hubs = (bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("low"),
                                        F.min(F.struct(F.xxhash64("rep"), "rep")).alias("drawn"))
            .where("n > 1").select("bucket", "low", F.col("drawn.rep").alias("drawn")))
    busy = cut(bands.join(hubs, "bucket"))
    # the only texts that move are those of representatives that share a bucket
    texts = cut(texts.join(busy.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    star = cut(busy.select(F.explode(F.array("low", "drawn")).alias("hub"), "rep").where("hub <> rep")
               .select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct())
    alike = cut(star.join(_named(reps, "rep", "signature", ("a", "sa")), "a")
                .join(_named(reps, "rep", "signature", ("b", "sb")), "b").mapInArrow(_prune(least), "a long, b long"))
    links = _verified(alike, texts)
    grouped = components(links)

    placed = (busy.select("bucket", "rep").join(_named(grouped, "node", "component", ("rep", "component")), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    wide = _grouped(cut(placed), WIDE)
    near = cut(wide.join(reps, "rep").groupBy("bucket", "i", "j").applyInPandas(lambda frame: _near(frame, least), "bucket long, rep long")
               .distinct())
    if not near.isEmpty():
        sets = texts.join(near.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(
            _sets, "rep long, hashes binary")
        fine = _grouped(cut(placed.join(near, ["bucket", "rep"], "left_semi")), SIDE).join(reps.join(sets, "rep"), "rep")
        rest = fine.groupBy("bucket", "i", "j").applyInPandas(lambda frame: _blocks(frame, least), "a long, b long").distinct()
        links = links.union(_verified(cut(rest), texts))
        grouped = components(links)
    return (members.join(_named(grouped, "node", "component", ("rep", "component")), "rep", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
runs as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as run
  from (select *, unnest(range(1, case when len(w) >= 5 then len(w) - 3 when len(w) > 0 then 2 else 1 end)) as i from words)),
sizes as (select doc_id, count(*) as n from runs group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from runs a join runs b on a.run = b.run and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on l.a = r.b),
lowest as (select a as doc_id, min(b) as low from reach group by a)
select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) as component_id,
       w.doc_id = least(w.doc_id, coalesce(low, w.doc_id)) as kept
from words w left join sizes using (doc_id) left join lowest using (doc_id)"""
