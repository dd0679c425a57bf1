"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's share of all words is raised to an exponent t and normalised: t = 1 keeps the natural mix,
t = 0 gives every source the same. Both the entropy of the weights and the most often a
source is repeated (weight x budget / its words) fall as t rises, so the exponent is found by
bisection: the greatest t in [0, 1] whose entropy reaches ``evenness`` x ln(number of sources), raised as
far as needed that no source is repeated more than ``most_repeats`` times. ``PROBES`` exponents are tried
per pass over the table of sources; only that pass's row of sums reaches the driver.

Each source then gets weight x budget words: every document as many full times as fit, and one
time more for a prefix of the source's blocks in seeded order. Blocks are hashes of doc_id; the
prefix is found from block totals, then inside the one block where it ends, so no window spans a
source. The document that crosses the budget is left out, and so a source stays below its
budget by less than a document. Copies of a block's documents stay together in ``part``, the block's
place in the seeded permutation of all (epoch, block) pairs.

Null sources form one source. Null and empty texts have no words: they come with the first epoch
(cost nothing). Without any words, nothing is repeated and all weights are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from citystream.session import cut

EVENNESS, MOST_REPEATS, SEED = 0.95, 4.0, 7
BLOCKS, PROBES, PASSES = 1024, 15, 10


def word_count(text: str) -> Column:
    """Runs of other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _probe(sources: DataFrame, exponents: list[float], budget: float) -> list[tuple[float, float]]:
    """Entropy and greatest repetition of the weights at each exponent."""
    log = F.ln("share")
    sums = []
    for k, t in enumerate(exponents):
        p = F.exp(log * t)
        sums += [F.sum(p).alias(f"z{k}"), F.sum(p * log * t).alias(f"e{k}"), F.max(p / F.col("words")).alias(f"r{k}")]
    row = sources.agg(*sums).first()
    import math
    return [(math.log(row[f"z{k}"]) - row[f"e{k}"] / row[f"z{k}"], row[f"r{k}"] * budget / row[f"z{k}"])
            for k in range(len(exponents))]


def exponent(sources: DataFrame, count: int, budget: float, evenness: float, most_repeats: float) -> float:
    """The exponent for ``sources`` (share, words), all with words."""
    import math
    goal = evenness * math.log(count)

    def bisect(holds) -> float:
        """The greatest exponent in [0, 1] where the test, true up to some point, still holds (0 if never)."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            step = (high - low) / (PROBES + 1)
            tried = [low + step * k for k in range(1, PROBES + 1)]
            good = [holds(x) for x in _probe(sources, tried, budget)]
            passed = sum(good)
            low, high = low + step * passed, low + step * (passed + 1)
        return high if high == 1.0 else low

    even = bisect(lambda x: x[0] >= goal - 1e-12)
    repeated = bisect(lambda x: x[1] > most_repeats)
    over = _probe(sources, [even], budget)[0][1] > most_repeats
    return min(1.0, repeated + (1.0 / (PROBES + 1)) ** PASSES) if over else even


def weights(docs: DataFrame, budget: float | None = None, evenness: float = EVENNESS,
            most_repeats: float = MOST_REPEATS) -> DataFrame:
    """Per source: source, words, weight, quota (words to draw). ``docs`` needs source and words."""
    sources = cut(docs.groupBy("source").agg(F.sum("words").alias("words")))
    total, count = sources.where("words > 0").agg(F.sum("words"), F.count("*")).first()
    if not total:
        return sources.withColumn("weight", F.lit(0.0)).withColumn("quota", F.lit(0.0))
    budget = float(total if budget is None else budget)
    shared = sources.where("words > 0").withColumn("share", F.col("words") / F.lit(float(total)))
    t = exponent(shared, count, budget, evenness, most_repeats)
    z = shared.agg(F.sum(F.exp(F.ln("share") * t))).first()[0]
    weight = F.when(F.col("words") > 0, F.exp(F.ln(F.col("words") / F.lit(float(total))) * t) / F.lit(z)).otherwise(0.0)
    return sources.withColumn("weight", weight).withColumn("quota", F.col("weight") * F.lit(budget))


def _counted(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    block = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BLOCKS)).cast("int")
    return docs.select("doc_id", "source", word_count("text").alias("words"), block.alias("block"), *more)


def _in_block(seed: int) -> Column:
    """A document's place in the seeded order of its block; only repeated rows tie, and share their fate."""
    return F.struct(F.xxhash64(F.lit(seed + 2), "doc_id").alias("h"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("words").alias("w"))


def _plan(counted: DataFrame, budget: float | None, evenness: float, most_repeats: float, seed: int) -> DataFrame:
    """Per source and block (s, b): weight, full (rounds of all), and up to which place it comes once more.

    ``all`` says that the whole block does; else the documents up to ``last`` do, if there is one.
    """
    plan = weights(counted, budget, evenness, most_repeats)
    plan = cut(plan.withColumn("full", F.when(F.col("words") > 0, F.floor(F.col("quota") / F.col("words"))).otherwise(F.lit(1)).cast("int"))
               .withColumn("rest", F.col("quota") - F.col("full") * F.col("words")))
    place = F.xxhash64(F.lit(seed + 1), F.col("source"), F.col("block"))
    inside = W.partitionBy("source").orderBy("place", "block")     # at most BLOCKS rows a source
    blocks = (counted.groupBy("source", "block").agg(F.sum("words").alias("block_words"))
              .withColumn("place", place).withColumn("upto", F.sum("block_words").over(inside)))
    ready = cut(blocks.join(plan.select(F.col("source").alias("s"), "weight", "full", "rest"), F.col("source").eqNullSafe(F.col("s")), "inner")
                .select("s", F.col("block").alias("b"), "weight", "full", "rest", "upto", (F.col("upto") - F.col("block_words")).alias("before")))
    # one block of a source at most, the one where its quota ends, is cut inside
    ending = ready.where("before < rest and upto > rest").select("s", "b", "before", "rest")
    order = W.partitionBy("s", "b").orderBy("key")
    last = (counted.join(ending, _same()).withColumn("key", _in_block(seed))
            .withColumn("run", F.col("before") + F.sum("words").over(order)).where("run <= rest")
            .groupBy(F.col("s").alias("ls"), F.col("b").alias("lb")).agg(F.max("key").alias("last")))
    return cut(ready.join(last, F.col("s").eqNullSafe(F.col("ls")) & (F.col("b") == F.col("lb")), "left")
               .select("s", "b", "weight", "full", (F.col("upto") <= F.col("rest")).alias("all"), "last"))


def _same() -> Column:
    return F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))


def _copies(counted: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``counted`` with weight, epoch and part, a row per copy."""
    more = (F.col("all") | F.coalesce(_in_block(seed) <= F.col("last"), F.lit(False))).cast("int")
    times = F.when(F.col("words") == 0, 1).otherwise(F.col("full") + more)
    return (counted.join(plan, _same()).withColumn("times", times).where("times > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
            .withColumn("part", F.xxhash64(F.lit(seed + 3), "epoch", "source", "block")))


def mix(docs: DataFrame, budget: float | None = None, evenness: float = EVENNESS, most_repeats: float = MOST_REPEATS,
        seed: int = SEED) -> DataFrame:
    """The drawn documents: doc_id, source, words, weight, epoch (from 0) and part, a row per copy."""
    counted = cut(_counted(docs, seed))
    plan = _plan(counted, budget, evenness, most_repeats, seed)
    return _copies(counted, plan, seed).select("doc_id", "source", "words", "weight", "epoch", "part")


def draw(docs: DataFrame, budget: float | None = None, evenness: float = EVENNESS, most_repeats: float = MOST_REPEATS,
         seed: int = SEED) -> DataFrame:
    """The drawn copies with all columns of ``docs``, and weight, epoch and part.

    Each row meets the plan (a row per source and block) by itself, so texts are not joined by id and
    repeated rows or rows without an id do not multiply. Columns of ``docs`` that are named like one of
    the new ones get ``_before`` added.
    """
    plan = _plan(cut(_counted(docs, seed)), budget, evenness, most_repeats, seed)
    new = ["weight", "epoch", "part"]
    own = [F.col(f"row.`{c}`").alias(f"{c}_before" if c in new else c) for c in docs.columns]
    return _copies(_counted(docs, seed, F.struct("*").alias("row")), plan, seed).select(*own, *new)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every drawn copy of a document at production settings; the budget is the corpus's own size."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "source", "words", "epoch", "part", F.round("weight", 9).alias("weight"))
