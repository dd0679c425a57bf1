"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme-value theory.

Tokens (runs of letters and digits, any case) are weighed by how many toxic and clean documents of
the labelled sample hold them: the log-odds ratio under an informative Dirichlet prior, less
``SIGMAS`` standard errors; weights under ``LEAST`` count as 0. Every token costs a small drift, so a clean text scores
below zero on average. One linear scan gives all maximal segments of a text (the disjoint passages
no extension improves). For a text of n tokens a segment of score S is as likely by chance as
``K n exp(-lambda S)`` says, lambda and K from the clean texts; the segments of one text are pooled
by their summed excess, and a logistic curve turns the pooled evidence into a score.

A token's toxic documents count at most once for each different token that stands before it there: copies of one toxic
passage show its words in the same neighbourhood again and again, and would else make all of them look toxic.
Clean documents are counted as they are, so that the limit can only lower a weight.

Null and empty texts, and texts without a weighed token, get the base score. Ties cannot occur:
equal texts get equal scores. Without labels of both kinds every text scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm import labelled
from citystream.llm.words import Splitter, slices, text_bytes
from citystream.session import cut

PER_CLASS = 20_000      # labelled rows to fit on, per label
PRIOR = 0.05            # pseudo-documents of the prior, as a share of the sample
SIGMAS = 1.64
LEAST = 2.0             # natural log of the odds ratio that is sure enough to count
FOLDS, FOLD, CUT = 3, 1, 0.7


@dataclass
class Model:
    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))   # sorted hashes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    drift: float = 0.02
    scale: float = 1.0          # lambda
    factor: float = 0.1         # K
    slope: float = 0.0
    base: float = -50.0


def segments(places: np.ndarray, weights: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text.

    ``places`` are the positions of its weighed tokens; every token costs ``drift``. The usual
    linear scan, which needs to look at weighed tokens alone, as no segment starts or ends elsewhere.
    """
    open_: list[list[float]] = []  # first, last, total before, total after
    total, seen = 0.0, 0
    for place, weight in zip(places.tolist(), weights.tolist(), strict=True):
        total -= drift * (place - seen)
        seen = place + 1
        gain = weight - drift
        if gain <= 0:
            total += gain
            continue
        piece = [place, place, total, total + gain]
        total += gain
        while open_:
            k = len(open_) - 1
            while k >= 0 and open_[k][2] >= piece[2]:
                k -= 1
            if k < 0 or open_[k][3] >= piece[3]:
                break
            piece[0], piece[2] = open_[k][0], open_[k][2]
            del open_[k:]
        open_.append(piece)
    return [(int(a), int(b), right - left) for a, b, left, right in open_]


def evidence(found: list[tuple[int, int, float]], n: int, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Pooled excess of a text's segments over chance, and those that are significant (1 in 100), in text order."""
    excess = [model.scale * s - np.log(max(model.factor * n, 1e-9)) for *_, s in found]
    pooled, best = 0.0, 0.0
    for r, x in enumerate(sorted(excess, reverse=True), 1):
        pooled += x + np.log(r)
        best = max(best, pooled)
    return best, [s for s, x in zip(found, excess, strict=True) if x > np.log(100)]


PASSAGES = "array<struct<first:int,last:int,score:double>>"
MEASURES = f"doc_id long, n_tokens long, best double, pooled double, first int, last int, passages {PASSAGES}"


def _measure(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(letters_only=True)
        for part in slices(batches, "text"):
            _, _, hashes, rows = splitter.split(*text_bytes(part.column("text")))
            k = len(rows) - 1
            best, pooled, count, passages = np.zeros(k), np.zeros(k), np.zeros(k, np.int32), []
            span = np.full((k, 2), -1, np.int32)
            if len(model.tokens) and len(hashes):
                at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
                hit = np.flatnonzero(model.tokens[at] == hashes)
                weights, owner = model.weights[at[hit]], np.searchsorted(rows, hit, "right") - 1
                bounds = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else [0]
                for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                    row = owner[i]
                    found = segments(hit[i:j] - rows[row], weights[i:j], model.drift)
                    if found:
                        top = max(found, key=lambda s: s[2])
                        best[row], span[row] = top[2], top[:2]
                        pooled[row], significant = evidence(found, int(rows[row + 1] - rows[row]), model)
                        count[row] = len(significant)
                        passages += significant
            firsts, lasts, scores = zip(*passages, strict=True) if passages else ((), (), ())
            flat = pa.StructArray.from_arrays([pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(scores, pa.float64())],
                                              names=["first", "last", "score"])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").cast(pa.int64()), pa.array(np.diff(rows)), pa.array(best), pa.array(pooled),
                pa.array(span[:, 0]), pa.array(span[:, 1]), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), flat)],
                names=["doc_id", "n_tokens", "best", "pooled", "first", "last", "passages"])
    return run


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice of texts, in how many toxic and clean ones each token occurs first after which other."""
    splitter = Splitter(letters_only=True)
    for part in slices(batches, "text"):
        _, _, hashes, rows = splitter.split(*text_bytes(part.column("text")))
        labels = part.column("label").to_numpy(zero_copy_only=False)
        before = np.r_[np.zeros(1, np.uint64), hashes[:-1]][:len(hashes)]
        before[rows[:-1][rows[:-1] < len(hashes)]] = 0
        firsts = [a + np.unique(hashes[a:b], return_index=True)[1] for a, b in zip(rows[:-1], rows[1:], strict=True)]
        at = np.concatenate(firsts)
        toxic = np.repeat(labels, [len(f) for f in firsts]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[at].view(np.int64)), pa.array(before[at].view(np.int64)),
                                          pa.array(toxic), pa.array(1 - toxic)], names=["token", "before", "toxic", "clean"])


def _lambda(weights: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(lambda x)] = 1 for a clean text's token scores x."""
    rest = max(1.0 - share.sum(), 0.0)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        value = rest * np.exp(-mid * drift) + (share * np.exp(np.minimum(mid * (weights - drift), 600))).sum()
        low, high = (mid, high) if value < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve in one variable, lightly regularised (Newton's steps)."""
    w = np.zeros(2)
    design = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(w[0]), 0.0), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fits on at most ``per_class`` labelled texts of either label outside the held-out fold.

    The sample is written once, so ``docs`` is read once. The weighed tokens, which all come from its toxic texts, go to every task.
    """
    sample = cut(labelled.sample(docs, labels, "toxic", FOLDS, FOLD, per_class))
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    counts = (sample.mapInArrow(_presence, "token long, before long, toxic long, clean long")
              .groupBy("token", "before").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .groupBy("token").agg(F.least(F.sum("toxic"), F.count_if(F.col("toxic") > 0)).alias("toxic"),
                                    F.sum("clean").alias("clean")))
    alpha = PRIOR * (F.col("toxic") + F.col("clean"))
    odds = lambda k, n: F.log((k + alpha) / (n * (1 + PRIOR) - k + 1))
    error = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("clean") + alpha))
    weight = odds(F.col("toxic"), sizes[1]) - odds(F.col("clean"), sizes[0]) - SIGMAS * error
    rows = counts.select("token", "toxic", "clean", weight.alias("weight")).where(F.col("weight") >= LEAST).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    model = Model(tokens[order], rows["weight"].to_numpy(float)[order])
    clean = sample.where("label = 0").mapInArrow(_measure(model), MEASURES)
    length = clean.agg(F.avg("n_tokens")).first()[0] or 1.0
    share = (rows["clean"].to_numpy(float)[order] + PRIOR) / (sizes[0] * max(length, 1.0))
    model.drift = max(0.02, 2 * float((share * model.weights).sum()))
    model.scale = _lambda(model.weights, share, model.drift) if len(rows) else 1.0
    # Gumbel's mean is (ln(K n) + 0.5772) / lambda
    seen = sample.mapInArrow(_measure(model), MEASURES).join(sample.select("doc_id", "label"), "doc_id").toPandas()
    quiet = seen[seen["label"] == 0]
    gap = model.scale * quiet["best"] - np.log(np.maximum(quiet["n_tokens"], 1))
    model.factor = float(np.clip(np.exp(gap.mean() - 0.5772), 1e-6, 10.0))
    seen = sample.mapInArrow(_measure(model), MEASURES).join(sample.select("doc_id", "label"), "doc_id").toPandas()
    model.slope, model.base = _logistic(np.log1p(seen["pooled"].to_numpy(float)), seen["label"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, score, passages (all significant ones, in text order), n_segments, first and last token of the best."""
    logit = model.base + model.slope * F.log1p("pooled")
    return (docs.select("doc_id", "text").mapInArrow(_measure(model), MEASURES)
            .select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"), "passages",
                    F.size("passages").alias("n_segments"), "first", "last"))


def keep_clean(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under ``cut``; decided where the text is, so nothing is shuffled."""
    measure = _measure(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                for measured in measure(iter([part.select(["doc_id", "text"])])):
                    logit = model.base + model.slope * np.log1p(measured.column("pooled").to_numpy())
                    yield part.filter(pa.array(1 / (1 + np.exp(-logit)) < cut))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", labelled.held_out(FOLDS, FOLD).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "n_segments", "first", "last")
