"""Text quality by a generalised additive model with pairwise interactions.

Features are counts and shares of a whole text, computed on its bytes. Each feature is cut into at
most ``BINS`` bins at quantiles of the fit sample. Boosting goes round the features in turn: each
step fits a tree of a few leaves to the current residuals of one feature and adds a fraction of it
to that feature's lookup table. Afterwards the pairs that explain most of what is left get tables of
their own, boosted in the same way on coarser bins. A score is the sum of table entries.

Null and empty texts have features of 0 and are scored like any other; equal texts score equally.
Without labels of both kinds every text scores 0.
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

PER_CLASS = 20_000
BINS, COARSE, LEAVES, ROUNDS, RATE, PAIRS, PAIR_ROUNDS = 32, 8, 4, 120, 0.15, 6, 40
FOLDS, FOLD, CUT = 5, 0, 0.3

FEATURES = ["chars", "words", "word_length", "long_words", "short_words", "capitals", "digits", "stops",
            "symbols", "bars", "other_marks", "lines", "line_length", "repeated_words", "repeated_lines", "high_bytes",
            "symbol_words", "top_word", "capital_words"]


def features(part: pa.RecordBatch, splitter: Splitter) -> np.ndarray:
    """One row of FEATURES per text."""
    data, offsets = text_bytes(part.column("text"))
    k = len(offsets) - 1
    starts, ends, hashes, rows = splitter.split(data, offsets)

    def per_text(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=sums[1:])
        return np.diff(sums[at]).astype(float)

    code = np.arange(256)
    kinds = {"capital": (code >= 65) & (code <= 90), "digit": (code >= 48) & (code <= 57), "stop": np.isin(code, [33, 46, 63]),
             "symbol": np.isin(code, list(b"#$%&*@^~<>{}[]\\=+")), "bar": code == 124,
             "mark": np.isin(code, list(b"\"'(),-/:;_`")), "line": code == 10, "high": code >= 192,
             "char": (code < 128) | (code >= 192)}
    counts = {name: per_text(table[data], offsets) for name, table in kinds.items()}
    chars, n = np.maximum(counts["char"], 1), np.diff(rows).astype(float)
    words, lines = np.maximum(n, 1), counts["line"] + 1
    lengths = ends - starts
    last = data[ends - 1] if len(ends) else data
    first = data[starts] if len(starts) else data
    repeated, repeated_lines, top = np.zeros(k), np.zeros(k), np.zeros(k)
    for i in range(k):
        own = np.sort(hashes[rows[i]:rows[i + 1]])
        if len(own) > 1:
            change = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            repeated[i] = 1 - (len(change) - 1) / len(own)
            top[i] = np.diff(change).max() / len(own)
        if lines[i] > 1:
            pieces = data[offsets[i]:offsets[i + 1]].tobytes().split(b"\n")
            repeated_lines[i] = 1 - len(set(pieces)) / len(pieces)
    return np.column_stack([
        np.log1p(counts["char"]), np.log1p(n), per_text(lengths, rows) / words, per_text(lengths > 12, rows) / words,
        per_text(lengths <= 3, rows) / words, counts["capital"] / chars, counts["digit"] / chars, counts["stop"] / words,
        counts["symbol"] / words, counts["bar"] / words, counts["mark"] / words, np.log1p(lines), np.log1p(chars / lines),
        repeated, repeated_lines, counts["high"] / chars, per_text(kinds["symbol"][last], rows) / words, top,
        per_text(kinds["capital"][first], rows) / words])


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = -50.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            b = self.bins(x)
            for j, table in enumerate(self.tables):
                total += table[b[:, j]]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[b[:, i] * COARSE // BINS, b[:, j] * COARSE // BINS]
        return total


def _leaves(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins, grown best split first; the Newton step of each bin's leaf."""
    cuts = {0, len(gradient)}
    g, h = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(weight)]
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(*(sorted(cuts)[s] for s in (slice(None, -1), slice(1, None))), strict=True):
            mid = np.arange(a + 1, b)
            if len(mid):
                gain = value(a, mid) + value(mid, b) - value(a, b)
                if gain.max() > best:
                    best, where = gain.max(), int(mid[gain.argmax()])
        if where is None:
            break
        cuts.add(where)
    edges = sorted(cuts)
    return np.concatenate([np.full(b - a, (g[b] - g[a]) / (h[b] - h[a] + 1.0)) for a, b in zip(edges[:-1], edges[1:], strict=True)])


def train(x: np.ndarray, y: np.ndarray) -> Model:
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Model(base=float(np.log(share / (1 - share))))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = model.bins(x)
    model.tables = [np.zeros(BINS) for _ in model.edges]
    total = np.full(len(y), model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            r, w = residual()
            step = RATE * _leaves(np.bincount(bins[:, j], r, BINS), np.bincount(bins[:, j], w, BINS), LEAVES)
            table += step
            total += step[bins[:, j]]
    coarse = bins * COARSE // BINS
    r, w = residual()
    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            cell = coarse[:, i] * COARSE + coarse[:, j]
            g, h = np.bincount(cell, r, COARSE**2), np.bincount(cell, w, COARSE**2)
            gains.append((float((g * g / (h + 1)).sum()), (i, j)))
    model.pairs = [pair for _, pair in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            r, w = residual()
            cell = coarse[:, i] * COARSE + coarse[:, j]
            g = np.bincount(cell, r, COARSE**2).reshape(COARSE, COARSE)
            h = np.bincount(cell, w, COARSE**2).reshape(COARSE, COARSE)
            top = _leaves(g.sum(1), h.sum(1), 2)  # one cut of the first feature, then one of the second in each part
            step = np.empty_like(g)
            for value in np.unique(top):
                part = top == value
                step[part] = RATE * _leaves(g[part].sum(0), h[part].sum(0), 2)
            table += step
            total += step.ravel()[cell]
    return model


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = Splitter()
    for part in slices(batches, "text"):
        x = features(part, splitter)
        yield pa.RecordBatch.from_arrays([part.column("label"), *(pa.array(x[:, j]) for j in range(x.shape[1]))],
                                         names=["label", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fits on at most ``per_class`` labelled texts of either label outside the held-out fold.

    What reaches the driver is one row of numbers per sampled text.
    """
    sample = labelled.sample(docs, labels, "quality", FOLDS, FOLD, per_class)
    rows = sample.mapInArrow(_featurise, "label int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    # the same tables whatever order the rows come in
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    y = rows["label"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model()
    return train(rows[FEATURES].to_numpy(float), y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id and score (0 to 1, higher is better)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for part in slices(batches, "text"):
            p = 1 / (1 + np.exp(-model.logit(features(part, splitter))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(p)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", labelled.held_out(FOLDS, FOLD).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
