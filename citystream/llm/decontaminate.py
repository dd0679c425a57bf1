"""Benchmark passages in documents, with a few words changed, found by CGK embedding and LSH.

Texts are sequences of words (runs of letters and digits, any case). The CGK walk reads a sequence
with random bits: step j copies the word under the pointer and moves on if a random function of
(j, word) says so. Two sequences with a small edit distance give copies with a small Hamming
distance, so a sample of copied positions is often equal for them, and always for equal ones.

Documents are cut into windows that start every ``stride`` words, of each length class that items
need; items into the windows of their class at every word. Each walk gives a window one key of
``SAMPLED`` copied words, and walks are repeated until the target ``recall`` is reached: how many an
item length needs, and windows of what class, is measured on random items with as many words
substituted, inserted or deleted at random places as ``TOLERANCE`` allows; the worst of the three
counts. An unchanged passage is always found. Every hit is then verified: the least word edit distance between the whole item and any run of the document
near the hit must be at most ``TOLERANCE`` of the item's words.

Most windows are never walked. An item of n words with e edits keeps n - 1 - 2 e of its pairs of neighbouring words, for an edit
breaks two at most; a window is walked only if as many pairs of the items stand as near to it as a
hit that is verified can lie. No passage is lost by that: what is skipped could not pass the verification.

Null and empty documents contain nothing; items without words are not looked for. Equal items are
all reported, copies of documents each. Windows for items of fewer words than ``2 * STRIDE`` start
at every word. The benchmark goes through in blocks of ``ITEM_WORDS`` words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.words import Splitter, mix, slices, text_bytes

STRIDE, SAMPLED = 2, 5
RECALL, MOST, TRIALS = 0.99, 16, 400
SLACK = 6   # words: how far a walk may shift a hit beyond its edits
CLASSES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
TOLERANCE = 0.15
ITEM_WORDS = 2_000_000
STEPS = 2 * CLASSES[-1]
PAIRS = 1 << 22     # bits that mark the items' pairs of words; a false mark costs a walk
FOUND = "doc_id long, item_id long, edits int, item_words int, first_word int, last_word int"


def walk_keys(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, repeat: int, classes: list[int]) -> dict[int, np.ndarray]:
    """The LSH key of the window of each class at each start, for one walk; windows end at ``stops``."""
    random = np.random.default_rng([17, repeat])
    sampled = {c: np.sort(random.choice(2 * c, min(SAMPLED, 2 * c), replace=False)) for c in CLASSES}
    sampled = {c: sampled[c] for c in classes}
    keys = {c: np.full(len(starts), c, np.uint64) for c in classes}
    salts = mix(np.arange(1 + repeat * STEPS, 1 + (repeat + 1) * STEPS, dtype=np.uint64))
    at = starts.copy()
    last = max(int(s[-1]) for s in sampled.values()) if sampled else -1
    padded = np.append(words, np.zeros(1, np.uint64))
    bits = np.zeros(0, np.uint64)
    for j in range(last + 1):
        if j % 64 == 0:
            bits = mix(padded ^ salts[j])  # 64 random bits per word, for as many steps
        under = np.minimum(at, len(words))
        for c, steps in sampled.items():
            if j in steps:
                inside = (at < starts + c) & (at < stops)
                keys[c] = mix(keys[c] * np.uint64(3) ^ np.where(inside, padded[under], np.uint64(j)))
        at += ((bits[under] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return keys


def _pairs(words: np.ndarray) -> np.ndarray:
    """The mark of each word and the one behind it."""
    with np.errstate(over="ignore"):
        return (mix(words[:-1] * np.uint64(3) ^ mix(words[1:])) & np.uint64(PAIRS - 1)).astype(np.int64)


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edits between ``item`` and any run of ``text``, and that run's start and end."""
    n = len(text)
    cost, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    place = np.arange(n + 1)
    for i, word in enumerate(item):
        through = cost[:-1] + (text != word)
        over = cost + 1
        best = over.copy()
        source = origin.copy()
        better = through < best[1:]
        best[1:][better] = through[better]
        source[1:][better] = origin[:-1][better]
        best[0], source[0] = i + 1, 0
        # words of the text left out: a running minimum of cost minus place
        low = np.minimum.accumulate(best - place)
        first = np.maximum.accumulate(np.where(best - place == low, place, 0))
        cost, origin = low + place, source[first]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def edited(words: np.ndarray, kind: int, random: np.random.Generator) -> np.ndarray:
    """``words`` with as many random places substituted (0), inserted (1) or deleted (2) as ``TOLERANCE`` allows."""
    n = len(words)
    places = random.choice(n, int(n * TOLERANCE), replace=False)
    new = random.integers(1, 1 << 62, len(places)).astype(np.uint64)
    if kind == 0:
        words = words.copy()
        words[places] = new
        return words
    return np.insert(words, places, new) if kind == 1 else np.delete(words, places)


@lru_cache(maxsize=None)
def walks_needed(n: int, c: int, stride: int, recall: float) -> int | None:
    """Walks after which windows of ``c`` words find items of ``n`` words, or None if ``MOST`` are too few.

    Measured; the share missed must be half of what ``recall`` allows.
    """
    random = np.random.default_rng([23, n, c, stride])
    most = 0
    for kind in range(3):
        items = [random.integers(1, 1 << 62, n).astype(np.uint64) for _ in range(TRIALS)]
        texts = [np.concatenate([random.integers(1, 1 << 62, c + k % stride).astype(np.uint64), edited(w, kind, random),
                                 random.integers(1, 1 << 62, 2 * c).astype(np.uint64)]) for k, w in enumerate(items)]
        ends = np.cumsum([len(w) for w in texts])
        starts = np.concatenate([np.arange(e - len(w), e - c, stride) for w, e in zip(texts, ends, strict=True)])
        trial = np.searchsorted(ends, starts, "right")
        places = (np.arange(n - c + 1) + n * np.arange(TRIALS)[:, None]).ravel()
        texts, items, found, walks = np.concatenate(texts), np.concatenate(items), np.zeros(TRIALS, bool), 0
        while TRIALS - np.count_nonzero(found) > (1 - recall) / 2 * TRIALS:
            if walks == MOST:
                return None
            with np.errstate(over="ignore"):
                sought = walk_keys(items, places, places + c, walks, [c])[c]
                keys = walk_keys(texts, starts, starts + c, walks, [c])[c]
            found[trial[np.isin(keys, sought)]] = True
            walks += 1
        most = max(most, walks)
    return most


def plan(n: int, recall: float) -> tuple[int, int, int]:
    """Words in a window, the stride of documents' windows, and walks for items of ``n`` words.

    More words with equally many edits, and more of both beyond the lengths measured, are found more
    easily; so the shortest item with as many edits stands for all. Single words at every place need no second walk.
    """
    stride = min(STRIDE, max(1, n // 2))
    fits = [c for c in CLASSES if c <= min(n - stride + 1, max(8, n // 8))]
    edits = int(n * TOLERANCE)
    if not edits:
        return fits[-1], stride, 1
    least = next(k for k in range(1, n + 1) if int(k * TOLERANCE) == min(edits, int(CLASSES[-1] * 8 * TOLERANCE)))
    for c in reversed(fits):
        walks = walks_needed(least, c, stride, recall) if c <= least - stride + 1 else None
        if walks:
            return c, stride, walks
    return 1, 1, 1


class Index:
    """Keys of a block of items, and the words to verify against; built once per task. ``plans`` has the plan of each item length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], plans: dict[int, tuple[int, int, int]]) -> None:
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        fits = [plans[len(w)][0] for w in self.words]
        self.classes = sorted(set(fits))
        self.strides = {c: min(s for f, s, _ in plans.values() if f == c) for c in self.classes}
        walks = {c: max(k for f, _, k in plans.values() if f == c) for c in self.classes}
        self.tables: list[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = []
        self.marks = np.zeros(PAIRS, bool)
        for w in self.words:
            self.marks[_pairs(w)] = True
        # per class: pairs that must be near a window, and how near
        self.sieve = {c: (min(len(w) - 1 - 2 * int(len(w) * TOLERANCE) for w in own), max(len(w) + int(len(w) * TOLERANCE) + SLACK for w in own))
                      for c in self.classes for own in [[w for w, f in zip(self.words, fits, strict=True) if f == c]]}
        every = np.concatenate(self.words)
        bounds = np.r_[0, np.cumsum([len(w) for w in self.words])]
        for repeat in range(max(walks.values())):
            tables = {}
            for c in (c for c in self.classes if repeat < walks[c]):
                own = [k for k, f in enumerate(fits) if f == c]
                starts = np.concatenate([np.arange(bounds[k], bounds[k + 1] - c + 1) for k in own])
                item = np.concatenate([np.full(max(0, len(self.words[k]) - c + 1), k) for k in own])
                with np.errstate(over="ignore"):
                    keys = walk_keys(every, starts, bounds[item + 1], repeat, [c])[c]
                order = np.argsort(keys, kind="stable")
                present = np.zeros(1 << 20, bool)
                present[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                tables[c] = keys[order], item[order], (starts - bounds[item])[order], present
            self.tables.append(tables)


def _worth(index: Index, words: np.ndarray, starts: np.ndarray, stride: int) -> np.ndarray:
    """The starts with enough of the items' pairs near them for some class of windows with this stride."""
    marked = np.concatenate([[0], np.cumsum(index.marks[_pairs(words)])])
    worth = np.zeros(len(starts), bool)
    for c in (c for c in index.classes if index.strides[c] == stride):
        least, near = index.sieve[c]
        worth |= marked[np.minimum(starts + near, len(marked) - 1)] - marked[np.maximum(starts - near, 0)] >= least
    return starts[worth]


def _passages(index: Index, splitter: Splitter, texts: pa.Array, one_each: bool = False, sieve: bool = True) -> Iterator[tuple[int, int, int, int, int]]:
    """The verified hits in some texts: row, position of the item, edits, first word and last in the row.

    With ``one_each`` a text is done with once a passage is found in it; without ``sieve`` every window is walked.
    """
    _, _, words, rows = splitter.split(*text_bytes(texts))
    if not len(words):
        return
    doc = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    place = np.arange(len(words)) - rows[doc]
    starts_of = {s: np.flatnonzero(place % s == 0) for s in set(index.strides.values())}
    if sieve:
        starts_of = {s: _worth(index, words, starts, s) for s, starts in starts_of.items()}
    stops_of = {s: rows[doc[starts] + 1] for s, starts in starts_of.items()}
    hits = []
    for repeat, tables in enumerate(index.tables):
        found = {}
        for stride, starts in starts_of.items():
            classes = [c for c in tables if index.strides[c] == stride]
            with np.errstate(over="ignore"):
                found |= walk_keys(words, starts, stops_of[stride], repeat, classes)
        for c, (keys, item, offset, present) in tables.items():
            starts = starts_of[index.strides[c]]
            maybe = np.flatnonzero(present[(found[c] & np.uint64((1 << 20) - 1)).astype(np.int64)])
            low = np.searchsorted(keys, found[c][maybe], "left")
            count = np.searchsorted(keys, found[c][maybe], "right") - low
            which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            hits.append(np.column_stack([item[which], np.repeat(starts[maybe], count) - offset[which]]))
    ended, done = {}, set()
    for item, begin in np.unique(np.concatenate(hits), axis=0).tolist():
        target = index.words[item]
        n, slack = len(target), int(len(target) * TOLERANCE) + SLACK
        for row in {int(doc[min(max(at, 0), len(doc) - 1)]) for at in (begin, begin + n // 2)}:
            if row in done or begin + n // 2 < ended.get((item, row), -1):
                continue  # the latter: inside a passage that is already found
            a, b = max(begin - slack, int(rows[row])), min(begin + n + slack, int(rows[row + 1]))
            if a >= b:
                continue
            if n - np.count_nonzero(np.isin(target, words[a:b])) > int(n * TOLERANCE):
                continue  # every word of the item that is nowhere near costs an edit
            edits, first, last = edit_distance(target, words[a:b])
            if edits <= int(n * TOLERANCE):
                ended[item, row] = a + last
                if one_each:
                    done.add(row)
                yield row, item, edits, a + first - int(rows[row]), a + last - int(rows[row])


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, splitter = Index(*shared.value), Splitter(letters_only=True)
        names = [c.split()[0] for c in FOUND.split(", ")]
        for part in slices(batches, "text"):
            ids = part.column("doc_id")
            out = [(ids[row].as_py(), index.ids[item], edits, len(index.words[item]), first, last)
                   for row, item, edits, first, last in _passages(index, splitter, part.column("text"))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 2 + [pa.int32()] * 4, strict=True)], names=names)
    return run


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, splitter = Index(*shared.value), Splitter(letters_only=True)
        for part in slices(batches, "text"):
            keep = np.ones(part.num_rows, bool)
            for row, *_ in _passages(index, splitter, part.column("text"), one_each=True):
                keep[row] = False
            yield part.filter(pa.array(keep))
    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = Splitter(letters_only=True)
    for part in slices(batches, "text"):
        _, _, words, rows = splitter.split(*text_bytes(part.column("text")))
        yield pa.RecordBatch.from_arrays(
            [part.column("item_id").cast(pa.int64()), pa.array([w.view(np.int64) for w in np.split(words, rows[1:-1])], pa.list_(pa.int64()))],
            names=["item_id", "words"])


def _shared_items(benchmark: DataFrame, item_words: int, recall: float) -> Iterator:
    """The items with words and the plans of their lengths, a broadcast per block of about ``item_words`` words beside its longest item."""
    items = benchmark.select("item_id", "text").mapInArrow(_item_words, "item_id long, words array<long>").where(F.size("words") > 0)
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = total // item_words + 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block).orderBy("item_id").collect()
        if rows:
            yield benchmark.sparkSession.sparkContext.broadcast((
                [(r.item_id, np.array(r.words, np.int64).view(np.uint64)) for r in rows],
                {n: plan(n, recall) for n in {len(r.words) for r in rows}}))


def leaks(docs: DataFrame, benchmark: DataFrame, item_words: int = ITEM_WORDS, recall: float = RECALL) -> DataFrame:
    """A row per benchmark passage in a document: doc_id, item_id, edits, item_words, first_word, last_word.

    Word positions count from 0, the end is exclusive. Each block of items is one pass over the documents.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], FOUND)
    for shared in _shared_items(benchmark, item_words, recall):
        found = found.unionByName(texts.mapInArrow(_search(shared), FOUND))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, item_words: int = ITEM_WORDS, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark passage.

    Decided where the text is: nothing is shuffled, and rows without an id or with a repeated one are
    each judged by their own text.
    """
    for shared in _shared_items(benchmark, item_words, recall):
        docs = docs.mapInArrow(_clean(shared), docs.schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents and the items they hold; clean documents have no row."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.max("item_words").alias("item_words"),
                                                  F.min(F.struct("edits", "first_word", "last_word")).alias("at")).select(
        "doc_id", "item_id", "edits", "item_words", "at.first_word", "at.last_word")
