"""Secrets in texts: fixed shapes, and tokens that a battery of randomness tests tells from prose.

The fixed shapes (``assign``, ``access``, ``hex``) are always reported. The battery looks at every
other run of 20 or more characters of ``[A-Za-z0-9+/_-]``, with ``=`` at its end, that has a digit or both
letter cases (a UUID or a path of words counts as such a run too). ``NAME=value`` is two runs, and of a run
that a fixed shape touches the parts outside it are looked at. The run's encoding is the smallest of digits,
hex, base32, base36, base64 that holds it; three statistics say how far the run is from random
symbols of that encoding:

* chi-squared of symbol frequencies against a uniform alphabet,
* the runs test on symbols above and below the alphabet's middle,
* the serial correlation of neighbouring symbols.

Their sum of squared deviations has a known law for random keys; its upper tail ``p`` is small for
words. All runs of the corpus are counted by encoding, length class and p bin (a table of fixed
size), and per class the share of natural runs among those above each bin is estimated from the
excess below it: random keys spread evenly over p while words crowd at 0. The lowest bin that keeps
that share under ``rate`` is the class's threshold, so a longer run, whose words crowd harder, gets
a lower one. A class in which no bin qualifies reports nothing.

Null and empty texts have no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.words import slices
from citystream.session import cut

# Shapes and least lengths that results are defined by.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]{24,}"  # a maximal run of [0-9a-f] with 24 characters or more
KINDS = ("assign", "access", "hex", "random")

RUN = r"[A-Za-z0-9+/_-]{20,}=*"   # '=' only as padding: what stands before an inner one is a name
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
BINS, RATE = 50, 0.01
LENGTHS = (20, 24, 28, 32, 40, 48, 64, 96, 128)


def _upper_chi2(x: np.ndarray, k: float) -> np.ndarray:
    """Upper tail of chi-squared with k degrees of freedom (Wilson-Hilferty)."""
    z = (np.cbrt(np.maximum(x, 0) / k) - (1 - 2 / (9 * k))) / np.sqrt(2 / (9 * k))
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, tail, 1 - tail)


def battery(run: str) -> tuple[str, float] | None:
    """Encoding of the run and how well it passes as random (0 to 1), or None if it can't be a key."""
    body = run.rstrip("=")
    kinds = (any(c.isdigit() for c in body), any(c.islower() for c in body), any(c.isupper() for c in body))
    if len(body) < LENGTHS[0] or sum(kinds) < 2 and not kinds[0]:
        return None
    if re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", body):
        body = body.replace("-", "")
    symbols = set(body)
    name = next((k for k, a in ALPHABETS.items() if symbols <= set(a)), None)
    if name is None:
        return None
    alphabet, n = ALPHABETS[name], len(body)
    size = 64 if name == "base64" else len(alphabet)
    x = np.array([alphabet.index(c) for c in body])
    counts = np.bincount(x, minlength=size)
    chi2 = float((counts * counts).sum() * size / n - n)
    spread = np.sqrt(2 * (size - 1) * (n - 1) / n)
    z_uniform = (chi2 - (size - 1)) / spread
    high = x >= size / 2
    a = int(high.sum())
    b = n - a
    if a and b:
        expected = 1 + 2 * a * b / n
        variance = max((expected - 1) * (expected - 2) / (n - 1), 1e-9)
        z_runs = (1 + int((high[1:] != high[:-1]).sum()) - expected) / np.sqrt(variance)
    else:
        z_runs = np.sqrt(n)
    d = x - x.mean()
    z_serial = float((d[1:] * d[:-1]).sum() / max((d * d).sum(), 1e-9)) * np.sqrt(n)
    classes = sum(kinds)
    missing = 3 - classes if name == "base64" else 0  # random base64 has all three classes
    total = max(z_uniform, 0) ** 2 + z_runs ** 2 + z_serial ** 2 + 4 * missing
    return name, float(_upper_chi2(np.array([total]), 3.0)[0])


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS)


def spans_of(text: str, patterns: dict[str, re.Pattern]) -> list[tuple[int, int, str]]:
    """The fixed shapes of one text as (start, end, kind), by start, then kind as listed."""
    found = []
    if patterns["hint"].search(text):
        found += [(m.start(), m.end(), "assign") for m in patterns["assign"].finditer(text)
                  if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in patterns["access"].finditer(text)
                  if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in patterns["hex"].finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def compiled() -> dict[str, re.Pattern]:
    return {"assign": re.compile(ASSIGN, re.I | re.A), "access": re.compile(ACCESS), "hex": re.compile(HEX),
            "run": re.compile(RUN),
            "hint": re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)}


SCAN = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, "
        "tests array<struct<start:int,end:int,encoding:string,length:int,bin:int,p:double>>")


def tests_of(text: str, found: list[tuple[int, int, str]], run: re.Pattern) -> Iterator[tuple[int, int, str, int, float]]:
    """The battery's runs, without what ``found`` (sorted) covers: start, end, encoding, length class, p."""
    starts, ends = [], []
    for s, e, _ in found:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for m in run.finditer(text):
        s, e = m.span()
        k = max(bisect_left(starts, s) - 1, 0)  # the last span that starts before the run, then all up to its end
        while s < e:
            stop = min(starts[k], e) if k < len(starts) else e
            if stop - s >= LENGTHS[0]:
                tested = battery(text[s:stop])
                if tested:
                    yield s, stop, tested[0], length_class(stop - s), tested[1]
            s = max(s, ends[k]) if k < len(starts) else e
            k += 1


def bin_of(p: float) -> int:
    return min(int(p * BINS), BINS - 1)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    patterns = compiled()
    tests_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()),
                                     ("length", pa.int32()), ("bin", pa.int32()), ("p", pa.float64())]))
    for batch in slices(batches, "text"):
        columns: list[list] = [[] for _ in range(6)]
        for text in batch.column("text").to_pylist():
            text = text or ""
            found = spans_of(text, patterns)
            base = ",".join(f"{k}:{s}:{e}" for s, e, k in found)
            tests = [{"start": s, "end": e, "encoding": name, "length": length, "bin": bin_of(p), "p": p}
                     for s, e, name, length, p in tests_of(text, found, patterns["run"])]
            for column, value in zip(columns, (
                    sum(k == "assign" for *_, k in found), sum(k == "access" for *_, k in found),
                    sum(k == "hex" for *_, k in found), hashlib.sha256(base.encode()).hexdigest(), base, tests),
                    strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns[:3]),
            pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string()), pa.array(columns[5], tests_type)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "tests"])


def thresholds(tests: DataFrame, rate: float) -> DataFrame:
    """Per encoding and length class the least bin whose runs are natural with a share of ``rate`` at most.

    ``tests`` has a row per tested run (encoding, length, bin). Keys spread evenly over the bins, so
    the emptiest tenth of the upper half estimates keys per bin; what a bin holds beyond is natural.
    The count table has at most encodings x length classes x bins rows.
    """
    counts = tests.groupBy("encoding", "length", "bin").count()
    filled = counts.groupBy("encoding", "length").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("by_bin"))
    upper = F.transform(F.sequence(F.lit(BINS // 2), F.lit(BINS - 1)), lambda b: F.coalesce(F.element_at("by_bin", b), F.lit(0)))
    per_bin = F.aggregate(upper, F.lit(0.0), lambda a, x: a + x) / (BINS - BINS // 2)
    excess = lambda b: F.aggregate(  # noqa: E731  of natural runs in the bins from b on
        F.sequence(b, F.lit(BINS - 1)), F.lit(0.0), lambda a, x: a + F.greatest(
            F.coalesce(F.element_at("by_bin", x), F.lit(0)) - F.col("per_bin") - 3 * F.sqrt("per_bin") - 1, F.lit(0.0)))
    total = lambda b: F.aggregate(
        F.sequence(b, F.lit(BINS - 1)), F.lit(0.0), lambda a, x: a + F.coalesce(F.element_at("by_bin", x), F.lit(0)))
    least = F.filter(F.sequence(F.lit(1), F.lit(BINS - 1)),
                     lambda b: (F.col("per_bin") > 0) & (excess(b) <= rate * total(b)))
    return filled.withColumn("per_bin", per_bin).select(
        "encoding", "length", F.array_min(least).alias("least")).where("least is not null")


def _limits(scanned: DataFrame, rate: float) -> dict[tuple[str, int], int]:
    """The thresholds on the driver: at most one row per encoding and length class, and both lists are fixed."""
    tested = scanned.select(F.explode("tests").alias("t")).select("t.encoding", "t.length", "t.bin")
    return {(r.encoding, r.length): r.least for r in thresholds(tested, rate).collect()}


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans. ``spans`` lists all spans as
    ``kind:start:end``, the battery's as kind ``random``.
    """
    scanned = cut(docs.select("doc_id", "text").mapInArrow(_scan, SCAN))
    limits = [F.lit(x) for (encoding, length), least in _limits(scanned, rate).items() for x in (f"{encoding}:{length}", least)]
    limit_of = lambda key: F.coalesce(F.element_at(F.create_map(*limits), key), F.lit(BINS)) if limits else F.lit(BINS)
    passed = F.filter("tests", lambda t: t.bin >= limit_of(F.concat_ws(":", t.encoding, t.length)))
    random = F.transform(passed, lambda t: F.struct(
        t.start.alias("start"), F.lit(3).alias("kind"), F.concat_ws(":", F.lit("random"), t.start, t.end).alias("span")))
    base = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.struct(
        F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"),
        (F.array_position(F.array(*map(F.lit, KINDS)), F.split_part(s, F.lit(":"), F.lit(1))) - 1).cast("int").alias("kind"),
        s.alias("span")))
    merged = F.transform(F.array_sort(F.concat(base, random)), lambda s: s.span)
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(merged, ",").alias("spans"))


def _replaced(text: str, edges: list[tuple[int, int]], mask: str) -> str:
    out, at = [], 0
    for start, end in sorted(edges):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def _with_texts(batch: pa.RecordBatch, changed: dict[int, str]) -> pa.RecordBatch:
    """The batch with the texts of some rows changed, and their n_chars."""
    if not changed:
        return batch
    columns = list(batch.columns)
    for name, of in (("text", lambda text: text), ("n_chars", len)):
        if name in batch.schema.names:
            at = batch.schema.get_field_index(name)
            values = columns[at].to_pylist()
            for k, text in changed.items():
                values[k] = of(text)
            columns[at] = pa.array(values, batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def without_secrets(docs: DataFrame, rate: float = RATE, mask: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns, with every secret replaced; n_chars, where there is such a column, follows the text.

    Two scans, one for the thresholds and one that masks each row's own text where it is: nothing is
    joined, so rows without an id or with a repeated one are masked like any others. Overlapping spans
    become one mask; only rows with spans are changed.
    """
    limits = _limits(docs.select("doc_id", "text").mapInArrow(_scan, SCAN), rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = compiled()
        for batch in slices(batches, "text"):
            changed = {}
            for k, text in enumerate(batch.column("text").to_pylist()):
                if text:
                    found = spans_of(text, patterns)
                    edges = [(s, e) for s, e, _ in found] + [
                        (s, e) for s, e, name, length, p in tests_of(text, found, patterns["run"])
                        if bin_of(p) >= limits.get((name, length), BINS)]
                    if edges:
                        changed[k] = _replaced(text, edges, mask)
            yield _with_texts(batch, changed)

    return docs.mapInArrow(run, docs.schema)


def masked(docs: DataFrame, found: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """As ``without_secrets``, by a table of spans that is already there (doc_id, spans).

    A doc_id that several rows have must have equal texts; rows without an id stay as they are.
    """
    spans = cut(found.where("spans <> ''").groupBy(F.col("doc_id").alias("_id")).agg(F.first("spans").alias("_spans")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            changed = {k: _replaced(texts[k], [tuple(map(int, s.split(":")[1:])) for s in listed.split(",")], mask)
                       for k, listed in enumerate(batch.column("_spans").to_pylist()) if listed and texts[k]}
            yield _with_texts(batch.drop_columns(["_spans"]), changed)

    joined = docs.join(spans, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return joined.mapInArrow(run, docs.schema)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
