"""Operators without SQL against plain readings over all of a small table."""

import collections
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
import regex

from citystream.llm import labelled, mixing, quality, queries, secrets, words

SF = "/root/testdata/sf0.01"

# The fixed shapes, written down again.
SHAPES = [("assign", regex.compile(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", regex.I | regex.A), 2, 6),
          ("access", regex.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", regex.compile("[0-9a-f]+"), 0, 24)]


def shapes(text):
    found = [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for order, (kind, shape, group, least) in enumerate(SHAPES)
             for m in shape.finditer(text) if len(m.group(group)) >= least]
    return [s for *_, s in sorted(found)]


def test_base_spans_of_all_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_secrets"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = shapes(d.text or ""), got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        count = collections.Counter(s.split(":")[0] for s in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("random:")] == base
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_masks_without_a_count_of_characters(spark):
    docs = spark.createDataFrame([(1, "password = hunter22 and more", "x"), (2, None, "y")], "doc_id long, text string, n string")
    assert sorted(map(tuple, secrets.without_secrets(docs).collect())) == [(1, "[SECRET] and more", "x"), (2, None, "y")]


def test_scores_are_sums_of_table_entries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    rows = docs.select("doc_id", "text").collect()
    splitter = words.Splitter()
    for d in rows:
        x = quality.features(pa.RecordBatch.from_arrays([pa.array([d.text], pa.string())], names=["text"]), splitter)[0]
        place = [sum(1 for edge in edges if edge <= value) for edges, value in zip(model.edges, x, strict=True)]
        total = model.base + sum(float(table[p]) for table, p in zip(model.tables, place, strict=True))
        total += sum(float(table[place[i] * quality.COARSE // quality.BINS][place[j] * quality.COARSE // quality.BINS])
                     for (i, j), table in zip(model.pairs, model.pair_tables, strict=True))
        assert got[d.doc_id] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
    assert len(got) == len(rows)


@pytest.mark.parametrize(("evenness", "most"), [(0.95, 4.0), (0.5, 1.5), (0.99, 100.0)])
def test_weights_follow_a_plain_bisection(spark, evenness, most):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = collections.Counter()
    for r in docs.select("source", "text").collect():
        size[r.source] += len((r.text or "").split())
    total = sum(size.values())

    def at(t):
        powers = {s: (n / total) ** t for s, n in size.items() if n}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    entropy = lambda w: -sum(p * math.log(p) for p in w.values())
    repeats = lambda w: max(p * total / size[s] for s, p in w.items())

    def greatest(holds):
        low, high = 0.0, 1.0
        if holds(high):
            return high
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(mid) else (low, mid)
        return low

    t = greatest(lambda t: entropy(at(t)) >= evenness * math.log(len(size)))
    if repeats(at(t)) > most:
        t = greatest(lambda t: repeats(at(t)) > most)
    want = at(t)
    counted = docs.select("source", mixing.word_count("text").alias("words"))
    got = {r.source: r for r in mixing.weights(counted, None, evenness, most).collect()}
    assert {s: r.words for s, r in got.items()} == dict(size)
    for s, p in want.items():
        assert got[s].weight == pytest.approx(p, abs=1e-6) and got[s].quota == pytest.approx(p * total, rel=1e-6)


def test_every_source_gets_its_quota_but_for_one_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quota = {r.source: r for r in mixing.weights(docs.select("source", mixing.word_count("text").alias("words"))).collect()}
    texts = {r.doc_id: (r.source, len((r.text or "").split())) for r in docs.select("doc_id", "source", "text").collect()}
    times, parts = collections.Counter(), collections.defaultdict(set)
    for r in mixing.mix(docs).collect():
        times[r.doc_id] += 1
        assert (r.source, r.words) == texts[r.doc_id]
        parts[r.part].add((r.source, r.epoch))
    assert all(len(of) == 1 for of in parts.values())       # a block of one epoch is one part
    for source, row in quota.items():
        own = {d: n for d, (s, n) in texts.items() if s == source}
        full = math.floor(row.quota / row.words) if row.words else 1
        assert {times[d] for d, n in own.items() if n} <= {full, full + 1}
        drawn = sum(times[d] * n for d, n in own.items())
        assert row.quota - max(own.values()) <= drawn <= row.quota + 1e-6
        assert all(times[d] == 1 for d, n in own.items() if not n)
    assert np.isclose(sum(r.weight for r in quota.values()), 1)
