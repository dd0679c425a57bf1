"""Near duplicates among thousands of texts that share most of a passage, without being linked by it."""

import random

import numpy as np

from citystream.llm import neardup


def test_a_large_bucket_of_texts_that_are_no_copies(spark):
    """2,000 texts have 0.59 of their runs in common with every other; 40 of them have a copy with two words changed."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(75)]
    texts = {i: shared + [f"t{i}x{k}" for k in range(25)] for i in range(2000)}
    for i in range(40):
        copy = list(texts[i * 50])
        copy[90], copy[99] = "changed", "too"
        texts[2000 + i] = copy
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: (i - 2000) * 50 if i >= 2000 else i for i in texts}


def test_partners_are_those_of_all_comparisons():
    """Block comparisons against one pair at a time: a pair stays if no batch rules it out and no earlier band is its own."""
    import pandas as pd
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 30, neardup.HASHES).astype(np.uint32)
    signs = [np.where(rng.random(neardup.HASHES) < share, base, rng.integers(0, 1 << 30, neardup.HASHES)).astype(np.uint32)
             for share in rng.uniform(0.5, 1, 60)]
    for s in signs:     # all share the second band, some the first one, too
        s[4:8] = base[4:8]
        s[:4] = base[:4] if rng.random() < 0.4 else rng.integers(0, 1 << 30, 4)
    bucket = neardup._keys(signs[0][None])[0][1]
    frame = pd.DataFrame({"bucket": bucket, "rep": np.arange(60), "component": np.arange(60) % 7, "signature": [s.tobytes() for s in signs]})
    least = neardup.least_equal()

    def stays(a, b):
        equal = np.cumsum((signs[a] == signs[b]).reshape(-1, neardup.BATCH).sum(1))
        return bool((equal >= least).all()) and not (signs[a][:4] == signs[b][:4]).all()

    for left, right, same in ((frame, frame, True), (frame[:25], frame[25:], False)):
        got = {(int(left["rep"].iloc[k]), int(right["rep"].iloc[t])) for k, at in neardup._partners(left, right, same, least) for t in at}
        want = {(a, b) for a in left["rep"] for b in right["rep"] if (a < b or not same) and a % 7 != b % 7 and stays(a, b)}
        assert got == want and want
