"""Windows that are not walked hold nothing; hits against a plain edit-distance search."""

import numpy as np
import pyarrow as pa

from citystream.llm import decontaminate
from citystream.llm.words import Splitter, text_bytes


def corpus(seed=6):
    """Items of many lengths, and texts that hold them with edits, their halves, their shuffled words, or nothing."""
    rng = np.random.default_rng(seed)
    common = [f"c{i}" for i in range(40)]
    words = lambda n: [common[rng.integers(40)] if rng.random() < 0.5 else f"v{rng.integers(500)}" for _ in range(n)]
    items = [words(n) for n in (1, 2, 3, 5, 7, 9, 14, 20, 29, 33, 40, 64, 150, 300)]
    texts = []
    for k in range(220):
        item = list(items[k % len(items)])
        if k % 5 < 3:
            for place in sorted(rng.choice(len(item), int(len(item) * 0.15 * (k % 3) / 2), replace=False), reverse=True):
                kind = rng.integers(3)
                item[place:place + (kind != 1)] = [] if kind == 2 else [f"e{rng.integers(99)}"]
        elif k % 5 == 3:
            item = item[:max(1, len(item) // 2)]
        else:
            rng.shuffle(item)
        texts.append(" ".join([*words(rng.integers(0, 60)), *item, *words(rng.integers(0, 60))]))
    return [" ".join(i) for i in items], [*texts, "", None, "one"]


def test_the_sieve_loses_no_hit_and_hits_are_within_tolerance():
    items, texts = corpus()
    splitter = Splitter(letters_only=True)
    _, _, hashes, rows = splitter.split(*text_bytes(pa.array(items)))
    words = np.split(hashes, rows[1:-1])
    index = decontaminate.Index(list(enumerate(words)), {len(w): decontaminate.plan(len(w), 0.99) for w in words})
    column = pa.array(texts, pa.string())
    found = sorted(decontaminate._passages(index, splitter, column))
    assert found == sorted(decontaminate._passages(index, splitter, column, sieve=False)) and found
    _, _, hashes, rows = splitter.split(*text_bytes(column))
    docs = np.split(hashes, rows[1:-1])
    least = {(r, k): decontaminate.edit_distance(w, d)[0] for r, d in enumerate(docs) for k, w in enumerate(words)}
    within = {p for p, e in least.items() if e <= int(len(words[p[1]]) * decontaminate.TOLERANCE)}
    got = {(r, k) for r, k, *_ in found}
    assert got <= within and len(got) >= 0.98 * len(within)
    assert {p for p in within if least[p] == 0} <= got      # an unchanged passage is always found
