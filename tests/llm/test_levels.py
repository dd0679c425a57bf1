"""The levels of the index family: sorted arrays that are scanned and merged without another shuffle or sort."""

import collections
import re

import numpy as np
import pytest

from citystream.llm import suffixes
from citystream.session import removed_after, shared_dir
from citystream.sources import files


@pytest.fixture
def index(spark):
    n = 3
    with (suffixes._settings(spark, spark__sql__shuffle__partitions=str(n), spark__sql__legacy__bucketedTableScan__outputOrdering="true"),
          removed_after(spark)):
        levels = suffixes.Levels(spark, n)
        yield levels
        levels.close()


def batches(spark, count, seed=4):
    rng = np.random.default_rng(seed)
    rows = [[int(x) for x in rng.integers(-40, 40, 25)] for _ in range(count)]
    return rows, [spark.createDataFrame([(x,) for x in r], "mark long") for r in rows]


def test_marks_that_occur_again_are_those_of_a_plain_count(spark, index):
    rows, frames = batches(spark, 7)
    seen: collections.Counter = collections.Counter()
    for row, frame in zip(rows, frames, strict=True):
        own = collections.Counter(row)
        want = {x for x in own if own[x] > 1 or seen[x]}
        assert {(r.mark, r.n) for r in index.insert(frame).collect()} == {(x, own[x]) for x in want}
        seen += own
    sizes = {size: len(same) for size, same in index.levels.items() if same}
    assert sizes == {0: 1, 1: 1, 2: 1}     # 7 = 4 + 2 + 1


def test_levels_are_scanned_and_merged_without_another_shuffle_or_sort(spark, index):
    _, frames = batches(spark, 3)
    for frame in frames:
        index.insert(frame)
    newest = index.levels[0][-1]
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in index.scans(newest)]
    one, other = index.levels[0][-1], index.levels[1][0]
    plans.append(one.hint("merge").join(other, "mark", "full")._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert "SortMergeJoin" in plan and "Exchange" not in plan and not re.search(r"\bSort \[", plan), plan


def test_a_bucket_is_one_file_in_order(spark, index):
    _, frames = batches(spark, 2)
    for frame in frames:
        index.insert(frame)
    for level in [x for same in index.levels.values() for x in same]:
        for path in level.inputFiles():
            marks = [r.mark for r in spark.read.parquet(path).collect()]
            assert marks == sorted(set(marks))
        assert len(level.inputFiles()) <= index.n


def test_a_run_leaves_three_tables_and_no_names(spark):
    def tables():
        system, where = files._system(spark, shared_dir(spark))
        return {f.getPath().getName() for f in system.listStatus(where)} if system.exists(where) else set()

    before, names = tables(), {t.name for t in spark.catalog.listTables()}
    ordering = spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering")
    text = "".join(map(str, np.random.default_rng(1).integers(0, 10, 900)))
    got = suffixes.without_repeats(spark.createDataFrame([(1, text), (2, text[100:]), (3, None)], "doc_id long, text string"))
    assert [r.n_removed for r in got.orderBy("doc_id").collect()] == [800, 800, 0]
    assert sorted(x.split("-")[0] for x in tables() - before) == ["settled", "strings", "texts"]
    assert {t.name for t in spark.catalog.listTables()} == names
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == ordering


def test_buckets_follow_the_bytes_of_the_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "x" * 1000) for k in range(50)], "doc_id long, text string")
    assert suffixes.buckets(docs) == 4 and suffixes.buckets(docs.limit(0)) == 4
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 5_000)
    assert suffixes.buckets(docs) == 10


def test_a_passage_in_many_texts_is_looked_up_where_its_rows_are(spark, monkeypatch):
    from citystream.llm import hot
    monkeypatch.setattr(hot, "ALWAYS_COLD", 5)
    monkeypatch.setattr(hot, "MOST_HOT", 50)
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    common, rare = word(900), word(700)
    texts = [word(40) + common + word(450) for _ in range(60)] + [word(500) for _ in range(40)] + [rare, word(3) + rare, "a" * 3000, None, ""]
    rows = list(enumerate(texts))
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count = collections.Counter(t[i:i + 400] for _, t in rows if t for i in range(len(t) - 399))
    for r in got:
        text = texts[r.doc_id] or ""
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 399):
            if count[text[i:i + 400]] > 1:
                gone[i:i + 400] = True
        assert (r.n_bytes, r.n_removed) == (len(text), gone.sum())
