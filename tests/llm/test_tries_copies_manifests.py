"""The conversation trie, exact duplicates and the Merkle manifest against SQL, brute force and awkward input."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from citystream.llm import exactdup, hot, merkle, queries, trie

SF = "/root/testdata/sf0.01"
NODE = [n for n, _ in trie.NODE]


def rows_of(df, names=None):
    return sorted((tuple(r[c] for c in names or df.columns) for r in df.collect()), key=str)


@pytest.mark.parametrize(("name", "table"), [("op7_near_duplicates", "documents"), ("op11_prefix_trie", "conversations"), ("op12_exact_duplicates", "documents"), ("op13_manifest", "documents")])
def test_query_equals_its_sql(spark, name, table):
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    found = con.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert rows_of(queries.QUERIES[name](spark, SF), names) == sorted(found.fetchall(), key=str)


def nodes_of(own):
    """Every node of the trie of {conv_id: turns}, by listing every prefix of every conversation."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, path in own.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def conversations(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("shards", "deepest"), [(1, 128), (4, 128), (40, 128), (40, 2), (40, 0)])
def test_trie_whatever_the_shards(spark, shards, deepest):
    """A third of all conversations is the same one, many share their first turns, and splitters may be cut short."""
    rng = random.Random(5)
    paths = [[("user", rng.choice("ab")), *[(rng.choice(["user", "bot"]), rng.choice(["x", "é", "zz"])) for _ in range(rng.randrange(6))]] for _ in range(200)]
    paths += [[("user", "same"), ("bot", "said"), ("user", "again")]] * 100
    own = {c - 20: p for c, p in enumerate(rng.sample(paths, len(paths)))}
    rows = [(c, k, role, text) for c, p in own.items() for k, (role, text) in enumerate(p)]
    spark.conf.set("spark.sql.shuffle.partitions", str(max(4, shards)))
    try:
        got = trie.trie(trie.paths(spark.createDataFrame(rows, TURNS)), most_shards=shards, deepest=deepest)
        assert rows_of(got, NODE) == nodes_of(own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_lists_of_ids_come_in_pieces(spark, monkeypatch):
    own = {c: [("user", "hi")] for c in range(500)}
    one = spark.createDataFrame([(c, 0, "user", "hi") for c in own], TURNS)
    monkeypatch.setattr(trie, "PIECE", 64)
    assert rows_of(trie.trie(trie.paths(one)), NODE) == nodes_of(own)


def test_rebuilt_conversations_of_awkward_turns(spark):
    """Null turns come first, null texts are empty, negative ids, no first conversation of a group, none with a turn left, repeated rows."""
    rows = [(5, 1, "user", "a"), (5, None, "user", "first"), (5, 0, None, None), (6, 0, "user", "b"), (6, 1, "bot", "c"), (6, 1, "bot", "c"),
            (13, 0, "user", "d"), (-7, 0, "user", "e"), (-5, 0, "user", "f"), (-5, 1, "bot", ""), (None, 0, "user", "lost"),
            *[(11 + 5 * k, t, "user", f"t{t}") for k in range(6) for t in range(3)], (20, 2, "user", "x" * 100_000), (20, 2, "user", "x" * 100_000)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], TURNS + ", path string")
    assert rows_of(trie.trie(trie.rebuilt(trie.paths(turns))), NODE) == nodes_of(rebuilt(conversations(rows)))
    assert trie.trie(trie.rebuilt(trie.paths(turns.limit(0)))).count() == 0


def judged(rows):
    """(doc_id, keep_id, group_size, kept) of (doc_id, text) rows."""
    groups = collections.defaultdict(list)
    for d, t in rows:
        t = t or ""
        groups["".join(x for x in t if x not in " \t\n\x0b\x0c\r")].append((-len(t), d is None, d or 0))
    out = []
    for members in groups.values():
        for k, (_, none, d) in enumerate(sorted(members)):
            best = min(members)
            out.append((None if none else d, None if best[1] else best[2], len(members), k == 0))
    return sorted(out, key=str)


def test_copies_of_awkward_rows(spark, awkward, empty):
    names = ["doc_id", "keep_id", "group_size", "kept"]
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(exactdup.duplicates(awkward), names) == judged(rows)
    kept = exactdup.without_copies(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r[3] for r in judged(rows))
    assert exactdup.duplicates(empty).count() == 0 and exactdup.without_copies(empty).count() == 0
    clash = awkward.withColumnsRenamed({"rep": "sha", "lang": "possible", "source": "row"})
    assert exactdup.without_copies(clash).columns == clash.columns and exactdup.without_copies(clash).count() == kept.count()


def test_copies_with_several_slices_and_hot_groups(spark, monkeypatch):
    """The filter is divided into slices, and a third of all rows is one text; other code points, tabs and ids decide who stays."""
    rng = random.Random(1)
    rows = [(i, "hot text" + " " * rng.randrange(4)) for i in range(4000)] + [(i, f"text {rng.randrange(6000)}" + "\t" * (i % 3)) for i in range(4000, 12_000)]
    docs = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string")
    assert exactdup.sizes(len(rows), 1 << 16)[0] == 3
    names = ["doc_id", "keep_id", "group_size", "kept"]
    want = judged(rows)
    for bits in (1 << 16, exactdup.MOST_BITS):
        assert rows_of(exactdup.duplicates(docs, bits), names) == want
        assert sorted(r.doc_id for r in exactdup.without_copies(docs, bits).collect()) == sorted(r[0] for r in want if r[3])


def test_unique_rows_are_not_shuffled(spark):
    """The plan of the last step: rows that are surely unique meet broadcast pages only."""
    digests = exactdup._digests(spark.read.parquet(f"{SF}/documents.parquet"))
    _, plane = exactdup.sizes(digests.count())
    tested = exactdup._tested(digests, exactdup.cut(exactdup._seen_twice(digests, plane)), plane)
    plan = tested.where(~F.col("possible"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan
    groups = exactdup.duplicates(spark.read.parquet(f"{SF}/documents.parquet"))
    unique = groups.where("group_size = 1").count()
    false_alarms = tested.where("possible").count() - groups.where("group_size > 1").count()
    assert 0 <= false_alarms < 0.05 * unique


def proofs_of(rows):
    """The manifest of (doc_id, text, lang, source, n_chars) rows, one node after another."""
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(d, text, lang, source, n):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(up, i):
        out = []
        for level in up[:-1]:
            out.append((i & 1, level[i ^ 1] if i ^ 1 < len(level) else None))
            i >>= 1
        return out

    trees = collections.defaultdict(list)
    for r in rows:
        trees[(r[2] is not None, (r[2] or "").encode())].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    keys = sorted(trees)
    up = {k: levels([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]) for k in keys}
    top = levels([up[k][-1][0] for k in keys])
    out = []
    for j, k in enumerate(keys):
        for i, (_, _, own, r) in enumerate(sorted(trees[k], key=lambda x: x[:3])):
            way = path(up[k], i) + path(top, j)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(*r[:4], r[4] + 1) if bad else own
            for odd, other in way:
                node = h(node) if other is None else h(other, node) if odd else h(node, other)
            out.append((r[0], own, up[k][-1][0], top[-1][0], h(*[o for _, o in way if o is not None]), node, node == top[-1][0]))
    return sorted(out, key=str)


def proven(docs):
    return rows_of(merkle.Manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0).proofs())


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_manifest_of_awkward_rows(spark, awkward, empty):
    rows = [tuple(r)[:5] for r in awkward.collect()]
    assert proven(awkward) == proofs_of(rows)
    assert proven(empty) == [] and merkle.Manifest(empty).root is None
    for few in (rows[:1], rows[:2], rows[:3]):
        assert proven(spark.createDataFrame(few, DOCS)) == proofs_of(few)


def test_manifest_of_many_languages_repeated_ids_and_wide_trees(spark, monkeypatch):
    """Arrays of four slots, so that trees take several steps; one id with a third of all rows; ids far apart and negative."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "SLOTS", 4)
    rng = random.Random(3)
    rows = [(77, f"t{rng.randrange(50)}", "en", None, 5) for _ in range(100)]
    rows += [(rng.randrange(-200, 200), "x", rng.choice(["en", "de", "é", "", None]), "s", rng.choice([None, 3])) for _ in range(150)]
    rows += [(rng.randrange(-2**63, 2**63), "y", "en", "s", i) for i in range(40)] + [(None, "z", "de", "s", i % 3) for i in range(9)]
    rows += [(i, "w", f"l{i}", "s", i) for i in range(70)]
    docs = spark.createDataFrame(rng.sample(rows, len(rows)), DOCS)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert proven(docs) == proofs_of(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_sums_across_ranges(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(30)}", i, rng.randrange(5)) for i in range(3000)]
    got = hot.running_sum(spark.createDataFrame(rng.sample(rows, len(rows)), "g string, i long, v long"), ["g"], ["i"], "v", "before").collect()
    want = {}
    for _, own in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        total = 0
        for r in own:
            want[r[:2]] = total
            total += r[2]
    assert {(r.g, r.i): r.before for r in got} == want
