"""A Merkle manifest of a table, whose leaves find their places by rank in bitmaps of their ids.

A row is a leaf: H (SHA-256, lowercase hex; digests enter as hex text) of doc_id, source, lang, n_chars and text, each
``-`` if null, else its UTF-8 byte count, ``:`` and its value. Leaves of a language ascend by doc_id; every two
consecutive nodes, or the last one alone, become their H until one is left, the subroot. Subroots in order of
language (null first, bytewise) are reduced in the same way to the root.

Leaves are not sorted. The ids of a language form a bitmap, compressed to its words of 64 ids that are not empty: each task
makes the words of its rows, equal words are merged by OR. A directory holds the rows before every word, so a leaf's
coordinate is that number and the count of lower bits of its word. The coordinate names a slot of an array of
``SLOTS``; an array is reduced by up to ten levels in one step, its result is a slot one step up, and three steps serve 10^9
leaves. Top down, every array learns the siblings above it, and the rows of the arrays at the bottom leave with whole proofs.

Ids that occur more than once, and null ids (which come first), have more rows than bits in their word. Only the rows of
such words are numbered by sorting: by doc_id, then by leaf; rows with one leaf are interchangeable. Extra columns are
ignored. An empty table has no rows, no subroot and no root. Empty texts are values of no bytes, unlike null.

All large steps are joins and groups on keys that hold at most ``SLOTS`` rows or the rows of 64 ids; what spreads
a hot language is the key itself, and per-language numbers come by ``hot.lookup`` and ``hot.running_sum``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.duck import crc32
from citystream.llm.hot import lookup, running_sum
from citystream.session import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10
SLOTS = 1 << LEVELS
ALONE, BEFORE, AFTER = b"0", b"1", b"2"     # a path's entry: no sibling, one on the left, one on the right
ENTRY = 33

NODES = "tree binary, total long, place long, node binary"
ABOVE = "tree binary, place long, above binary, subroot binary"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(n_chars: Column) -> Column:
    """A row's leaf, 32 bytes, with ``n_chars`` in the place of its column."""
    return F.unhex(F.sha2(F.concat(*[_field(n_chars if c == "n_chars" else F.col(c)) for c in FIELDS]), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """tree (the language, not null, in the order of languages), doc_id, word, bit, leaf, bent (the leaf if tampered, else null), row_no."""
    longer = F.try_add(F.col("n_chars"), F.lit(1))
    return cut(docs.select(
        F.when(F.col("lang").isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), F.col("lang").cast("binary"))).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.shiftright("doc_id", 6), F.lit(-(1 << 60))).cast("long").alias("word"),
        F.expr("cast(pmod(doc_id, 64) as int)").alias("bit"),
        leaf(F.col("n_chars")).alias("leaf"), F.when(tampered & F.col("n_chars").isNotNull(), leaf(longer)).alias("bent"),
        F.monotonically_increasing_id().alias("row_no")))


def directory(rows: DataFrame) -> DataFrame:
    """Per word of a language's bitmap: bits, n (rows), base (rows in words before), total (rows of the language)."""
    words = rows.groupBy("tree", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("n"))
    words = cut(running_sum(words, ["tree"], ["word"], "n", "base"))
    trees = cut(words.groupBy("tree").agg(F.sum("n").alias("total"), F.count("*").alias("n_words")))
    return cut(lookup(words, trees, ["tree"], "n_words", words.count()).drop("n_words"))


def ranked(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with place (from 0, in order of doc_id in the language) and total."""
    ragged = F.col("bits").isNull() | (F.col("n") > F.bit_count("bits"))
    met = rows.join(words.hint("shuffle_hash"), ["tree", "word"])
    plain = met.where(~ragged).withColumn("place", F.col("base") + F.expr("bit_count(bits & ~shiftleft(-1L, bit))"))
    awkward = running_sum(met.where(ragged).withColumn("one", F.lit(1)), ["tree", "word"], ["doc_id", "leaf", "row_no"], "one", "place")
    awkward = awkward.withColumn("place", F.col("base") + F.col("place"))
    out = ["tree", "total", "place", "doc_id", "leaf", "bent"]
    return plain.select(*out).unionByName(awkward.select(*out))


def _arrays(nodes: DataFrame, *values: str) -> DataFrame:
    """Slot arrays, one row each: tree, total, place (of the array) and slots, SLOTS at most."""
    slot = F.struct(F.pmod("place", F.lit(SLOTS)).cast("int").alias("slot"), *values)
    return cut(nodes.withColumn("array", F.shiftright("place", LEVELS)).groupBy("tree", "total", "array")
               .agg(F.collect_list(slot).alias("slots")).withColumnRenamed("array", "place"))


def _h(*parts: bytes) -> bytes:
    return sha256(b"".join([p.hex().encode() for p in parts])).digest()


def _levels(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The nodes of an array, and each level made of them, the top last; ``total`` is the tree's width at the bottom."""
    out = [nodes]
    for _ in range(min(LEVELS, (total - 1).bit_length())):
        below = out[-1]
        out.append([_h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def _path(levels: list[list[bytes]], slot: int) -> bytes:
    """The entries from a slot to its array's top."""
    out = []
    for level in levels[:-1]:
        other = slot ^ 1
        out.append(ALONE + bytes(32) if other >= len(level) else (BEFORE if slot & 1 else AFTER) + level[other])
        slot >>= 1
    return b"".join(out)


def _fold(node: bytes, path: bytes) -> bytes:
    for at in range(0, len(path), ENTRY):
        side, other = path[at:at + 1], path[at + 1:at + ENTRY]
        node = _h(node) if side == ALONE else _h(other, node) if side == BEFORE else _h(node, other)
    return node


def _siblings(path: bytes) -> bytes:
    return b"".join(path[at + 1:at + ENTRY].hex().encode() for at in range(0, len(path), ENTRY) if path[at:at + 1] != ALONE)


def _filled(slots: list[dict], value: str) -> list[bytes]:
    out = [b""] * len(slots)
    for s in slots:
        out[s["slot"]] = s[value]
    return out


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _reduce(value: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            top = _levels(_filled(row["slots"], value), row["total"])[-1][0]
            yield pa.RecordBatch.from_pylist([{"tree": row["tree"], "total": -(-row["total"] // SLOTS), "place": row["place"], "node": top}],
                                             pa.schema([("tree", pa.binary()), ("total", pa.int64()), ("place", pa.int64()), ("node", pa.binary())]))
    return run


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands above each slot of an array, from what stands above the array."""
    for row in _one_by_one(batches):
        levels = _levels(_filled(row["slots"], "node"), row["total"])
        n = len(levels[0])
        first = row["place"] * SLOTS
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["tree"]] * n, pa.binary()), pa.array(range(first, first + n), pa.int64()),
             pa.array([_path(levels, i) + row["above"] for i in range(n)], pa.binary()), pa.array([row["subroot"]] * n, pa.binary())],
            names=["tree", "place", "above", "subroot"])


def _prove(root: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            levels = _levels(_filled(row["slots"], "leaf"), row["total"])
            above, upper = row["above"], _siblings(row["above"])
            out, tops = [], {}
            for s in row["slots"]:
                path = _path(levels, s["slot"])
                top = _fold(s["bent"] or s["leaf"], path)
                if top not in tops:
                    tops[top] = _fold(top, above)
                out.append((s["doc_id"], s["leaf"].hex(), row["subroot"].hex(), root.hex(), sha256(_siblings(path) + upper).hexdigest(),
                            tops[top].hex(), tops[top] == root))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), *[pa.string()] * 5, pa.bool_()], strict=True)],
                names=[c.split()[0] for c in PROOFS.split(", ")])
    return run


def _trees(arrays: DataFrame, value: str) -> tuple[DataFrame, list[DataFrame]]:
    """Each tree's last node (tree, total, place, node), and the slot arrays of every step from the second on."""
    nodes, steps, done = cut(arrays.mapInArrow(_reduce(value), NODES)), [], None
    while True:
        whole = nodes.where("total = 1")
        done = whole if done is None else done.unionByName(whole)
        left = nodes.where("total > 1")
        if left.isEmpty():
            return done, steps
        steps.append(_arrays(left, "node"))
        nodes = cut(steps[-1].mapInArrow(_reduce("node"), NODES))


def _down(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """What stands above every array of the first step, from what stands above each tree's last node (``ABOVE``)."""
    for arrays in reversed(steps):
        # a tree that ends below this step keeps its row, which waits for the step its last node comes from
        inner = arrays.join(above, ["tree", "place"]).mapInArrow(_expand, ABOVE)
        above = cut(inner.unionByName(above.join(arrays.select("tree").distinct(), "tree", "left_anti")))
    return above


class Manifest:
    """The reduced trees of a table: ``subroots`` (tree, place, node), ``root`` (bytes; None for an empty table), and proofs."""

    def __init__(self, docs: DataFrame, tampered: Column | None = None) -> None:
        rows = leaves(docs, F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False)))
        self.arrays = _arrays(ranked(rows, directory(rows)), "doc_id", "leaf", "bent")
        self.subroots, self.steps = _trees(self.arrays, "leaf")
        langs = running_sum(self.subroots.select(F.lit(b"").alias("all"), "tree", "node").withColumn("one", F.lit(1)),
                            ["all"], ["tree"], "one", "place")
        self.langs = cut(langs)
        top = self.langs.select(F.col("all").alias("tree"), F.lit(self.langs.count()).cast("long").alias("total"), "place", "node")
        self.lang_arrays = _arrays(top, "node")
        roots, self.lang_steps = _trees(self.lang_arrays, "node")
        first = roots.select("node").first()
        self.root = bytes(first.node) if first else None

    def proofs(self) -> DataFrame:
        """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf where there is one), verified."""
        if self.root is None:
            return self.arrays.sparkSession.createDataFrame([], PROOFS)
        nothing = self.lang_arrays.select("tree").distinct().select(
            "tree", F.lit(0).cast("long").alias("place"), F.lit(b"").alias("above"), F.lit(b"").alias("subroot"))
        langs = _down([self.lang_arrays, *self.lang_steps], nothing)
        above = (self.langs.select("tree", "place", "node").join(langs.select("place", "above"), "place")
                 .select("tree", F.lit(0).cast("long").alias("place"), "above", F.col("node").alias("subroot")))
        return self.arrays.join(_down(self.steps, above), ["tree", "place"]).mapInArrow(_prove(self.root), PROOFS)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; those whose crc32(doc_id) is divisible by 7 are checked with n_chars one larger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return Manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0).proofs()


def _oracle() -> str:
    """The same by SQL: sorted coordinates, every level of all trees at once, proofs by joins."""
    field = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    body = lambda extra: " || ".join(field(f"(n_chars + {extra})" if c == "n_chars" and extra else c) for c in FIELDS)
    def tree(name: str, source: str, key: str) -> str:
        """Recursive levels of ``source`` (key, i, node): {name}(key, lev, i, node, n)."""
        return (f"{name} as (select {key}, 0 as lev, i, node, count(*) over (partition by {key}) as n from {source} union all "
                f"select {key}, lev + 1, i // 2, sha256(string_agg(node, '' order by i)), (n + 1) // 2 from {name} where n > 1 group by {key}, lev, i // 2, n)")

    def path(name: str, levels_of: str, start: str, key: str) -> str:
        """For every row of ``start`` (id, key, i, n): siblings in order, one list, from level 0 up."""
        return (f"{name} as (select s.id, list(coalesce(b.node, '') order by l.lev) as sib, list((s.i >> l.lev) % 2 order by l.lev) as odd, "
                f"list(b.node is not null order by l.lev) as has "
                f"from {start} s join (select distinct {key}, lev, n from {levels_of} where n > 1) l using ({key}) "
                f"left join {levels_of} b on b.{key} = s.{key} and b.lev = l.lev and b.i = xor(s.i >> l.lev, 1) group by s.id)")

    fold = ("list_reduce(list_prepend({start}, list_transform(range(len({sib})), lambda k: case when not {has}[k + 1] then '0' when {odd}[k + 1] = 1 then '1' || {sib}[k + 1] else '2' || {sib}[k + 1] end)), "
            "lambda acc, s: sha256(case when s = '0' then acc when s[1] = '1' then s[2:] || acc else acc || s[2:] end))")
    empty = "[]::varchar[]"
    return f"""
with recursive docs as (
  select *, row_number() over () as id, coalesce('1' || lang, '0') as tree,
         sha256({body(0)}) as leaf, sha256({body(1)}) as longer, {crc32('doc_id')} % 7 = 0 as bad from documents),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, leaf as node from docs),
{tree("nodes", "placed", "tree")},
subroots as (
  select tree, node, '' as top, row_number() over (order by tree) - 1 as i from nodes where n = 1),
{tree("tops", "subroots", "top")},
{path("low", "nodes", "placed", "tree")},
lang_rows as (select tree as id, top, i from subroots),
{path("high", "tops", "lang_rows", "top")},
whole as (
  select p.doc_id, p.leaf, s.node as subroot, (select node from tops where n = 1) as root,
         case when p.bad and p.n_chars is not null then p.longer else p.leaf end as start,
         list_concat(coalesce(low.sib, {empty}), coalesce(high.sib, {empty})) as sib,
         list_concat(coalesce(low.odd, []::bigint[]), coalesce(high.odd, []::bigint[])) as odd,
         list_concat(coalesce(low.has, []::boolean[]), coalesce(high.has, []::boolean[])) as has
  from placed p join subroots s using (tree) left join low on low.id = p.id left join high on high.id = p.tree),
folded as (select *, {fold.format(start="start", sib="sib", odd="odd", has="has")} as folded_root from whole)
select doc_id, leaf, subroot, root, sha256(array_to_string(sib, '')) as proof_sha256, folded_root, folded_root = root as verified from folded"""


ORACLE = _oracle()
