"""The prefix trie of conversations, by range partitions and a skeleton of their splitters.

A turn is its digest (half a SHA-256 of role and text) and its text's bytes; a conversation is the sequence of
these records, its path. The rebuilt paths are ordered bytewise, equal ones by conv_id, and divided into shards by splitters:
quantiles of a sample, cut to ``DEEPEST`` turns. A node has members in two shards only if it is a prefix of the splitter between
them, so the trie of the splitters, the skeleton, is broadcast (``MOST_SHARDS`` x (``DEEPEST`` + 1) nodes at most,
whatever the data). Every shard is sorted and read once with the nodes above the current path on a stack: a node is whole when
the path leaves it, unless it is a skeleton node, which leaves a partial aggregate. The partial ones are
reduced by node, and summed over subtrees on the skeleton. A second reading in the opposite order hands each node its parent's
conv_id, which is known only when the parent is whole.

Sampling sets only where shards begin. A sequence of turns that a third of all conversations share is cut by conv_id like any other
range, for splitters carry both; what it has in each shard is one partial aggregate, and its list of ids comes as
pieces in order, which the digest reads as a stream (a digest of a list is sequential by its definition).

Turns are ordered by turn (null first), ties by role, then by the record; repeated rows are repeated turns. A null role or text is empty.
Rows without a conv_id belong to no conversation and are left out. ``conv_id % 5`` has the sign of conv_id. A table without a
conversation has no node, not even the root. Other columns are ignored. Memory per conversation: 24 bytes a turn for its path, and
a stack entry for each of its turns.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.duck import crc32
from citystream.session import cut

RECORD = 24                                 # 16 bytes of digest, 8 of length
DEEPEST, MOST_SHARDS, SAMPLE = 128, 4096, 8
SHARD_BYTES, PIECE = 64 << 20, 1 << 18

NODE = [("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
PART = [("shard", pa.int32()), ("seq", pa.int64()), ("skeleton", pa.int32()), ("above", pa.int32()), ("ends", pa.binary()), *NODE]
PART_DDL = ("shard int, seq long, skeleton int, above int, ends binary, conv_id long, depth int, parent_conv_id long, n_convs long, "
            "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): conv_id and path."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    record = F.concat(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32),
                      F.lpad(F.hex(size), 16, "0"))
    return (turns.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), role.alias("role"), record.alias("record")).alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.unhex(F.array_join(F.transform("ts", lambda t: t["record"]), "")).alias("path")))


def rebuilt(own: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation with its first turns replaced by those of its group's first one, crc32(conv_id) % ``most`` of them."""
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = own.where(first == F.col("conv_id")).select(F.col("conv_id").alias("first"), F.col("path").alias("head"))
    at = (F.crc32(F.col("conv_id").cast("string")) % most * RECORD).cast("int")
    rest = F.substring("path", at + 1, F.greatest(F.octet_length("path") - at, F.lit(0)))
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), at)
    return (own.withColumn("first", first).join(heads, "first", "left").select("conv_id", F.concat(head, rest).alias("path")))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    n = min(len(a), len(b)) // RECORD
    if a[:n * RECORD] == b[:n * RECORD]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        low, n = (mid, n) if a[:mid * RECORD] == b[:mid * RECORD] else (low, mid)
    return low


class Skeleton:
    """The trie of the splitters, numbered depth first. ``ids[k][d]`` is the node of the first d turns of splitter k; 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]) -> None:
        self.splitters = splitters
        self.ids: list[list[int]] = []
        self.parent, self.depth, self.size, self.turn_bytes = [-1], [0], [1], [0]
        before, nodes = b"", [0]
        for path, _ in splitters:
            nodes = nodes[:_common(before, path) + 1]
            for d in range(len(nodes), len(path) // RECORD + 1):
                self.parent.append(nodes[-1])
                self.depth.append(d)
                self.turn_bytes.append(int.from_bytes(path[d * RECORD - 8:d * RECORD]))
                nodes.append(len(self.parent) - 1)
            self.ids.append(nodes)
            before = path
        self.size = [1] * len(self.parent)
        for k in range(len(self.parent) - 1, 0, -1):
            self.size[self.parent[k]] += self.size[k]

    def around(self, shard: int) -> list[tuple[bytes, list[int]]]:
        """The splitters below and above a shard, with their nodes."""
        return [(self.splitters[k][0], self.ids[k]) for k in (shard - 1, shard) if 0 <= k < len(self.splitters)]


def skeleton(trees: DataFrame, most_shards: int = MOST_SHARDS, deepest: int = DEEPEST) -> Skeleton:
    """Splitters for ``trees`` (conv_id, path): of SAMPLE candidates a shard, drawn by a hash, the quantiles."""
    n, size = trees.agg(F.count("*"), F.sum(F.octet_length("path"))).first()
    width = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(most_shards, n, max(width, (size or 0) // SHARD_BYTES)))
    share = min(1.0, shards * SAMPLE / max(n, 1))
    drawn = trees.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = (drawn.select(F.substring("path", 1, deepest * RECORD).alias("path"), "conv_id")
            .orderBy(F.xxhash64(F.lit(1), "conv_id")).limit(shards * SAMPLE).collect())
    found = sorted((bytes(r.path), r.conv_id) for r in rows)
    at = [len(found) * k // shards for k in range(1, shards)]
    return Skeleton(sorted({found[k] for k in at if k < len(found)}))


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shared.value.splitters
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(splitters, k) for k in keys], pa.int32()), *batch.columns],
                                             names=["shard", *batch.schema.names])
    return run


class _Node:
    __slots__ = ("low", "n", "children", "leaves", "saved", "ends", "listed", "skeleton", "path_bytes")

    def __init__(self, skeleton: int, path_bytes: int) -> None:
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.listed, self.skeleton, self.path_bytes = None, False, skeleton, path_bytes


def _shards(shared):
    """Nodes of sorted shards, children before parents; partial aggregates of skeleton nodes, and pieces of their lists of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        out: list[tuple] = []
        shard, seq, stack, path, around = None, 0, [], b"", []

        def emit(skeleton: int, above: int, ends: bytes | None, node: tuple) -> None:
            nonlocal seq
            out.append((shard, seq, skeleton, above, ends, *node))
            seq += 1

        def pieces(node: _Node) -> None:
            if node.ends:
                emit(node.skeleton, -1, ",".join(node.ends).encode(), (None,) * 8)
                node.ends = []

        def close(depth: int) -> None:
            """Finishes the nodes below ``depth``."""
            while len(stack) > depth:
                node, d = stack.pop(), len(stack)
                own = (node.n - 1) * node.path_bytes
                up = stack[-1] if stack else None
                if node.skeleton >= 0:
                    pieces(node)
                    emit(node.skeleton, -1, None, (node.low, d, None, node.n, node.children, node.leaves, node.saved, None))
                else:
                    leaves = node.leaves if node.children else 1
                    emit(-1, up.skeleton, None, (node.low, d, None, node.n, node.children, leaves, node.saved + own,
                                                 (node.ends or sha256()).hexdigest()))
                    up.children += 1
                    up.leaves += leaves
                    up.saved += node.saved + own
                if up is not None:
                    up.n += node.n
                    up.low = node.low if up.low is None or node.low < up.low else up.low

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), PART, strict=True)],
                                               names=[n for n, _ in PART])
            out.clear()
            return batch

        for batch in batches:
            for at, conv, new in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path")), strict=True):
                if at != shard:
                    if shard is not None:
                        close(0)
                    shard, seq, path, around = at, 0, b"", tree.around(at)
                    stack.append(_Node(0, 0))
                keep = _common(path, new)
                close(keep + 1)
                for d in range(keep + 1, len(new) // RECORD + 1):
                    known = -1
                    if stack[-1].skeleton >= 0:
                        for splitter, ids in around:
                            if d < len(ids) and splitter[(d - 1) * RECORD:d * RECORD] == new[(d - 1) * RECORD:d * RECORD] and ids[d - 1] == stack[-1].skeleton:
                                known = ids[d]
                    stack.append(_Node(known, int.from_bytes(new[d * RECORD - 8:d * RECORD])))
                path, node = new, stack[-1]
                node.n += 1
                node.low = conv if node.low is None else min(node.low, conv)
                if node.skeleton < 0:
                    node.ends = node.ends or sha256()
                    node.ends.update(f",{conv}".encode() if node.listed else f"{conv}".encode())
                    node.listed = True
                else:
                    node.ends = node.ends or []
                    node.ends.append(str(conv))
                    if len(node.ends) * 8 > PIECE:
                        pieces(node)
                if len(out) >= 10_000:
                    yield flush()
        if shard is not None:
            close(0)
        if out:
            yield flush()
    return run


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From parents to children: fills parent_conv_id where the parent is no skeleton node."""
    shard, lows = None, []
    place = [n for n, _ in PART].index("parent_conv_id")
    for batch in batches:
        out = []
        for at, skeleton, above, conv, depth in zip(*(batch.column(c).to_pylist() for c in ("shard", "skeleton", "above", "conv_id", "depth")), strict=True):
            if at != shard:
                shard, lows = at, []
            if depth is None or skeleton >= 0:
                out.append(None)
                continue
            out.append(lows[depth - 1] if above < 0 else None)
            lows = lows[:depth] + [None] * (depth - len(lows))
            lows.append(conv)
        columns = list(batch.columns)
        columns[place] = pa.array(out, pa.int64())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's list of ids, whose pieces come in order."""
    current, h = None, None
    for batch in batches:
        done = []
        for node, piece in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if node != current:
                if current is not None:
                    done.append((current, h.hexdigest()))
                current, h = node, sha256(piece)
            else:
                h.update(b"," + piece)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.string()), strict=True)],
                                             names=["skeleton", "ends_sha256"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([h.hexdigest()])], names=["skeleton", "ends_sha256"])


def _skeleton_nodes(spark: SparkSession, tree: Skeleton, parts: DataFrame) -> DataFrame:
    """The skeleton's nodes with their subtrees' sums, a small table: skeleton and the columns of a node."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    listed = (parts.where("ends is not null").select("skeleton", "shard", "seq", "ends").repartition(int(width), "skeleton")
              .sortWithinPartitions("skeleton", "shard", "seq").mapInArrow(_digests, "skeleton int, ends_sha256 string"))
    sums = (parts.where("skeleton >= 0 and ends is null").groupBy("skeleton")
            .agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
            .join(listed, "skeleton", "left"))
    found = {r.skeleton: r for r in sums.collect()}     # one row a skeleton node
    count = len(tree.parent)
    n, low = [0] * count, [None] * count
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for k, r in found.items():
        n[k], low[k], children[k], leaves[k], saved[k] = r.n_convs, r.conv_id, r.n_children, r.n_leaves, r.saved_tokens
    for k in range(count - 1, -1, -1):      # depth first numbers: children come after their parents
        leaves[k] = leaves[k] if children[k] else 1
        saved[k] += (n[k] - 1) * tree.turn_bytes[k]
        if k:
            up = tree.parent[k]
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    nothing = sha256().hexdigest()
    rows = [(k, low[k], tree.depth[k], low[tree.parent[k]] if k else None, n[k], children[k], leaves[k], saved[k],
             (found[k].ends_sha256 if k in found else None) or nothing) for k in range(count)] if found else []
    return spark.createDataFrame(rows, "skeleton int, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, "
                                       "n_leaves long, saved_tokens long, ends_sha256 string")


def trie(trees: DataFrame, most_shards: int = MOST_SHARDS, deepest: int = DEEPEST) -> DataFrame:
    """The nodes of the trie of ``trees`` (conv_id unique, path): the columns of NODE, a row a node."""
    spark = trees.sparkSession
    tree = skeleton(trees, most_shards, deepest)
    shared = spark.sparkContext.broadcast(tree)
    shards = len(tree.splitters) + 1
    names = [n for n, _ in NODE]
    parts = cut(trees.select("conv_id", "path").mapInArrow(_place(shared), "shard int, conv_id long, path binary")
                .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id").mapInArrow(_shards(shared), PART_DDL)
                .sortWithinPartitions("shard", F.desc("seq")).mapInArrow(_parents, PART_DDL))
    top = _skeleton_nodes(spark, tree, parts)
    ours = F.broadcast(top.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("known")))   # MOST_SHARDS x (DEEPEST + 1) rows at most
    whole = (parts.where("skeleton < 0").join(ours, "above", "left").withColumn("parent_conv_id", F.coalesce("known", "parent_conv_id")))
    return whole.select(*names).unionByName(top.select(*names)).withColumn("depth", F.col("depth").cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie(cut(rebuilt(cut(paths(turns)))))


ORACLE = f"""
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
         coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
ids as (select distinct conv_id, conv_id - conv_id % 5 as first, {crc32("conv_id")} % 9 as h from own),
turns as (
  select i.conv_id, o.k, o.role, o.text from ids i join own o on o.conv_id = i.first and o.k <= i.h
  union all select i.conv_id, o.k, o.role, o.text from ids i join own o on o.conv_id = i.conv_id and o.k > i.h),
paths as (
  select i.conv_id, coalesce(list({{'role': t.role, 'text': t.text}} order by t.k) filter (t.k is not null), []) as path
  from ids i left join turns t using (conv_id) group by i.conv_id),
prefixes as (
  select conv_id, d, path[1:d] as p, len(path) as total, case when d = 0 then 0 else strlen(path[d].text) end as bytes
  from paths, unnest(range(len(path) + 1)) as u(d)),
nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (total = d), '')) as ends_sha256
  from prefixes group by p, d),
children as (select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by all),
above as (
  select n.p[1:a] as p, count(*) filter (c.n_children is null) as n_leaves, sum(n.saved) as saved_tokens
  from (select *, unnest(range(d + 1)) as a from nodes) n left join children c on c.p = n.p group by n.p[1:a])
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children,
       above.n_leaves, cast(above.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from nodes n join above on above.p = n.p left join children c on c.p = n.p left join nodes up on n.d > 0 and up.p = n.p[1:n.d - 1]"""
