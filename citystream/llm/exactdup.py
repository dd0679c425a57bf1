"""Exact duplicates behind a two-pass Bloom filter, with DataFrame functions only.

Texts are equal when they are identical after ``BLANKS`` are deleted. The first pass reads every text and
sets ``HASHES`` positions of its digest in a Bloom filter whose positions count to two. What counted to two
is the second filter: a bitmap, broadcast. The second pass tests every digest against it. A digest with a
position that only it has set is unique, and its row passes straight through; only the rows of possibly
repeated digests are shuffled, and full digests (SHA-256) decide there, so a filter's false alarm costs a
little work and changes nothing.

The filter has ``BITS_PER_ROW`` bits a row, so about one unique row in 70 is shuffled in vain at any size. What is
broadcast is ``MOST_BITS`` bits (64 MB) at most: a larger corpus is divided by another hash into as many slices as
that takes, each with its own filter and its own pass over the table of digests (some 60 bytes a row; texts are
not read again). A group of copies is one row after the map side of its aggregation, and groups with a large share of
all rows (10,000 at most can have one) reach their rows by broadcast instead of a shuffle.

Null texts count as empty; texts without other than blanks are equal to each other. Of equal texts the row with the most
code points stays, then the smallest doc_id, rows without one last; of rows that tie in all of that, one.
Other columns are ignored by ``duplicates`` and carried along by ``without_copies``. An empty table has an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.hot import lookup
from citystream.session import cut

BLANKS = "[\\x20\\x09-\\x0D]+"
BITS_PER_ROW, HASHES = 16, 2
PAGE = 32_768               # bits of the bitmaps that Spark's bitmap functions build
MOST_BITS = 1 << 29


def digest(text: str) -> Column:
    """SHA-256 of the text without blanks, 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, ""), 256))


def points(text: str) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def _order() -> Column:
    """The smallest stays; ``row_no`` tells repeated rows apart."""
    return F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no"))


def _spots(plane: int) -> list[Column]:
    """A digest's positions, one in each plane of the filter."""
    return [F.pmod(F.xxhash64(F.lit(k), "sha"), F.lit(plane)) + F.lit(k * plane) for k in range(HASHES)]


def _seen_twice(digests: DataFrame, plane: int) -> DataFrame:
    """The second filter: (page, bits) for the pages of the bitmap with a position that more than one row has set."""
    twice = digests.select(F.explode(F.array(*_spots(plane))).alias("spot")).groupBy("spot").count().where("count > 1")
    return (twice.groupBy(F.expr(f"spot div {PAGE}").alias("page"))
            .agg(F.bitmap_construct_agg(F.pmod("spot", F.lit(PAGE))).alias("bits")))


def _tested(rows: DataFrame, pages: DataFrame, plane: int) -> DataFrame:
    """``rows`` with ``possible``: whether all positions of ``sha`` are set."""
    kept = rows.columns
    hit = F.lit(True)
    for k, spot in enumerate(_spots(plane)):
        rows = (rows.withColumn(f"_spot{k}", spot).withColumn(f"_page{k}", F.expr(f"_spot{k} div {PAGE}"))
                .join(F.broadcast(pages.select(F.col("page").alias(f"_page{k}"), F.col("bits").alias(f"_bits{k}"))), f"_page{k}", "left"))
        byte = f"cast(conv(hex(substring(_bits{k}, cast(pmod(_spot{k}, {PAGE}) div 8 as int) + 1, 1)), 16, 10) as int)"
        hit = hit & F.coalesce(F.expr(f"getbit({byte}, cast(pmod(_spot{k}, 8) as int)) = 1"), F.lit(False))
    return rows.select(*kept, hit.alias("possible"))


def sizes(rows: int, most_bits: int = MOST_BITS) -> tuple[int, int]:
    """Slices, and positions in each plane of a slice's filter."""
    bits = max(rows * BITS_PER_ROW, HASHES * PAGE)
    slices = -(-bits // most_bits)
    return slices, -(-bits // (slices * HASHES * PAGE)) * PAGE


def _slice(slices: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), "sha"), F.lit(slices))


def _digests(docs: DataFrame) -> DataFrame:
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest("text").alias("sha"), points("text").alias("points"),
                           F.monotonically_increasing_id().alias("row_no")))


def duplicates(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    digests = _digests(docs)
    n = digests.count()
    slices, plane = sizes(n, most_bits)
    out = None
    for k in range(slices):
        own = digests.where(_slice(slices) == k) if slices > 1 else digests
        tested = _tested(own, cut(_seen_twice(own, plane)), plane)
        possible = cut(tested.where("possible").drop("possible"))
        groups = cut(possible.groupBy("sha").agg(F.count("*").alias("group_size"), F.min(_order()).alias("best")))
        judged = (lookup(possible, groups, ["sha"], "group_size", n)
                  .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row_no") == F.col("row_no")).alias("kept"), "sha"))
        unique = tested.where(~F.col("possible")).select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
        part = unique.unionByName(judged)
        part = cut(part) if slices > 1 else part    # one slice's filter at a time
        out = part if out is None else out.unionByName(part)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; texts are read once more, those of unique rows are never shuffled."""
    digests = _digests(docs)
    slices, plane = sizes(digests.count(), most_bits)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), digest("text").alias("sha"),
                       points("text").alias("points"), F.lit(0).alias("row_no"))
    out = None
    for k in range(slices):
        mine = _slice(slices) == k
        tested = _tested(rows.where(mine) if slices > 1 else rows, cut(_seen_twice(digests.where(mine) if slices > 1 else digests, plane)), plane)
        best = tested.where("possible").groupBy("sha").agg(F.min_by("row", _order()).alias("row")).select("row.*")
        part = tested.where(~F.col("possible")).select("row.*").unionByName(best)
        part = cut(part) if slices > 1 else part
        out = part if out is None else out.unionByName(part)
    return out


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
with norm as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents),
ranked as (
  select doc_id, sha256(body) as text_sha256,
         count(*) over (partition by body) as group_size,
         first_value(doc_id) over w as keep_id, row_number() over w as place
  from norm window w as (partition by body order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from ranked"""
