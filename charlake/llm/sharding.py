"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

Rows are ordered by (doc_id, a tie number fixed when the keys are written). A size-weighted sample of
keys, bounded by `SAMPLE_PER_RANGE` rows for each range, gives boundaries that cut the bytes evenly;
ranges that still hold too many rows are cut again by a sample of their own rows. The ranges only
spread the work: inside each, running sums of bytes and rows place every row exactly, so the shards
do not hang on what the sample drew. Law `bytes`: shard k takes the rows whose middle byte lies in
the k-th eighth of all bytes, so a shard is off its even share by one row's size at most.

NULL doc_id: first in order. NULL text: size 1, CRC of nothing (0). Equal rows: each gets a slot of
its own. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from charlake.llm.common import long_array
from charlake.llm.registry import query, table
from charlake.operators.scratch import written

# Rows a range should hold; a range of more than twice as many is cut again. The number of ranges follows the table.
ROWS_PER_RANGE = 250_000
MIN_RANGES = 64
MAX_RANGES = 16_384
# Sampled keys for each range: the bound on what one task sorts and the driver reads is this times the ranges.
SAMPLE_PER_RANGE = 16

_FIRST = -(1 << 63)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, _key, _tie, written once: the tie of equal keys must not change between uses."""
    body = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    keys = docs.select("doc_id", (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"))
    return written(
        keys.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))).withColumn("_tie", F.monotonically_increasing_id()),
        "shard-keys",
    )


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """How many bounds are at or below the row's (_key, _tie): a binary search over constant arrays."""
    steps = max(1, len(bounds).bit_length())
    keys, ties = long_array([k for k, _ in bounds]), long_array([t for _, t in bounds])
    n = len(bounds)

    def step(low: Column, bit: Column) -> Column:
        at = low + bit
        k, t = F.get(keys, at - 1), F.get(ties, at - 1)
        below = (at <= n) & ((k < F.col("_key")) | ((k == F.col("_key")) & (t <= F.col("_tie"))))
        return F.when(below, at).otherwise(low)

    bits = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    return F.aggregate(bits, F.lit(0), step)


def _splitters(rows: DataFrame, weight: Column, groups: Column, total: Column, cuts: Column, per_cut: int) -> list[tuple[int, int]]:
    """Quantile boundaries of each group from a weighted sample of its keys.

    A row is drawn with the chance weight * sample / total, by a hash of its key, so a repeated task
    draws the same rows; rows heavier than that are drawn for certain and stand for themselves.
    """
    chance = weight * cuts * per_cut / total
    luck = F.pmod(F.xxhash64("_key", "_tie"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.select("_key", "_tie", groups.alias("g"), cuts.alias("cuts"), total.alias("total"), F.when(chance >= 1, weight).otherwise(total / (cuts * per_cut)).alias("w"), (luck < chance).alias("in")).where("in")
    order = Window.partitionBy("g").orderBy("_key", "_tie")
    level = F.floor(F.sum("w").over(order) * F.col("cuts") / F.sum("w").over(Window.partitionBy("g")))
    level = drawn.select("g", "_key", "_tie", level.alias("level"))
    cut = level.where("level > 0").groupBy("g", "level").agg(F.min(F.struct("_key", "_tie")).alias("b"))
    return sorted((r["b"]["_key"], r["b"]["_tie"]) for r in cut.select("b").collect())


def ranged(keys: DataFrame) -> DataFrame:
    """Add `_range`: ranges in key order that hold about as many bytes each, none with very many rows."""
    rows, size = keys.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not rows:
        return keys.withColumn("_range", F.lit(0))
    wanted = min(MAX_RANGES, max(MIN_RANGES, -(-rows // ROWS_PER_RANGE)))
    weight = F.col("size").cast("double")
    bounds = _splitters(keys, weight, F.lit(0), F.lit(float(size)), F.lit(wanted), SAMPLE_PER_RANGE)
    first = keys.withColumn("_range", _range_of(bounds))
    limit = max(2 * ROWS_PER_RANGE, 2 * -(-rows // MAX_RANGES))
    over = first.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    full = {r["_range"]: r["_n"] for r in over.collect()}  # at most MAX_RANGES rows
    if full:
        count = F.create_map(*[F.lit(x) for kv in full.items() for x in kv])[F.col("_range")]
        inside = first.where(F.col("_range").isin(*full))
        n = F.col("_n").cast("double")
        more = _splitters(inside.withColumn("_n", count), F.lit(1.0), F.col("_range"), n, F.ceil(n / ROWS_PER_RANGE), SAMPLE_PER_RANGE)
        first = keys.withColumn("_range", _range_of(sorted({*bounds, *more})))
    return first


def shard_by_bytes(docs: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL under this law)."""
    placed = ranged(keyed(docs, text))
    cells = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_bytes"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range: bounded
    starts = cells.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy("_key", "_tie")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumn("_rank", F.row_number().over(inside) - 1).withColumn("_end", F.sum("size").over(so_far))
    rows = rows.join(F.broadcast(starts), "_range")
    middle = (F.col("_byte0") + F.col("_end")) * 2 - F.col("size")  # twice the middle byte
    shard = F.least(F.floor(middle.cast("decimal(38,0)") * shards / (F.col("_all") * 2)).cast("int"), F.lit(shards - 1))
    rows = written(
        rows.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("_row0") + F.col("_rank")).alias("_row")), "shard-rows"
    )
    first = rows.groupBy("shard").agg(F.min("_row").alias("_first"))
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


_SQL = """
WITH t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n::BIGINT)) AS tab
), d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents
), c AS (
  SELECT doc_id, size, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
  FROM d, t
), p AS (
  SELECT *, least(7, floor((sum(size) OVER (ORDER BY doc_id) * 2 - size) * 8 / (sum(size) OVER () * 2)))::INT AS shard FROM c
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM p
"""


@query("op2_sampled_splitters", _SQL)
def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))
