"""Work per key that stays spread out when one key holds a large share of the rows.

Most keys are small and take the plain plan: one shuffle on the key. Keys above a row limit are
found by a count of the key column alone. Only their rows are cut into even, ordered slices by a
range shuffle on (key, order), so a slice is a task's worth of rows whatever the key's share is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from charlake.operators.scratch import written

# Key lists up to this length are sent to every executor; longer ones are joined by shuffle.
MAX_BROADCAST_KEYS = 10_000

# Rows in a slice.
ROWS_PER_SLICE = 250_000

SLICE = "_slice"


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL as it does in a group-by."""
    if not keys:
        raise ValueError("a join needs keys")
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys]
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int, weight: Column | None = None) -> tuple[DataFrame | None, int]:
    """The keys with more than `limit` rows (or weight) and how many rows they have together; (None, 0) if there are none.

    The list comes to the driver only up to `MAX_BROADCAST_KEYS` keys; a longer one stays a frame.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), total.alias("_w")).where(F.col("_w") > limit).drop("_w")
    found = counts.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not found:
        return None, 0
    if len(found) <= MAX_BROADCAST_KEYS:
        listed = df.sparkSession.createDataFrame(found, counts.schema)
        return F.broadcast(listed.drop("_n")), sum(r["_n"] for r in found)
    return counts.drop("_n"), counts.agg(F.sum("_n")).first()[0]


def split_hot(df: DataFrame, keys: Sequence[str], limit: int, weight: Column | None = None) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of the small keys, rows of the large keys or None, and the slices the large ones need."""
    hot, rows = hot_keys(df, keys, limit, weight)
    if hot is None:
        return df, None, 0
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(default, -(-rows // ROWS_PER_SLICE))
    return join_on(df, hot, keys, "left_anti"), join_on(df, hot, keys, "left_semi"), slices


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int) -> DataFrame:
    """Add a slice number. A key's slices follow its order, and a key has at most one slice per partition.

    The result is written, as the slice bounds come from a sample and must not change between uses.
    """
    ranged = df.repartitionByRange(slices, *keys, *order)
    return written(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def _earlier(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def with_ordinal(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, weight: Column | None = None) -> DataFrame:
    """Number each key's rows from 0 in the slices' order, or give the weight of the rows before each.

    A row's number is what its slice has before it plus what the key's earlier slices have.
    """
    weighed = sliced.withColumn("_weight", F.lit(1).cast("long") if weight is None else weight.cast("long"))
    sizes = weighed.groupBy(*keys, SLICE).agg(F.sum("_weight").alias("_all"))
    starts = sizes.select(*keys, SLICE, F.coalesce(F.sum("_all").over(_earlier(keys)), F.lit(0)).alias("_start"))
    before = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        join_on(weighed.withColumn("_before", F.coalesce(F.sum("_weight").over(before), F.lit(0))), starts, [*keys, SLICE])
        .withColumn(name, F.col("_start") + F.col("_before"))
        .drop("_start", "_before", "_weight", SLICE)
    )


def running_in_slices(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], last: Column, first: Column, rank: Sequence[str]
) -> DataFrame:
    """Add `_last` and `_first`: the newest non-NULL `last` and the oldest non-NULL `first` up to each row.

    Each slice is first reduced to its newest and oldest value; a slice then starts from what the
    slices before it carry over. No task sees more than one slice of a key.
    """
    position = F.struct(*rank)
    states = sliced.groupBy(*keys, SLICE).agg(
        F.max_by(last, F.when(last.isNotNull(), position)).alias("_l"),
        F.min_by(first, F.when(first.isNotNull(), position)).alias("_f"),
    )
    carried = states.select(
        *keys, SLICE,
        F.last("_l", ignorenulls=True).over(_earlier(keys)).alias("_carried_last"),
        F.first("_f", ignorenulls=True).over(_earlier(keys)).alias("_carried_first"),
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.withColumn("_in_last", F.last(last, ignorenulls=True).over(inside)).withColumn(
        "_in_first", F.first(first, ignorenulls=True).over(inside)
    )
    return (
        join_on(running, carried, [*keys, SLICE])
        .withColumn("_last", F.coalesce("_in_last", "_carried_last"))
        .withColumn("_first", F.coalesce("_carried_first", "_in_first"))
        .drop("_in_last", "_in_first", "_carried_last", "_carried_first", SLICE)
    )
