"""As-of join: each left row gets the newest right row of the same key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from charlake.operators.scratch import written
from charlake.operators.skew import in_slices, running_in_slices, split_hot

_ORDER = ("_ts", "_side", "_tie")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    payload: Sequence[str],
    tie: str,
    left_tie: str,
    prefer: Column | None = None,
    fallback: str | None = None,
    rows_per_window: int = 1_000_000,
) -> DataFrame:
    """Left rows plus the payload of their match and `matched`.

    `prefer` limits the match to right rows that satisfy it. With `fallback="oldest"`, a left row
    without such a match takes the oldest right row at or before its time. `tie` orders right rows
    of equal time, `left_tie` keeps left rows of equal time apart. Rows without key or time should
    be dropped by the caller: they match nothing.

    Both sides are written once with row numbers. Only keys, times and numbers are stacked and shuffled on the
    key; a running window finds the number of the match, so no pairs are made, and what a window holds
    does not hang on how wide the rows are. Keys above `rows_per_window` rows run in time slices instead.
    The rows themselves come back by two joins on their numbers; a right row is read only if it is a match.
    """
    if fallback not in (None, "oldest"):
        raise ValueError(f"unknown fallback: {fallback}")
    good = F.lit(True) if prefer is None else F.coalesce(prefer, F.lit(False))
    # The caller's columns stand in a struct, so that their names are free.
    right = _numbered(right.select(
        *_keys(right, by, on, tie), good.alias("_good"), F.struct(*payload).alias("_payload"),
    ), "asof-right", "_right")
    left = _numbered(left.select(*_keys(left, by, on, left_tie), F.struct(*left.columns).alias("_row")), "asof-left", "_left")
    key = [f"_by{i}" for i in range(len(by))]
    narrow = [*key, "_ts", "_tie"]
    hit = F.when(F.col("_good"), F.col("_right")).alias("_hit")
    other = F.col("_right") if fallback else F.lit(None).cast("long")
    stacked = right.select(*narrow, F.lit(0).alias("_side"), hit, other.alias("_any")).unionByName(
        left.select(*narrow, F.lit(1).alias("_side"), "_left"), allowMissingColumns=True
    )
    found = _matches(stacked, key, rows_per_window).where("_side = 1").select("_left", F.coalesce("_last", "_first").alias("_right"))
    matched = left.join(found, "_left").join(right.select("_right", "_payload"), "_right", "left")
    columns = matched.select("_row", "_payload", F.col("_right").isNotNull().alias("_matched"))
    return columns.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in _left_columns(left, by)],
        *[F.col(f"_payload.`{c}`").alias(c) for c in payload], F.col("_matched").alias("matched"),
    )


def _keys(df: DataFrame, by: Sequence[str], on: str, tie: str) -> list[Column]:
    return [*[df[c].alias(f"_by{i}") for i, c in enumerate(by)], df[on].alias("_ts"), df[tie].cast("string").alias("_tie")]


def _numbered(df: DataFrame, name: str, number: str) -> DataFrame:
    """The rows, written once, each with a number of its own."""
    return written(df.withColumn(number, F.monotonically_increasing_id()), name)


def _left_columns(left: DataFrame, by: Sequence[str]) -> list[str]:
    return [*by, *[c for c in left.schema["_row"].dataType.names if c not in by]]


def _matches(stacked: DataFrame, by: Sequence[str], rows_per_window: int) -> DataFrame:
    """Adds the numbers of the newest good row and of the oldest row so far."""

    small, large, slices = split_hot(stacked, by, rows_per_window)
    running = Window.partitionBy(*by).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    matched = small.withColumn("_last", F.last("_hit", ignorenulls=True).over(running)).withColumn(
        "_first", F.first("_any", ignorenulls=True).over(running)
    )
    if large is not None:
        sliced = in_slices(large, by, _ORDER, slices)
        matched = matched.unionByName(
            running_in_slices(sliced, by, _ORDER, F.col("_hit"), F.col("_any"), rank=_ORDER)
        )
    return matched
