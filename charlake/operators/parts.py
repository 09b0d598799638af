"""Groups that become one text cell, in parts of bounded size.

A user or a conversation without limit cannot be one row: a cell holds 2 GB and a group is built in
one task. The limit is a number of rows, and bytes where the caller gives a row's size. So a group above the limit goes on in further rows, numbered by part; parts in order are
the whole group, and nothing is left out. A group within the limit is a single row, part 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from charlake.operators.scratch import written
from charlake.operators.skew import in_slices, split_hot, with_ordinal


def by_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_part: int,
    part: str,
    build: Callable[[DataFrame, list[str]], DataFrame],
    across: Callable[[DataFrame], DataFrame] | None = None,
    size: Column | None = None,
    bytes_per_part: int = 1 << 27,
) -> DataFrame:
    """`build(rows, group_columns)` for every group, groups above the limit split by `part`.

    `across(parts)` changes the built parts of the large groups where they depend on each other. Pass raw
    rows and do costly row work in `build`: large groups are scanned, sampled and written first.

    With `size`, the bytes of a row, a part holds at most `bytes_per_part` and one row more: a row takes up its share of the
    rows or its bytes, whichever is more, and a part ends where the running sum passes its limit. A row above the
    limit is the last of its part, so parts follow each other without a gap.
    """
    limit, weight = rows_per_part, None
    if size is not None:
        share = max(1, bytes_per_part // rows_per_part)
        limit = share * rows_per_part
        weight = F.least(F.greatest(F.coalesce(size, F.lit(0)).cast("long"), F.lit(share)), F.lit(limit))
    small, large, slices = split_hot(df, keys, limit, weight)
    whole = build(small, list(keys)).withColumn(part, F.lit(0).cast("int"))
    if large is None:
        return whole
    sliced = in_slices(large, keys, order, slices)
    numbered = with_ordinal(sliced, keys, order, "_ordinal", weight).withColumn(
        part, F.call_function("div", F.col("_ordinal"), F.lit(limit).cast("long")).cast("int")
    )
    parts = build(numbered.drop("_ordinal"), [*keys, part])
    return whole.unionByName(parts if across is None else across(written(parts, "parts")))
