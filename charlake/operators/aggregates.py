"""Ordered aggregates. Every one names its order, so results do not hang on task timing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from charlake.functions.text import is_blank


def first_non_blank(c: Column, order: Column, default: str = "", ignore: Sequence[str] = ()) -> Column:
    """The first value in order that is not blank and not one of `ignore`."""
    usable = ~is_blank(c)
    if ignore:
        usable = usable & ~c.isin(*ignore)
    return F.coalesce(F.min_by(c, F.when(usable, order)), F.lit(default))


def last_non_blank(c: Column, order: Column, default: str = "") -> Column:
    return F.coalesce(F.max_by(c, F.when(~is_blank(c), order)), F.lit(default))


def ordered_concat(c: Column, order: Sequence[Column], separator: str) -> Column:
    """Non-blank values joined in order. The group must be bounded; see `operators.parts`."""
    rows = F.collect_list(F.when(~is_blank(c), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], c.alias("v"))))
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["v"]), separator)
