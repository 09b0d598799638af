"""Dates and timestamps from dirty text. Bad text gives NULL, never an error."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Day first where both read.
DATE_FORMATS = ("dd/MM/yyyy", "M/d/yyyy")


def parse_timestamp(c: Column) -> Column:
    """ISO 8601, `Z` allowed."""
    return F.try_to_timestamp(c)


def parse_date(c: Column) -> Column:
    """The first of `DATE_FORMATS` that reads the text, else any ISO form."""
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMATS], c.try_cast("date"))


def render_date(c: Column, missing: str) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(missing))


def in_window_or_null(c: Column, first_day: date | None, last_day: date | None) -> Column:
    """Within the days, both included. A missing date is kept; no `last_day` means today."""
    inside = F.lit(True)
    if first_day is not None:
        inside = inside & (c >= F.lit(first_day))
    inside = inside & (c <= (F.lit(last_day) if last_day is not None else F.current_date()))
    return c.isNull() | inside
