"""Column shaping: one select, built from a spec."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from charlake.functions.dates import parse_date, parse_timestamp
from charlake.functions.feedback import feedback_class_or_null


def enforce_columns(df: DataFrame, columns: Sequence[str], default: str = "") -> DataFrame:
    """Exactly these columns in this order; a missing one holds the default text."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(default).alias(c) for c in columns])


def _typed(c: Column, kind: str, zero_as_null: bool, feedback: Column | None) -> Column:
    text = F.nullif(c.cast("string"), F.lit(""))
    if kind == "date":
        return parse_date(text)
    if kind == "timestamp":
        return parse_timestamp(text)
    if kind == "number":
        return text.try_cast("int")
    if kind == "integer":
        return F.when(text != "0", text.try_cast("int")) if zero_as_null else text.try_cast("int")
    if kind == "double":
        return text.try_cast("double")
    if kind == "feedback":
        return feedback_class_or_null(c)
    if kind == "answer":
        return c.cast("string") if feedback is None else F.when(feedback_class_or_null(feedback).isNotNull(), c.cast("string"))
    if kind == "string":
        return c.cast("string")
    raise ValueError(f"unknown type: {kind}")


def typed_columns(
    df: DataFrame, types: Mapping[str, str], zero_as_null: bool = True, feedback: str = "feedback"
) -> list[Column]:
    """Columns of the frame by the spec, names in any case; a column not in it stays as it is.

    Types: string, date, timestamp, number, integer (where `0` may mean NULL), double, `feedback` (like, dislike, mixed or NULL) and
    `answer` (kept only where the feedback column is valid).
    """
    gate = next((F.col(c) for c in df.columns if c.lower() == feedback), None)
    return [
        _typed(F.col(c), types[c.lower()], zero_as_null, gate).alias(c) if c.lower() in types else F.col(c)
        for c in df.columns
    ]
