"""Joins that keep one side small by aggregating it first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from charlake.functions.text import strip


def latest_per_key(df: DataFrame, key: str, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key with the values of its last row. Partial aggregation leaves one row per task and key."""
    last = df.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return last.select(key, *[F.col(f"_last.{v}").alias(v) for v in values])


def join_latest(left: DataFrame, right: DataFrame, key: str, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left rows with the last right values of their key; a left row keeps its own values if there are none."""
    latest = latest_per_key(right, key, values, order)
    fresh = latest.select(key, F.lit(True).alias("_found"), *[F.col(v).alias(f"_new_{v}") for v in values])
    joined = left.join(fresh, key, "left")

    def value(v: str) -> Column:
        new = F.col(f"_new_{v}")
        return F.when(F.col("_found"), new).otherwise(F.col(v) if v in left.columns else F.lit(None))

    kept = [c for c in left.columns if c not in values]
    return joined.select(*kept, *[value(v).alias(v) for v in values])


def without_names(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Drop rows whose trimmed, lower-cased name is in a short list."""
    if not names:
        return df
    return df.where(~F.coalesce(F.lower(strip(F.col(column))).isin(*[n.lower() for n in names]), F.lit(False)))


def without_names_table(df: DataFrame, column: str, names: DataFrame, names_column: str) -> DataFrame:
    """As `without_names`, for a table of names. Adaptive execution broadcasts it if it is small."""
    lookup = names.select(F.lower(strip(F.col(names_column))).alias("_excluded")).distinct()
    return df.join(lookup, F.lower(strip(F.col(column))) == F.col("_excluded"), "left_anti")
