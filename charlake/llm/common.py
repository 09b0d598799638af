"""Helpers the operators of this subpackage share: slices of text batches, splitters, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from charlake.operators.scratch import dropped, written

# Lists of keys up to this length may be sent to every executor: 16 MB of numbers.
MAX_SENT = 1_000_000

# Characters of text a Python task turns into words or tokens at a time.
CHARS_AT_A_TIME = 1_000_000


def slices(sizes: Sequence[int], limit: int = CHARS_AT_A_TIME) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `limit` of the given sizes each; a larger row is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def long_array(values: Sequence[int]) -> Column:
    """A constant array of longs, from one text constant, so that its length does not burden the plan."""
    if not values:
        return F.expr("CAST(array() AS ARRAY<BIGINT>)")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def sendable(keys: DataFrame, name: str) -> DataFrame:
    """A list of keys, written and counted: to be broadcast if it is short, else to be joined by shuffle."""
    keys = written(keys, name)
    return F.broadcast(keys) if keys.count() <= MAX_SENT else keys


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as it takes to be no column of the frame's, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, name: str, row: str, **options: str) -> DataFrame:
    """The rows, written once, with numbers of their own from 0 in the new column `row`."""
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), name, **options)
    # The upper bits are the partition's number: what the partitions before it hold takes their place.
    part = F.shiftright(row, 33)
    starts, total = [], 0
    for found in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        starts += [total] * (found["part"] + 1 - len(starts))
        total += found["n"]
    return rows.withColumn(row, F.get(long_array(starts), part.cast("int")) + F.col(row).bitwiseAND(F.lit((1 << 33) - 1)))


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """Connected components of a graph by distributed union-find: node, root (the smallest node of its component).

    `edges` has two long columns. Each round hooks every node's neighbours to the smallest one it knows
    (large star), then every node and its smaller neighbours to the smallest (small star), until no
    edge changes. A round writes its edges to the shared folder, so no lineage grows and a lost
    executor repeats one round at most; the tables of the round before go. A node's neighbours are never gathered: both steps are a
    partial minimum by node and a join.
    """
    spark = edges.sparkSession
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), name
    )
    state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.where("u <> v"), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, current = current, written(small.where("u <> v").distinct(), name)
        dropped(before, large)
        after = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            break
        state = after
    roots = current.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    tops = current.select(F.col("v").alias("node")).distinct().join(roots.select("node"), "node", "left_anti")
    found = written(roots.union(tops.select("node", F.col("node").alias("root"))), name)
    dropped(current)
    return found


def same_rows(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Where the runs of rows with equal keys begin in a sorted frame, and its end."""
    new = np.ones(len(frame), bool)
    if len(frame):
        new[1:] = np.any([frame[k].to_numpy()[1:] != frame[k].to_numpy()[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(new), len(frame))


def whole_groups(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows of a sorted partition in frames that hold whole groups; the caller bounds a group's size."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = same_rows(frame, keys)[-2]
        goes_on = bool(held) and all(held[-1][k].iloc[-1] == frame[k].iloc[0] for k in keys)
        if not (goes_on and last == 0):  # else all of it belongs to the group before
            whole = pd.concat([*held, frame.iloc[:last]], ignore_index=True)
            held = []
            if len(whole):
                yield whole
        held.append(frame.iloc[last:])
    if held:
        yield pd.concat(held, ignore_index=True)
