"""Token counts: an estimate without a vocabulary, or a caller's tokenizer.

A tokenizer is a function of columns, which stays in the JVM, or a UDF that takes a text and gives a number: by
row, by pandas series or by Arrow array, with or without iterators. A lambda over an array cannot call a UDF, so
an Arrow function takes the array column whole, hands the texts of all its rows to the UDF's function a
slice at a time, and adds the counts up by the arrays' ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.util import PythonEvalType

from charlake.config import (
    CHARS_PER_TOKEN,
    PUNCTUATION_CLASS,
    PUNCTUATION_WEIGHT,
    SPACE_WEIGHT,
    SPECIAL_CLASS,
    SPECIAL_WEIGHT,
)


# Plain letters and spaces are in neither class, so dropping them first leaves little to search.
_PLAIN = r"[A-Za-z\s]+"


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _rest(c: Column) -> Column:
    return F.regexp_replace(c, _PLAIN, "")


def _chars(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def _estimate(chars: Column, spaces: Column, rest: Column) -> Column:
    size = F.greatest(chars, F.lit(1))

    def in_class(pattern: str) -> Column:
        return F.length(F.regexp_replace(rest, f"[^{pattern[1:-1]}]+", ""))

    factor = (
        F.lit(1.0)
        + spaces / size * F.lit(SPACE_WEIGHT)
        + in_class(PUNCTUATION_CLASS) / size * F.lit(PUNCTUATION_WEIGHT)
        + in_class(SPECIAL_CLASS) / size * F.lit(SPECIAL_WEIGHT)
    )
    tokens = F.floor(chars / F.lit(CHARS_PER_TOKEN) * factor).cast("int")
    return F.greatest(F.least(chars, F.lit(1)), tokens)


def estimate_tokens(c: Column) -> Column:
    """Characters / 3.8, raised by the shares of spaces, punctuation and special characters; 0 for no text.

    The text is used several times: select a derived text first, or use `sum_tokens`.
    """
    return _estimate(_chars(c), _spaces(c), _rest(c))


def quarter_tokens(c: Column) -> Column:
    """The cruder estimate: a token per four characters."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / F.lit(4)).cast("int"))


# Bytes of text that go to a UDF's function at a time; a longer text goes by itself.
SLICE_BYTES = 1_000_000


def is_udf(tokenizer: Any) -> bool:
    return hasattr(tokenizer, "evalType") and hasattr(tokenizer, "func")


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        before = ends[start] - sizes[start]
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield texts.slice(start, end - start)
        start = end


def counts_of(texts: pa.Array, function: Callable, kind: int) -> pa.Array:
    """What the function of a UDF of this kind gives for each text."""
    if kind == PythonEvalType.SQL_SCALAR_PANDAS_UDF:
        found = [pa.Array.from_pandas(function(s.to_pandas())) for s in _slices(texts)]
    elif kind == PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF:
        found = [pa.Array.from_pandas(s) for s in function(s.to_pandas() for s in _slices(texts))]
    elif kind == PythonEvalType.SQL_SCALAR_ARROW_UDF:
        found = [function(s) for s in _slices(texts)]
    elif kind == PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF:
        found = list(function(_slices(texts)))
    elif kind in (PythonEvalType.SQL_BATCHED_UDF, PythonEvalType.SQL_ARROW_BATCHED_UDF):
        found = [pa.array([function(t) for t in s.to_pylist()], pa.int64()) for s in _slices(texts)]
    else:
        raise ValueError(f"a tokenizer takes a text and gives a number; this kind of UDF does not: {kind}")
    counts = pa.concat_arrays([pc.cast(f, pa.int64()) for f in found]) if found else pa.array([], pa.int64())
    if len(counts) != len(texts):
        raise ValueError(f"the tokenizer gave {len(counts)} counts for {len(texts)} texts")
    return counts


def sums_by_array(lists: pa.Array, function: Callable, kind: int) -> pa.Array:
    """The counts of each array added up: 0 for an empty or missing one, NULL if one of its counts is."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    counts = counts_of(lists.flatten(), function, kind)
    ends = np.cumsum(sizes)

    def sums(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return total[ends] - total[ends - sizes]

    missing = sums(counts.is_null().to_numpy(zero_copy_only=False).astype(np.int64)) > 0
    return pa.array(sums(counts.fill_null(0).to_numpy(zero_copy_only=False)), pa.int64(), mask=missing)


def _sum_by_udf(texts: Column, tokenizer: Any) -> Column:
    function, kind = tokenizer.func, tokenizer.evalType

    @F.arrow_udf("long")
    def total(lists: pa.Array) -> pa.Array:
        return sums_by_array(lists, function, kind)

    return total(texts)


def sum_tokens(texts: Column, tokenizer: Callable[[Column], Column] | None = None) -> Column:
    """Tokens of an array of texts; 0 for an empty one. Without a tokenizer, the estimate; see the module for UDFs."""
    if is_udf(tokenizer):
        return _sum_by_udf(F.coalesce(texts, F.array().cast("array<string>")), tokenizer)
    if tokenizer is not None:
        return F.aggregate(texts, F.lit(0), lambda total, text: total + tokenizer(text))
    measured = F.transform(
        texts, lambda t: F.struct(_chars(t).alias("chars"), _spaces(t).alias("spaces"), _rest(t).alias("rest"))
    )
    return F.aggregate(measured, F.lit(0), lambda total, m: total + _estimate(m["chars"], m["spaces"], m["rest"]))
