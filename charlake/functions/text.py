"""Text clean-up as native column expressions.

Each function uses its input once where it can: the optimizer copies an input expression to every
place that uses it, so two uses of a derived column cost twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from charlake.config import BLANK_WORDS, WHITE_SPACE

# The white space characters as a pattern, and a text that has no value.
_SPACE = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
_BLANK = f"(?i)^{_SPACE}*(?:{'|'.join(w for w in BLANK_WORDS if w)})?{_SPACE}*$"

# A run of unprintable characters or spaces that is not just one space. Printable ASCII is ruled out first.
_UNPRINTABLE = r"[[^\x21-\x7e]&&[\p{C}\p{Z}]]"
_GAP = rf"[[^\x20-\x7e]&&[\p{{C}}\p{{Z}}]]{_UNPRINTABLE}*| {_UNPRINTABLE}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Trim all white space, not only the space character."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(c.rlike(_BLANK), F.lit(True))


def blank_to_empty(c: Column) -> Column:
    """Trimmed, and empty for a text without a value. For short texts: one pass of one pattern."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"{_BLANK}|^{_SPACE}+|{_SPACE}+$", "")


def empty_to(c: Column, label: str) -> Column:
    """The label for an empty text."""
    return F.regexp_replace(c, "^$", label.replace("\\", r"\\").replace("$", r"\$"))


def count_of(c: Column, word: str) -> Column:
    """How often a word stands in a text, without overlaps."""
    gone = F.length(c) - F.length(F.replace(c, F.lit(word), F.lit("")))
    return (gone / F.lit(len(word))).cast("int")


def drop_parenthesis(c: Column) -> Column:
    """`Norte (zona 3)` -> `Norte`. Needs both brackets."""
    return F.regexp_replace(c, rf"(?s)^{_SPACE}*(?=.*\))([^(]*?){_SPACE}*\(.*$", "$1")


def single_line(c: Column, max_chars: int | None = None) -> Column:
    """One line without control or unprintable characters; on request at most `max_chars` long plus `...`."""
    flat = F.btrim(F.regexp_replace(F.coalesce(c, F.lit("")), _GAP, " "))
    return flat if max_chars is None else F.regexp_replace(flat, f"(?s)^(.{{{max_chars}}}).+$", "$1...")


def normalize_transcript(c: Column) -> Column:
    """Spaces for line breaks and tabs, single spaces, a space round every pipe, no empty pipes."""
    flat = F.translate(strip(F.coalesce(c, F.lit(""))), "\n\r\t", "   ")
    flat = F.regexp_replace(flat, " {2,}", " ")
    spaced = F.replace(flat, F.lit("|"), F.lit(" | "))
    return strip(F.regexp_replace(spaced, r" \|(?:  \|)+ ", " | "))


def matches_any(c: Column, words: tuple[str, ...]) -> Column:
    """True if the text holds one of the words, in any case. NULL counts as no."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.lower(c).rlike("|".join(re.escape(w.lower()) for w in words)), F.lit(False))
