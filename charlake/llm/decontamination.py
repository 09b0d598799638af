"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are reduced to lower-case words with one blank between them. An item of m characters may be
met with up to k = m * ERROR_RATE edits. It is cut into k + 1 pieces: a passage with at most k edits keeps
one piece whole, so exact hits of the pieces (one automaton for all of them) find every such passage.
Around each hit Myers' bit-parallel distance tells whether the item is there, and where it ends.

The items are the stated query set. They are taken in blocks of bounded size; each block is sent to the
tasks and held against all documents, whole, where they lie. Nothing is shuffled and no pairs are made but
the matches themselves.

Items with fewer than `LEAST_CHARS` characters in words have no edits to spare: they are found as they are, as whole
words. Items without a word (NULL ones too) match nothing. NULL text: empty. NULL ids and equal rows are kept as they are. Empty tables give an empty result. Other
columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from charlake.llm.common import numbered, sendable, slices, unused
from charlake.llm.registry import query, table

ERROR_RATE = 0.08
LEAST_CHARS = 24
# Characters of the items that are looked for at a time: their automaton takes about 100 times as many bytes.
BLOCK_CHARS = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_FOUND = "doc_id long, item_id long, distance int, start long, end long"
_NAMES = ["doc_id", "item_id", "distance", "start", "end"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def budget(size: int, rate: float = ERROR_RATE) -> int:
    return int(size * rate)


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of about the same length, with their places."""
    n = errors + 1
    bounds = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """The least edit distance of the pattern to any passage of the text, and the end of the first such passage."""
    m = len(pattern)
    masks = peq(pattern) if masks is None else masks
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (~(x | plus) & full)
        down = plus & x
        score += bool(up & high) - bool(down & high)
        up = (up << 1) & full  # a passage may begin anywhere
        down = (down << 1) & full
        x = eq | minus
        plus, minus = down | (~(x | up) & full), up & x
        if score < best:
            best, end = score, at
    return best, end


def peq(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str  # normal form
    errors: int


class Searcher:
    """Finds the items of one block in normal texts."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        self.masks: dict[int, tuple[dict[str, int], dict[str, int]]] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, item in enumerate(items):
            for place, piece in cut(item.text, item.errors):
                places[piece].append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """The items in the text: number, distance, start and end of the best passage (the first of several)."""
        if not self.any:
            return []
        begins: dict[int, set[int]] = defaultdict(set)
        for end, (size, where) in self.automaton.iter(text):
            for number, place in where:
                begins[number].add(end + 1 - size - place)
        found = []
        for number, starts in begins.items():
            item = self.items[number]
            if len(item.text) < LEAST_CHARS:
                at = min((s for s in starts if _in_whole_words(text, s, s + len(item.text))), default=None)
                if at is not None:
                    found.append((number, 0, at, at + len(item.text)))
                continue
            exact = text.find(item.text) if any(text.startswith(item.text, s) for s in starts if s >= 0) else -1
            match = (0, exact, exact + len(item.text)) if exact >= 0 else self._near(text, number, sorted(starts))
            if match:
                found.append((number, *match))
        return found

    def _near(self, text: str, number: int, starts: list[int]) -> tuple[int, int, int] | None:
        item = self.items[number]
        if number not in self.masks:
            self.masks[number] = (peq(item.text), peq(item.text[::-1]))
        forward, backward = self.masks[number]
        windows: list[list[int]] = []
        for s in starts:
            a, b = max(0, s - item.errors), s + len(item.text) + item.errors
            if windows and a <= windows[-1][1]:
                windows[-1][1] = b
            else:
                windows.append([a, b])
        best: tuple[int, int, int] | None = None
        for a, b in windows:
            distance, end = myers(item.text, text[a:b], forward)
            if distance <= item.errors and (best is None or distance < best[0]):
                # The same passage from its end tells where it begins.
                low = max(0, a + end - len(item.text) - distance)
                _, size = myers(item.text[::-1], text[low : a + end][::-1], backward)
                best = (distance, a + end - size, a + end)
        return best


def _in_whole_words(text: str, start: int, end: int) -> bool:
    return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of the original text that a passage of its normal form covers, in whole words."""
    at, first, last = 0, None, 0
    for word in _WORD.finditer(text.lower() if len(text.lower()) == len(text) else text):
        size = len(word[0])
        if at + size > start and first is None:
            first = word.start()
        if at < end:
            last = word.end()
        at += size + 1
        if at >= end:
            break
    return (first or 0, last)


def items_in_blocks(benchmark: DataFrame, text: str = "text", rate: float = ERROR_RATE) -> Iterator[list[Item]]:
    """The items in normal form, a bounded number of characters at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col(text).alias("text")).where(F.col(text).isNotNull()).toLocalIterator():
        item = normal(row["text"])
        if item:
            block.append(Item(row["item_id"], item, budget(len(item), rate) if len(item) >= LEAST_CHARS else 0))
            size += len(item)
            if size >= BLOCK_CHARS:
                yield block
                block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, start, end: each document with each item in it, and where the best passage is."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = [rows.mapInArrow(_search(block), _FOUND) for block in items_in_blocks(benchmark, rate=rate)]
    return reduce(DataFrame.unionByName, found) if found else rows.sparkSession.createDataFrame([], _FOUND)


def _search(items: list[Item]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                out = []
                for doc_id, text in zip(ids[a:b], texts[a:b], strict=True):
                    for number, distance, start, end in searcher.find(normal(text)):
                        out.append((doc_id, items[number].item_id, distance, *_original(text, start, end)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES)

    return run


def clean_of(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any item, each told apart by a row number of its own."""
    (row,) = unused(docs, "_row")
    rows = numbered(docs, "decontamination-docs", row)
    found = contaminated(rows.select(F.col(row).alias("doc_id"), "text"), benchmark)
    found = sendable(found.select(F.col("doc_id").alias(row)).distinct(), "contaminated")
    return rows.join(found, row, "left_anti").select(*docs.columns)


@query("op3_edit_matching")
def op3_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
