"""Line-first cleaning: rules decide on each line, failing lines go, and documents that lose too much text are rejected.

A line with a word fails if it has no sentence mark at all, is a row of menu entries, is full of signs,
shouts, says the same word over and over, or is a short line of site boilerplate. A document is
rejected if it has fewer than 10 words or too many words in repeated 5-word windows (the base rules), or
if more than three fifths of its characters in words stood in failing lines. Rows are worked on where they lie;
nothing is shuffled, and whole texts are read.

NULL text: no words, so rejected. NULL doc_id and equal rows: kept as they are. An empty table gives
an empty result. Columns of the input named like one of the results are replaced, others stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from charlake.llm.common import slices, unused
from charlake.llm.registry import query, table

# Fixed values of the rules.
MIN_WORDS = 10
WINDOW = 5
REPEATED_PERCENT = 20
LOST_PERCENT = 60
BOILERPLATE_WORDS = 25
SIGNS = "#*$%&|<>"
MENU_SIGNS = "|»›·•>"
SENTENCE_MARKS = ".!?…。！？"
BOILERPLATE = (
    "all rights reserved|terms of (?:use|service)|privacy policy|cookie|enable javascript|javascript is disabled|"
    "click here|read more|subscribe to|sign up|log ?in to|share (?:this|on)|back to top|powered by|copyright|"
    "licensed under|released under the|alle rechte vorbehalten|datenschutz|tous droits réservés|mentions légales|"
    "todos los derechos reservados|política de privacidad"
)

_NO_SIGNS = {ord(c): None for c in SIGNS}
_NO_MENU = {ord(c): None for c in MENU_SIGNS}
_MARK = re.compile(f"[{SENTENCE_MARKS}]")
_BOILERPLATE = re.compile(BOILERPLATE)
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))

_SCHEMA = (
    "_n_words long, _word_chars long, _n_symbols long, _n_dup_lines long, _n_repeat_words long, _lost_chars long, _lines_removed long, _cleaned string"
)
_RESULTS = tuple(f.split()[0].removeprefix("_") for f in _SCHEMA.split(", "))


def line_fails(line: str, words: list[bytes]) -> bool:
    """Whether a line with words fails one of the rules."""
    n = len(words)
    raw = line.encode(errors="surrogatepass")
    menu = len(line) - len(line.translate(_NO_MENU))
    signs = len(line) - len(line.translate(_NO_SIGNS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    lower = len(raw) - len(raw.translate(None, _LOWER))
    return (
        not _MARK.search(line)
        or (menu >= 2 and menu * 5 >= n)
        or (signs >= 3 and signs * 10 >= n * 3)
        or line.count("!!") * 10 >= n * 3
        or (n >= 5 and upper * 10 > (upper + lower) * 6)
        or (n >= 5 and sum(map(bytes.__eq__, words, words[1:])) * 10 >= n * 4)
        or (n <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()) is not None)
    )


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text the words that stand in a 5-word window found twice or more in that text."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(sizes.sum(), object)
    flat[:] = [w for ws in words for w in ws]
    text = np.repeat(np.arange(len(words)), sizes)
    out = np.zeros(len(words), np.int64)
    if len(flat) < WINDOW:
        return out
    code = pd.factorize(flat)[0].astype(np.uint64)
    key = (text[: len(flat) - WINDOW + 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(WINDOW):  # exact but for 64-bit collisions
        key = (key ^ code[i : len(code) - WINDOW + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    inside = np.flatnonzero(text[: len(key)] == text[WINDOW - 1 :])  # windows do not cross texts
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(flat) + 1, np.int64)
    starts = order[twice]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    np.add.at(out, text, np.cumsum(edge[:-1]) > 0)
    return out


def _rows(texts: list[str]) -> pd.DataFrame:
    rows, words = [], []
    for text in texts:
        lines = text.split("\n")
        own, kept, seen = [], [], set()
        chars = lost = removed = duplicates = 0
        for line in lines:
            found = line.encode(errors="surrogatepass").split()  # splits at the six ASCII blanks only
            own += found
            if found:
                duplicates += line in seen
                seen.add(line)
                size = len(line) - sum(map(line.count, " \t\x0b\x0c\r"))
                chars += size
                if line_fails(line, found):
                    lost, removed = lost + size, removed + 1
                    continue
            kept.append(line)
        words.append(own)
        rows.append((len(own), chars, len(text) - len(text.translate(_NO_SIGNS)), duplicates, 0, lost, removed, "\n".join(kept)))
    frame = pd.DataFrame(rows, columns=[f.split()[0] for f in _SCHEMA.split(", ")])
    frame["_n_repeat_words"] = repeated_words(words)
    return frame


def with_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, lines_removed, base_failed, kept, cleaned."""
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    docs = docs.drop(*[c for c in (*_RESULTS, "base_failed", "kept") if c != text])
    at = docs.columns.index(text)
    inner = unused(docs, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for a, b in slices([len(t) for t in texts]):
                fresh = pa.RecordBatch.from_pandas(_rows(texts[a:b]), preserve_index=False)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *fresh.columns], [*batch.schema.names, *inner])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{i} {f.split()[1]}" for i, f in zip(inner, _SCHEMA.split(", "), strict=True))])
    rows = docs.mapInArrow(run, schema).withColumnsRenamed({i: n.removeprefix("_") for i, n in zip(inner, names, strict=True)})
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_chars") * 100 <= F.col("word_chars") * LOST_PERCENT)
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """The columns of `docs` for the documents kept, with the cleaned text and its length. Names of other columns may be any."""
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    kept = with_quality(docs.withColumnsRenamed(own)).where("kept").withColumn("text", F.col("cleaned"))
    columns = [F.col(own.get(c, c)).alias(c) for c in docs.columns if c != "n_chars"]
    if "n_chars" in docs.columns:
        columns.append(F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    return kept.select(*columns).select(*docs.columns)


_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "lines_removed")

# Words and lines of every text, then the rules as above.
SQL_ROWS = f"""
d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - {WINDOW - 2})) AS i, unnest(list_transform(range(1, len(words) - {WINDOW - 2}), lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' '))) AS win FROM d),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS no, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS ws, row_number() OVER (PARTITION BY doc_id, line ORDER BY no) AS nth,
  length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS size,
  length(line) - length(regexp_replace(line, '[{MENU_SIGNS}]', '', 'g')) AS menu, length(line) - length(regexp_replace(line, '[{SIGNS}]', '', 'g')) AS signs,
  length(line) - length(regexp_replace(line, '[A-Z]', '', 'g')) AS up, length(line) - length(regexp_replace(line, '[a-z]', '', 'g')) AS low FROM l),
f AS (SELECT *, len(ws) > 0 AND (NOT regexp_matches(line, '[{SENTENCE_MARKS}]') OR (menu >= 2 AND menu * 5 >= len(ws)) OR (signs >= 3 AND signs * 10 >= len(ws) * 3)
  OR len(regexp_extract_all(line, '!!')) * 10 >= len(ws) * 3 OR (len(ws) >= 5 AND up * 10 > (up + low) * 6)
  OR (len(ws) >= 5 AND list_sum(list_transform(range(1, len(ws)), lambda i: (ws[i] = ws[i + 1])::INT)) * 10 >= len(ws) * 4)
  OR (len(ws) <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{BOILERPLATE}'))) AS fails FROM m),
s AS (SELECT doc_id, sum(size) AS word_chars, count(*) FILTER (len(ws) > 0 AND nth > 1) AS n_dup_lines, coalesce(sum(size) FILTER (fails), 0) AS lost_chars,
  count(*) FILTER (fails) AS lines_removed, string_agg(line, chr(10) ORDER BY no) FILTER (NOT fails) AS cleaned FROM f GROUP BY doc_id),
q AS (SELECT d.doc_id, len(words) AS n_words, word_chars, length(text) - length(regexp_replace(text, '[{SIGNS}]', '', 'g')) AS n_symbols, n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, lost_chars, lines_removed, cleaned,
  len(words) < {MIN_WORDS} OR coalesce(n_repeat_words, 0) * 100 > len(words) * {REPEATED_PERCENT} AS base_failed FROM d JOIN s USING (doc_id) LEFT JOIN r USING (doc_id))
"""
_SQL = f"""WITH {SQL_ROWS}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND lost_chars * 100 <= word_chars * {LOST_PERCENT} AS kept,
  lost_chars::BIGINT AS lost_chars, lines_removed::BIGINT AS lines_removed
FROM q"""


@query("op6_line_quality", _SQL)
def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*_COLUMNS)
