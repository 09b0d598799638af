"""Phrase mining by best-first branch and bound: the best collocations of each language, settled exactly.

A phrase grows from its prefix by one word, and no phrase is more frequent than a part of it. So counts of
prefixes bound what can grow from them:

* words counted fewer than `LEAST` times begin and end nothing;
* the pair (x, y), counted b times, grows into phrases of at most b; cut after x their score is at most
  b / f(x), and cut before the last word y of a longer phrase at most b / f(y).

Pairs of frequent words are counted all. Phrases of three words are grown best first: each round takes the part of
every open language's frontier whose bounds reach a score, and the phrases that could drop a pair of that
score, counts them exactly, and drops what a longer phrase covers. A language is settled when `TOP` phrases
at or above that score survive, for what was not grown is below it, ties included; else the next round goes
on to a lower score, down to 0.

The corpus is never joined with the frontier. A task looks words and pairs up in a table of flags by hash, which is
sized by the counted frontier and never above `MOST_SLOTS` bytes; keys that meet in a slot only cause
counts that the exact join throws away afterwards, so a full table costs time, not results. Tasks add up what
they count in slices of `SLICE` bytes before it is shuffled, so a word in every line is a few rows. Pairs are counted
by hash first, and by their words only where the hash was counted `LEAST` times.

Texts are lower-cased in A-Z, cut into pieces at . , ; : ! ? and line ends, and into words at blanks and tabs.
NULL text: empty. NULL lang: `und`. doc_id is not used; repeated rows count as often as they stand there. Ties in score
and count go by the phrase's bytes. A piece is taken whole, however long. An empty table gives an empty
result. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from charlake.llm.registry import query, table
from charlake.operators.scratch import written

LEAST = 10
TOP = 2_000
# A longer phrase with this share of a phrase's occurrences drops it.
COVERED = 50
# The first round goes down to the score of the pair of this rank, each further one to that of a rank so many times higher.
FIRST_RANK, NEXT_RANK = 3_000, 4
# Bytes of text a task counts at a time.
SLICE = 8_000_000
# Slots of the flag table: so many a key, within these bounds (powers of two).
SLOTS_A_KEY, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 16, 1 << 27
KNOWN, PREFIX, SUFFIX, HELD = 1, 2, 4, 8

_BREAKS = b".,;:!?\n\x0b\x0c\r"
# No UTF-8 text has this byte; it stands where a piece ends.
_END = b"\xff"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _BREAKS, bytes(range(97, 123)) + _END * len(_BREAKS))

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64)


def pair_hashes(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(first * _A + lang) + second * _B)


class Flags:
    """A table of flags by hash, sent to all tasks."""

    def __init__(self, spark: SparkSession, keys: DataFrame, count: int):
        """`keys` has columns hash (long) and flags (int); `count` of them, counted before."""
        slots = LEAST_SLOTS
        while slots < min(count * SLOTS_A_KEY, MOST_SLOTS):
            slots *= 2
        self.mask = slots - 1
        # Eight slots to a row, so that a full table is slots / 8 rows.
        slot = F.col("hash").bitwiseAND(F.lit(self.mask))
        rows = keys.select(F.shiftright(slot, 3).alias("at"), F.shiftleft(F.col("flags").cast("long"), 0).alias("flags"), (slot % 8).cast("int").alias("place"))
        packed = [F.bit_or(F.when(F.col("place") == i, F.col("flags")).otherwise(F.lit(0).cast("long"))).cast("byte").alias(f"b{i}") for i in range(8)]
        found = rows.groupBy("at").agg(*packed).toArrow()
        array = np.zeros((slots // 8, 8), np.uint8)
        if found.num_rows:
            array[found.column("at").to_numpy()] = np.column_stack([found.column(f"b{i}").to_numpy() for i in range(8)]).astype(np.uint8)
        self.sent = spark.sparkContext.broadcast(array.reshape(-1))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.sent.value[(hashes & np.uint64(self.mask)).astype(np.int64)]


class _Words(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[bytes]]]:
    """Language and texts (plain, with marked piece ends) of about SLICE bytes; a longer text is cut at piece ends."""
    held: dict[bytes, list[bytes]] = {}
    sizes: dict[bytes, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text.translate(_PLAIN)
            start = 0
            while start < len(text):
                end = len(text) if len(text) - start <= SLICE else (text.find(_END, start + SLICE) + 1 or len(text))
                held.setdefault(lang, []).append(text[start:end])
                sizes[lang] = sizes.get(lang, 0) + end - start
                start = end
            if sum(sizes.values()) >= SLICE:
                yield from held.items()
                held, sizes = {}, {}
    yield from held.items()


class Slice:
    """The words of some texts of a language: numbers in `ids`, -1 at piece ends."""

    def __init__(self, lang: bytes, texts: list[bytes]):
        self.lang = lang
        numbers = _Words({_END: -1})
        tokens = (_END + b" " + b" \xff ".join(texts).replace(_END, b" \xff ")).split()
        numbers_of = numbers.__getitem__
        self.ids = np.fromiter(map(numbers_of, tokens), np.int64, len(tokens))
        del numbers[_END]
        # Numbers begin at 1, for the mark was there first.
        self.ids -= self.ids > 0
        self.words = list(numbers)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.words)

    def pair_hashes(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        lang = np.array([xxhash.xxh3_64_intdigest(self.lang)], np.uint64)
        return pair_hashes(lang, hashes[self.ids[at]], hashes[self.ids[at + 1]])

    def pairs(self, good: np.ndarray) -> np.ndarray:
        """Places where two words stand side by side in a piece, both of them good."""
        ok = np.zeros(len(self.ids) + 1, bool)
        ok[:-1] = (self.ids >= 0) & good[self.ids]
        return np.flatnonzero(ok[:-1] & ok[1:])

    def table(self, places: np.ndarray, size: int) -> tuple[list[pa.Array], np.ndarray]:
        """The different phrases of `size` words at these places, a column for each word, and their counts."""
        v = max(len(self.words), 1)
        code = self.ids[places]
        for i in range(1, size):
            if i == 2:  # three numbers may not fit into 64 bits: number the pairs first
                pairs, code = np.unique(code, return_inverse=True)
            code = code * v + self.ids[places + i]
        code, counts = np.unique(code, return_counts=True)
        numbers = [code % v]
        if size == 2:
            numbers.insert(0, code // v)
        elif size == 3:
            pair = pairs[code // v] if len(code) else code
            numbers = [pair // v, pair % v, *numbers]
        words = pa.array(self.words, pa.binary())
        return [words.take(pa.array(n)) for n in numbers], counts

    def frame(self, columns: list[pa.Array], counts: np.ndarray, names: list[str]) -> pa.RecordBatch:
        lang = pa.repeat(pa.scalar(self.lang, pa.binary()), len(counts))
        return pa.RecordBatch.from_arrays([lang, *columns, pa.array(counts.astype(np.int64))], ["lang", *names, "f"])


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    ).where(F.octet_length("text") > 0)


def _summed(counts: DataFrame, names: list[str]) -> DataFrame:
    """Counts of tasks added up, words as texts."""
    keys = ["lang", *names]
    return counts.groupBy(*keys).agg(F.sum("f").alias("f")).select(*[F.col(k).cast("string").alias(k) for k in keys], "f")


def count_words(texts: DataFrame) -> DataFrame:
    """lang, w1, f of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _slices(batches):
            part = Slice(lang, held)
            counts = np.bincount(part.ids[part.ids >= 0], minlength=len(part.words))
            yield part.frame([pa.array(part.words, pa.binary())], counts, ["w1"])

    return _summed(texts.mapInArrow(run, "lang binary, w1 binary, f long"), ["w1"])


def count_pair_hashes(texts: DataFrame, words: Flags) -> DataFrame:
    """hash, f of the pairs of frequent words; pairs whose hashes are equal are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _slices(batches):
            part = Slice(lang, held)
            hashes = part.hashes()
            at = part.pairs(_good(part, hashes, words))
            found, counts = np.unique(part.pair_hashes(hashes, at), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["hash", "f"])

    return texts.mapInArrow(run, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))


def _good(part: Slice, hashes: np.ndarray, words: Flags) -> np.ndarray:
    """By word number, whether the word is frequent in its language; one more for piece ends."""
    return np.append(words.of(_mixed(hashes + np.array([xxhash.xxh3_64_intdigest(part.lang)], np.uint64) * _C)) > 0, False)


def count_pairs(texts: DataFrame, words: Flags, pairs: Flags) -> DataFrame:
    """lang, w1, w2, f of the pairs of frequent words whose hash has a flag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _slices(batches):
            part = Slice(lang, held)
            hashes = part.hashes()
            at = part.pairs(_good(part, hashes, words))
            at = at[pairs.of(part.pair_hashes(hashes, at)) > 0]
            yield part.frame(*part.table(at, 2), ["w1", "w2"])

    return _summed(texts.mapInArrow(run, "lang binary, w1 binary, w2 binary, f long"), ["w1", "w2"])


def count_triples(texts: DataFrame, words: Flags, pairs: Flags) -> DataFrame:
    """lang, w1, w2, w3, f of phrases whose pairs are both known, if they can reach the round's score or cover a pair that does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _slices(batches):
            part = Slice(lang, held)
            hashes = part.hashes()
            at = part.pairs(_good(part, hashes, words))
            flags = np.zeros(len(part.ids) + 1, np.uint8)
            flags[at] = pairs.of(part.pair_hashes(hashes, at))
            first, second = flags[at], flags[at + 1]
            reach = (first & PREFIX > 0) & (second & SUFFIX > 0)
            covers = (first | second) & HELD > 0
            at = at[(first & second & KNOWN > 0) & (reach | covers)]
            yield part.frame(*part.table(at, 3), ["w1", "w2", "w3"])

    return _summed(texts.mapInArrow(run, "lang binary, w1 binary, w2 binary, w3 binary, f long"), ["w1", "w2", "w3"])


def _hashed(rows: DataFrame, names: list[str]) -> DataFrame:
    """hash, flags for rows of words (one or two) and flags; hashes as the tasks make them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [xxhash.xxh3_64_intdigest(x) for x in batch.column(0).to_pylist()]
            lang = np.array(langs, np.uint64)
            words = [word_hashes(batch.column(i + 1).to_pylist()) for i in range(len(names))]
            found = _mixed(words[0] + lang * _C) if len(words) == 1 else pair_hashes(lang, *words)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), batch.column(len(names) + 1)], ["hash", "flags"])

    keys = [F.col(c).cast("binary").alias(c) for c in ("lang", *names)]
    return rows.select(*keys, F.col("flags").cast("int").alias("flags")).mapInArrow(run, "hash long, flags int")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exactly, for counts below 10^15."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def _bound(part: str) -> Column:
    """The highest score of a phrase that grows from the pair, by the count of its word that is a part of the cut."""
    return F.call_function("div", F.col("f").cast("decimal(15,0)") * F.lit(1_000_000).cast("decimal(7,0)"), F.col(part).cast("decimal(15,0)"))


def _with_bounds(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """lang, w1, w2, f, f1, f2 (the words' counts), score."""
    first = words.select("lang", "w1", F.col("f").alias("f1"))
    second = words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("f2"))
    rows = pairs.where(F.col("f") >= LEAST).join(first, ["lang", "w1"]).join(second, ["lang", "w2"])
    return rows.withColumn("score", _score(F.col("f"), F.col("f1"), F.col("f2")))


def _levels(pairs: DataFrame, rank: int) -> DataFrame:
    """lang, level: the score of the language's pair of this rank, 0 if it has fewer. A language has at most 1,000,001 different scores."""
    counts = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    found = counts.withColumn("upto", before).groupBy("lang").agg(F.max(F.when(F.col("upto") >= rank, F.col("score"))).alias("level"))
    return found.select("lang", F.coalesce("level", F.lit(0).cast("long")).alias("level"))


def _survivors(pairs: DataFrame, triples: DataFrame, levels: DataFrame) -> DataFrame:
    """lang, level, phrase, a, l, r, score of the candidates at or above their language's level that no longer one covers."""
    head = pairs.select("lang", "w1", "w2", F.col("f").alias("f12"), "f1", F.col("score").alias("s12"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"), F.col("f2").alias("f3"), F.col("score").alias("s23"))
    triples = triples.where(F.col("f") >= LEAST).join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    triples = written(triples, "phrases-of-three")
    one, two = _score(F.col("f"), F.col("f1"), F.col("f23")), _score(F.col("f"), F.col("f12"), F.col("f3"))
    rows = triples.withColumn("one", one).withColumn("two", two)
    early = F.col("one") <= F.col("two")
    threes = rows.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("one", "two").alias("score"),
    )
    covered = [
        triples.where(100 * F.col("f") >= COVERED * F.col(count)).select("lang", F.col(x).alias("w1"), F.col(y).alias("w2"))
        for x, y, count in (("w1", "w2", "f12"), ("w2", "w3", "f23"))
    ]
    kept = pairs.join(covered[0].union(covered[1]).distinct(), ["lang", "w1", "w2"], "left_anti")
    twos = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), "score")
    return twos.unionByName(threes).join(levels, "lang").where("score >= level")


def mined(docs: DataFrame, text: str = "text") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the first TOP phrases of each language."""
    spark = docs.sparkSession
    texts = _texts(docs, text)
    words = written(count_words(texts), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= LEAST)
    good = Flags(spark, _hashed(frequent.withColumn("flags", F.lit(KNOWN)), ["w1"]), frequent.count())
    hashes = written(count_pair_hashes(texts, good).where(F.col("f") >= LEAST).select("hash", F.lit(KNOWN).alias("flags")), "phrase-hashes")
    known = Flags(spark, hashes, hashes.count())
    pairs = written(_with_bounds(count_pairs(texts, good, known), frequent), "phrase-pairs")

    settled, open_, rank = None, pairs, FIRST_RANK
    while settled is None or open_.limit(1).count():
        levels = written(_levels(open_, rank), "phrase-levels")
        rows = open_.join(levels, "lang")
        reached = {PREFIX: _bound("f1"), SUFFIX: _bound("f2"), HELD: F.col("score")}
        flags = F.lit(KNOWN)
        for flag, bound in reached.items():
            flags = flags + F.when(bound >= F.col("level"), flag).otherwise(0)
        frontier = Flags(spark, _hashed(rows.withColumn("flags", flags), ["w1", "w2"]), open_.count())
        # Languages that are settled have no pair in the frontier, so nothing of theirs is counted but what shares a slot.
        found = written(_survivors(open_, count_triples(texts, good, frontier), levels), "phrase-survivors")
        counts = levels.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "left")
        done = counts.where((F.col("level") == 0) | (F.coalesce("n", F.lit(0)) >= TOP)).select("lang")
        best = found.join(done, "lang", "left_semi")
        settled = best if settled is None else settled.union(best)
        open_ = written(open_.join(done, "lang", "left_anti"), "phrase-open")
        rank *= NEXT_RANK

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = settled.withColumn("place", place).where(F.col("place") <= TOP)
    return top.join(totals, "lang").select("lang", F.col("place").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
o AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
u AS (SELECT lang, ws[i] AS x, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM u GROUP BY lang),
b AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, count(*) AS f FROM o WHERE i < len(ws) GROUP BY ALL HAVING count(*) >= {LEAST}),
t AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, count(*) AS f FROM o WHERE i + 1 < len(ws) GROUP BY ALL HAVING count(*) >= {LEAST}),
b2 AS (SELECT b.lang, b.x, b.y, b.f AS a, u.f AS l, v.f AS r FROM b JOIN u ON u.lang = b.lang AND u.x = b.x JOIN u v ON v.lang = b.lang AND v.x = b.y),
t2 AS (SELECT t.*, u.f AS l1, q.f AS r1, p.f AS l2, v.f AS r2, (1000000 * t.f::HUGEINT * t.f) // (u.f::HUGEINT * q.f) AS s1, (1000000 * t.f::HUGEINT * t.f) // (p.f::HUGEINT * v.f) AS s2
  FROM t JOIN u ON u.lang = t.lang AND u.x = t.x JOIN u v ON v.lang = t.lang AND v.x = t.z
  JOIN b p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN b q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z),
g AS (SELECT lang, x, y, f FROM t UNION ALL SELECT lang, y, z, f FROM t),
m AS (SELECT lang, x, y, max(f) AS f FROM g GROUP BY ALL),
c AS (SELECT b2.lang, b2.x || ' ' || b2.y AS phrase, a, l, r, ((1000000 * a::HUGEINT * a) // (l::HUGEINT * r))::BIGINT AS score FROM b2 LEFT JOIN m ON m.lang = b2.lang AND m.x = b2.x AND m.y = b2.y
  WHERE m.f IS NULL OR 100 * m.f < {COVERED} * a
  UNION ALL SELECT lang, x || ' ' || y || ' ' || z, f, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)::BIGINT FROM t2),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank FROM c)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang) WHERE rank <= {TOP}
"""


@query("op11_phrases", _SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "documents"))
