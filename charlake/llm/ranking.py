"""Exact ranked search with a sparse ball tree: the documents of highest inner product with each item.

A document is a sparse vector: for each of its terms 1000000000 tf div (1000 tf + 12 m), where m grows with
its length. An item is a sparse vector too: its terms' weights, added up over repeats. The score is the
inner product, in 64-bit integers.

Tasks take their documents in blocks of `BLOCK_ROWS` rows (`BLOCK_TERMS` terms at most, unless one document has more)
and build a tree for each: a node's documents are cut at the median of how much nearer they are to one of two
documents far apart, down to `LEAF_ROWS`. A node knows its centroid c, its radius r and its radius s along each term (how far
above c a document lies there), so no document x below it scores more than q.c + min(|q| r, q.s) with an item q; the
second radius is what prunes where items have few of the many terms. Each item walks the tree best bound first and stops when the next
bound is below its `top`-th score so far, which goes on from block to block. Bounds are doubles rounded up by more
than their arithmetic can lose (`SLACK`), and scores at the leaves are integers, so the result is exact.

Only the terms of the items matter to an inner product, so vectors are cut down to them while the texts are read; both
sides are scaled by the square root of the terms' weights, which leaves products as they are and makes balls smaller.
Documents of equal vectors in a block are one point with their `top` smallest doc_ids. Items are taken
in blocks of `ITEM_CHARS` characters of text, each a pass over the documents; what a task holds is bounded by these
blocks, and it returns `top` rows an item, whatever the number of documents.

Terms are the runs of digits, letters A-Z (lower-cased) and all characters from U+0080. NULL text: no terms, so
never found. An item without terms, or whose terms no document has, gets no rows. Equal scores go by doc_id, NULL ones last; rows
of one doc_id are documents of their own, and so are items of one item_id. Empty tables give an empty result. Other
columns do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from charlake.llm.common import slices
from charlake.llm.registry import query, table
from charlake.operators.scratch import written

TOP = 20
BLOCK_ROWS, BLOCK_TERMS, LEAF_ROWS = 8_192, 4_000_000, 16
ITEM_CHARS = 4_000_000
# Bounds are raised by this share: sums of a million rounded products lose less.
SLACK = 1e-9

_TERM_BYTES = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_PLAIN = bytes(ord(" ") if b not in _TERM_BYTES else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Items:
    """A block of items as sparse vectors; terms are numbered in order of appearance."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.rows = [
            np.array([(self.number.setdefault(t, len(self.number)), n) for t, n in Counter(terms_of(text)).items()], np.int64).reshape(-1, 2) for text in texts
        ]

    def weighted(self, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each item its terms of weight above 0, and weight times repeats."""
        found = [(row[:, 0], row[:, 1] * weights[row[:, 0]]) for row in self.rows]
        return [(t[w > 0], w[w > 0]) for t, w in found]


def document_vectors(docs: DataFrame, number: dict[bytes, int], text: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), terms, tfs: of each document the terms that have a number, in order."""
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                sizes, ends, terms, tfs = [], [0], [], []
                for body in texts[a:b]:
                    words = terms_of(body)
                    found = sorted(Counter(filter(None.__ne__, map(known.get, words))).items())
                    sizes.append(len(words))
                    terms += [t for t, _ in found]
                    tfs += [n for _, n in found]
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((terms, pa.int32()), (tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def term_weights(vectors: DataFrame, n_terms: int, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) by term number; a number for each term of a block of items comes to the driver."""
    df = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    held = np.zeros(n_terms, np.int64)
    for row in df:
        held[row["t"]] = row["df"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in held], np.int64)


def length_factor(n: int | np.ndarray, n_docs: int, n_all: int) -> int | np.ndarray:
    """m: 75 and a quarter of the document's length in hundredths of the mean length."""
    return 75 + 25 * n * n_docs // n_all


class BallTree:
    """A block of sparse vectors (CSR: ends, terms, values) with centroid and radii of each node."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, scale: np.ndarray):
        """`values` are integers; distances are taken after multiplying by `scale` of the term."""
        self.ends, self.terms, self.values = ends, terms, values
        self.near = values * scale[terms]
        self.square = np.add.reduceat(np.append(self.near**2, 0.0), ends[:-1]) if len(ends) > 1 else np.zeros(0)
        self.n_terms = len(scale)
        # Of each node: centroid (terms, values, radii along them), radius, the two below it, or its rows at a leaf.
        self.centre: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.radius: list[float] = []
        self.below: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        if len(ends) > 1:
            self._grow(np.arange(len(ends) - 1))

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' terms, row by row, and where each row begins."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        starts = np.cumsum(sizes) - sizes
        return np.arange(int(sizes.sum())) + np.repeat(self.ends[rows] - starts, sizes), starts

    def _products(self, at: np.ndarray, starts: np.ndarray, vector: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.near[at] * vector[self.terms[at]], starts)

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.n_terms)
        part = slice(self.ends[row], self.ends[row + 1])
        out[self.terms[part]] = self.near[part]
        return out

    def _grow(self, rows: np.ndarray) -> int:
        at, starts = self.entries(rows)
        mean = np.bincount(self.terms[at], self.near[at], self.n_terms) / len(rows)
        square = self.square[rows]
        far = square - 2 * self._products(at, starts, mean) + mean @ mean
        most = np.zeros(self.n_terms)
        np.maximum.at(most, self.terms[at], self.near[at])
        some = np.flatnonzero(most)
        node = len(self.centre)
        self.centre.append((some, mean[some], most[some] - mean[some]))
        # Differences of near squares lose digits: what they may lose is added, so that the radius is never short.
        self.radius.append(math.sqrt(max(far.max(), 0.0) + 1e-9 * (square.max() + mean @ mean)))
        self.below.append(None)
        self.rows.append(rows)
        if len(rows) > LEAF_ROWS:
            one = int(rows[far.argmax()])
            first = self._products(at, starts, self._dense(one))
            other = int(rows[(square - 2 * first).argmax()])
            second = self._products(at, starts, self._dense(other))
            order = np.argsort((self.square[one] - 2 * first) - (self.square[other] - 2 * second), kind="stable")
            half = len(rows) // 2
            self.rows[node] = rows[:0]
            self.below[node] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return node

    def bound(self, node: int, vector: np.ndarray, norm: float) -> float:
        """No row below the node has a higher product with the scaled vector."""
        terms, values, along = self.centre[node]
        here = vector[terms]
        return (float(values @ here) + min(norm * self.radius[node], float(along @ here))) * (1 + SLACK) + 1.0

    def search(self, vector: np.ndarray, scaled: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores, leaf by leaf, best bound first. Send the score that still matters after each leaf."""
        norm = math.sqrt(float(scaled @ scaled)) * (1 + SLACK)
        heap = [(-self.bound(0, scaled, norm), 0)] if self.centre else []
        while heap and -heap[0][0] >= least:
            node = heapq.heappop(heap)[1]
            below = self.below[node]
            if below is None:
                rows = self.rows[node]
                at, starts = self.entries(rows)
                scores = np.add.reduceat(self.values[at] * vector[self.terms[at]], starts)
                least = yield rows, scores
            else:
                for child in below:
                    heapq.heappush(heap, (-self.bound(child, scaled, norm), child))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """ids, known (whether there is an id), n, ends, terms, tfs of blocks of rows with a term."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = terms = 0
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, BLOCK_TERMS):
            for c in range(a, b, BLOCK_ROWS):
                part = batch.slice(c, min(b, c + BLOCK_ROWS) - c)
                n_terms = int(sizes[c : c + part.num_rows].sum())
                if held and (rows + part.num_rows > BLOCK_ROWS or terms + n_terms > BLOCK_TERMS):
                    yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    held, rows, terms = [], 0, 0
                ids = part.column(0)
                held.append((
                    ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False),
                    sizes[c : c + part.num_rows], part.column(2).flatten().to_numpy(zero_copy_only=False), part.column(3).flatten().to_numpy(zero_copy_only=False),
                ))
                rows, terms = rows + part.num_rows, terms + n_terms
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _points(ids: np.ndarray, known: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, top: int):
    """Equal vectors as one: rows that stand for them, and for each its doc_ids in order (NULL ones last), `top` at most."""
    ends = np.append(0, np.cumsum(sizes))
    seen: dict[tuple, list[int]] = {}
    for row in range(len(ids)):
        a, b = ends[row], ends[row + 1]
        seen.setdefault((int(n[row]), terms[a:b].tobytes(), tfs[a:b].tobytes()), []).append(row)
    order = np.lexsort((ids, ~known))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    return [rows[0] for rows in seen.values()], [sorted(rows, key=place.__getitem__)[:top] for rows in seen.values()]


def best_of_tasks(vectors: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_all: int, top: int = TOP) -> DataFrame:
    """item (number), doc_id, score: for each item the best documents of each task, `top` at most."""
    sent = vectors.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = sent.value
        root = np.sqrt(np.maximum(weight, 1).astype(float))
        best: list[list[tuple]] = [[] for _ in queries]
        for ids, known, n, sizes, terms, tfs in _blocks(batches):
            first, members = _points(ids, known, n, sizes, terms, tfs, top)
            ends = np.append(0, np.cumsum(sizes))
            rows = np.array(first)
            at = np.arange(int(sizes[rows].sum())) + np.repeat(ends[rows] - (np.cumsum(sizes[rows]) - sizes[rows]), sizes[rows])
            m = np.repeat(length_factor(n[rows], n_docs, n_all), sizes[rows])
            values = 1_000_000_000 * tfs[at] // (1000 * tfs[at] + 12 * m)
            tree = BallTree(np.append(0, np.cumsum(sizes[rows])), terms[at], values, root)
            vector, scaled = np.zeros(len(weight), np.int64), np.zeros(len(weight))
            for number, (its, wanted) in enumerate(queries):
                if not len(its):
                    continue
                vector[its], scaled[its] = wanted, wanted / root[its]
                _search(tree, vector, scaled, best, number, members, ids, known, top)
                vector[its], scaled[its] = 0, 0.0
        found = [(i, row[2] if row[1] == 0 else None, -row[0]) for i, held in enumerate(best) for row in held]
        columns = zip(*found, strict=True) if found else ([], [], [])
        types = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item", "doc_id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(run, "item int, doc_id long, score long")


def _search(tree: BallTree, vector, scaled, best: list, number: int, members: list[list[int]], ids, known, top: int) -> None:
    """Carry the item's best (-score, no id, id) on through one block's tree."""
    held = best[number]
    walk = tree.search(vector, scaled, -held[-1][0] if len(held) == top else 1)
    try:
        rows, scores = next(walk)
        while True:
            least = -held[-1][0] if len(held) == top else 1
            good = np.flatnonzero(scores >= least)
            if len(good):
                new = [(-int(scores[g]), int(not known[r]), int(ids[r])) for g in good for r in members[rows[g]]]
                held = best[number] = sorted(held + new)[:top]
                least = -held[-1][0] if len(held) == top else 1
            rows, scores = walk.send(least)
    except StopIteration:
        return


def _item_blocks(items: DataFrame, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """Item numbers and texts, a block at a time."""
    block, size = [], 0
    for row in items.select("_item", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text")).toLocalIterator():
        block.append((row["_item"], bytes(row["_text"])))
        size += len(row["_text"])
        if size >= ITEM_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the documents of highest score above 0 for each item."""
    items = written(items.select("item_id", F.col(text).alias("text"), F.monotonically_increasing_id().alias("_item")), "search-items")
    parts = [_ranked(docs, block, text, top) for block in _item_blocks(items, "text")]
    if not parts:
        none = items.limit(0).select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
        return none
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.join(items, "_item").select("item_id", "rank", "doc_id", "score")


def _ranked(docs: DataFrame, block: list[tuple[int, bytes]], text: str, top: int) -> DataFrame:
    """_item, rank, doc_id, score of one block of items."""
    spark = docs.sparkSession
    items = Items([t for _, t in block])
    vectors = written(document_vectors(docs, items.number, text), "search-vectors")
    n_docs, n_all = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = term_weights(vectors, len(items.number), n_docs)
    found = best_of_tasks(vectors, items.weighted(weights), weights, n_docs, n_all or 1, top)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", place).where(F.col("rank") <= top)
    numbers = spark.createDataFrame(list(enumerate(i for i, _ in block)), "item int, _item long")
    return best.join(numbers, "item").select("_item", "rank", "doc_id", "score")


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS na FROM d),
i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ts FROM benchmark),
q AS (SELECT item, t, count(*) AS c FROM (SELECT item, unnest(ts) AS t FROM i) GROUP BY ALL),
o AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM o, s GROUP BY t, nd),
m AS (SELECT row, doc_id, 75 + (25 * len(ts) * nd) // na AS m FROM d, s),
r AS (SELECT item, row, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN o USING (t) JOIN w USING (t) JOIN m USING (row) GROUP BY ALL),
k AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank FROM r JOIN m USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k JOIN i USING (item) WHERE rank <= {TOP}
"""


@query("op13_ball_tree", _SQL)
def op13_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
