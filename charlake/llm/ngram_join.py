"""Similarity join on word 5-grams: MinHash values compared a few at a time, hopeless pairs dropped, the rest counted exactly.

Equal texts are one class of copies and are worked on once. A text's MinHash values are hashed in bands, and
texts that share a band meet in a bucket. Two texts of a bucket are compared 16 values at a time: with m of n values
equal, the similarity has a Beta(m + 1, n - m + 1) posterior (uniform prior), and the pair is dropped as soon
as its chance of reaching the threshold is below `TOLERANCE`. Texts joined by pairs that stay form
candidate groups, inside which every pair's Jaccard similarity is counted exactly on the sets of 5-grams.

Buckets and groups are cut into blocks of bounded size, and tasks take pairs of blocks, so a group of any size
is spread over tasks. A task returns what it counted for each text and a spanning forest of its links, never the
pairs; groups are joined by distributed union-find.

Words are runs of other than the six ASCII blanks. A text of one to four words is one shorter n-gram;
NULL, empty and blank texts have none, so they have no links, though equal ones are copies of each
other (NULL counts as empty). NULL doc_id: kept; a class is named by its smallest doc_id, NULL if it has
none. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.llm.common import components, numbered, same_rows, sendable, slices, unused, whole_groups
from charlake.llm.registry import query, table
from charlake.operators.scratch import written

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-5
# Texts of a block; a task compares two blocks at most.
BUCKET_BLOCK, GROUP_BLOCK = 512, 256
_COLUMNS_AT_A_TIME = 8_192

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _seeds(n: int, odd: bool) -> np.ndarray:
    values = np.random.default_rng(8).integers(1, 1 << 63, n, dtype=np.uint64)
    return values | np.uint64(1) if odd else values


_FACTORS = _seeds(HASHES, True)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def ngram_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word 5-grams of all texts, text by text in order, and where each text's begin (and the end)."""
    words = [t.encode(errors="surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    codes, distinct = pd.factorize(flat)
    hashes = pd.util.hash_array(distinct, categorize=False)[codes] if len(flat) else np.zeros(0, np.uint64)
    # A text of fewer than five words is padded, so each non-empty text has at least one 5-gram.
    padded = np.maximum(sizes, np.where(sizes > 0, WORDS, 0))
    ends = np.cumsum(padded)
    place = np.arange(len(flat)) + np.repeat(ends - padded - np.cumsum(sizes) + sizes, sizes)
    row = np.full(int(padded.sum()), np.uint64(0x5BD1E995))
    row[place] = hashes
    grams = np.maximum(padded - WORDS + 1, 0)
    text = np.repeat(np.arange(len(texts)), grams)
    starts = np.arange(len(text)) + np.repeat(ends - padded - np.cumsum(grams) + grams, grams)
    key = np.zeros(len(text), np.uint64)
    for i in range(WORDS):
        key = _scrambled(key + row[starts + i] + np.uint64(i))
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    key, text = key[first], text[first]
    return key, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (texts x HASHES, 32 bits); rows of texts without n-grams are not meaningful."""
    out = np.zeros((len(bounds) - 1, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for h in range(HASHES):
            values = ((grams ^ _FACTORS[-1 - h]) * _FACTORS[h]) >> np.uint64(32)
            out[some, h] = np.minimum.reduceat(values.astype(np.uint32), bounds[some])
    return out


def least_equal(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values, the fewest equal ones with which a pair may still reach the threshold.

    The posterior's upper tail P(J >= t | m of n) is the chance that a binomial of n + 1 trials with chance t is at most m.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out[n] = m
    return out


_LEAST_EQUAL = least_equal()


def hopeful(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) of signature rows stay after the comparison by steps."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        equal = equal + (sig[a[alive], n - STEP : n] == sig[b[alive], n - STEP : n]).sum(axis=1)
        stay = equal >= _LEAST_EQUAL[n]
        alive, equal = alive[stay], equal[stay]
    return alive


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (a, b) between n things, some that connect the same things, fewer than n."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def exact_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Boolean matrix left x right of set pairs with |A and B| * 5 >= |A or B| * 4; sets are sorted and distinct."""
    sizes = np.array([len(s) for s in sets], np.int64)
    member = np.repeat(np.arange(len(sets)), sizes)
    values, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[where] > 1  # an n-gram of one text alone is in no intersection
    column = (np.cumsum(counts > 1) - 1)[where[shared]]
    member = member[shared]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    both = np.zeros((len(left), len(right)), np.float32)
    n = int(column[-1]) + 1 if len(column) else 0
    for c in range(0, n, _COLUMNS_AT_A_TIME):
        lo, hi = np.searchsorted(column, (c, c + _COLUMNS_AT_A_TIME))
        present = np.zeros((len(sets), min(_COLUMNS_AT_A_TIME, n - c)), np.float32)
        present[member[lo:hi], column[lo:hi] - c] = 1
        both += present[left] @ present[right].T
    either = sizes[left][:, None] + sizes[right][None, :] - both
    return (both * 5 >= either * 4) & (both > 0)


def text_key(text: Column) -> Column:
    """The number of a text; equal texts have equal numbers (64 bits: two different ones meet about once in 10^19 pairs)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in slices([len(t) for t in texts]):
            grams, bounds = ngram_sets(texts[a:b])
            some = np.flatnonzero(np.diff(bounds))
            sig = signatures(grams, bounds)[some]
            bands = np.zeros((len(some), BANDS), np.uint64)
            for i in range(ROWS):
                bands = _scrambled(bands + sig[:, i::ROWS].astype(np.uint64) + np.arange(BANDS, dtype=np.uint64) * _MIX)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.astype(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a).take(pa.array(some)), keys, pa.array([s.tobytes() for s in sig], pa.binary())], ["node", "bands", "sig"]
            )


def _in_blocks(rows: DataFrame, key: str, size: Column, block: int) -> DataFrame:
    """The rows for each pair of blocks (_i <= _j) of their group that theirs is in; _mine tells which of the two it is."""
    blocks = F.ceil(size / F.lit(block)).cast("int")
    rows = rows.withColumn("_n", blocks).withColumn("_mine", F.pmod(F.xxhash64(F.col("node"), F.lit(7)), F.col("_n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    rows = rows.select(*[c for c in rows.columns if c != "_n"], other.alias("_other"))
    rows = rows.withColumns({"_i": F.least("_mine", "_other"), "_j": F.greatest("_mine", "_other")}).drop("_other")
    return rows.repartition(F.col(key), "_i", "_j").sortWithinPartitions(key, "_i", "_j", "node")


def _group_pairs(starts: np.ndarray, mine: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each group of rows (its start, then the rows paired): all pairs of one block, or all across two blocks."""
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if i[a] == j[a]:
            x, y = np.triu_indices(b - a, 1)
        else:
            left, right = np.flatnonzero(mine[a:b] == i[a]), np.flatnonzero(mine[a:b] == j[a])
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        yield a, x + a, y + a


def _candidate_edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in whole_groups(frames, ["key", "_i", "_j"]):
        node = frame["node"].to_numpy()
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(-1, HASHES)
        starts = same_rows(frame, ["key", "_i", "_j"])
        found, held = [], []

        def flush() -> None:
            if held:
                x, y = (np.concatenate(c) for c in zip(*held, strict=True))
                stay = hopeful(sig, x, y)
                found.extend(forest(len(node), x[stay], y[stay]))
                held.clear()

        size = 0
        for _, x, y in _group_pairs(starts, frame["_mine"].to_numpy(), frame["_i"].to_numpy(), frame["_j"].to_numpy()):
            held.append((x, y))
            size += len(x)
            if size > 200_000:
                flush()
                size = 0
        flush()
        if found:
            at = np.array(found)
            yield pd.DataFrame({"a": node[at[:, 0]], "b": node[at[:, 1]]})


def _ngram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in slices([len(t) for t in texts]):
            grams, bounds = ngram_sets(texts[a:b])
            sets = [grams[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.binary())], ["node", "grams"])


def _counted_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys = ["root", "_i", "_j"]
    for frame in whole_groups(frames, keys):
        node, mine, i, j = (frame[c].to_numpy() for c in ("node", "_mine", "_i", "_j"))
        sets = [np.frombuffer(g, np.uint64) for g in frame["grams"]]
        links = np.zeros(len(node), np.int64)
        edges: list[tuple[int, int]] = []
        starts = same_rows(frame, keys)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            one = i[a] == j[a]
            left = np.arange(b - a) if one else np.flatnonzero(mine[a:b] == i[a])
            right = left if one else np.flatnonzero(mine[a:b] == j[a])
            linked = exact_links(sets[a:b], left, right)
            if one:
                np.fill_diagonal(linked, False)
            links[a + left] += linked.sum(axis=1)
            if not one:
                links[a + right] += linked.sum(axis=0)
            x, y = np.nonzero(linked)
            edges += [(p + a, q + a) for p, q in forest(b - a, left[x], right[y])]
        at = np.array(edges, np.int64).reshape(-1, 2)
        yield pd.DataFrame({"node": node, "other": pd.array([None] * len(node), "Int64"), "links": links})
        yield pd.DataFrame({"node": node[at[:, 0]], "other": pd.array(node[at[:, 1]], "Int64"), "links": 0})


def _text_classes(docs: DataFrame, text: str, *further: str) -> DataFrame:
    """doc_id, further columns, node, root (the smallest node of the class), class_id, n_links, n_copies."""
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select("doc_id", *further, body.alias("text"), text_key(F.col(text)).alias("node"))
    keys = written(source.select("doc_id", *further, "node"), "join-keys")
    rows = source.select("node", "text").mapInArrow(_signature_rows, "node long, bands array<long>, sig binary")
    texts = written(rows.groupBy("node").agg(F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")), "signatures")

    # Buckets of one text say nothing; buckets of the same texts say the same, so one of them is enough.
    entries = texts.select("node", F.explode("bands").alias("key"))
    mixed = F.xxhash64("node").cast("decimal(38,0)")
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum(mixed).alias("sum"), F.min("node").alias("least")).where("size > 1")
    chosen = sizes.groupBy("size", "sum", "least").agg(F.min("key").alias("key")).select("key", "size")
    members = entries.join(chosen, "key").join(texts.select("node", "sig"), "node")
    edges = _in_blocks(members, "key", F.col("size"), BUCKET_BLOCK).mapInPandas(_candidate_edges, "a long, b long")
    groups = components(edges, name="candidates")

    count = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    wanted = groups.join(count, "root")
    own = source.select("node", "text").join(sendable(groups.select("node"), "members"), "node", "left_semi")
    grams = own.dropDuplicates(["node"]).mapInArrow(_ngram_rows, "node long, grams binary")
    blocks = _in_blocks(grams.join(wanted, "node"), "root", F.col("size"), GROUP_BLOCK)
    counted = written(blocks.mapInPandas(_counted_links, "node long, other long, links long"), "links")
    links = counted.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(counted.where("other IS NOT NULL"), "node", "other", "classes")

    of_text = keys.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    of_text = of_text.join(classes, "node", "left").join(links, "node", "left")
    of_text = of_text.withColumn("root", F.coalesce("root", "node"))
    named = of_text.groupBy("root").agg(F.min("least").alias("class_id"))
    result = of_text.join(named, "root").select("node", "root", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("rows") - 1).alias("n_copies"))
    return keys.join(result, "node").select("doc_id", *further, "node", "root", "class_id", "n_links", "n_copies")


def similar_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, node (number of its text), class_id (smallest doc_id of the texts linked to each other), n_links (other texts it is linked to), n_copies (other rows of the same text)."""
    return _text_classes(docs, text).drop("root")


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each class, the first of several with that doc_id, or with none."""
    (row,) = unused(docs, "_row")
    docs = numbered(docs, "join-docs", row)
    plain = docs.select("doc_id", F.col(row).alias("_row"), F.col(text).alias("text"))
    found = written(_text_classes(plain, "text", "_row").select("doc_id", "_row", "root"), "join-classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = found.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = sendable(first.select("root", F.col("first._row").alias("kept")), "join-kept")
    gone = sendable(found.join(first, "root").where("_row <> kept").select(F.col("_row").alias(row)), "join-gone")
    return docs.join(gone, row, "left_anti").drop(row)


_SQL = f"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS node, count(*) AS rows FROM documents GROUP BY 1),
w AS (SELECT node, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM t),
g AS (SELECT DISTINCT node, unnest(list_transform(range(1, greatest(len(words) - {WORDS - 2}, 2)), lambda i: array_to_string(words[i:i + {WORDS - 1}], ' '))) AS gram FROM w WHERE len(words) > 0),
n AS (SELECT node, count(*) AS size FROM g GROUP BY node),
p AS (SELECT a.node AS a, b.node AS b, count(*) AS same FROM g a JOIN g b ON a.gram = b.gram AND a.node <> b.node GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.node = a JOIN n y ON y.node = b WHERE same * 5 >= (x.size + y.size - same) * 4),
c(node, root) AS (SELECT node, node FROM t UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.node),
r AS (SELECT node, min(root) AS class_id FROM c GROUP BY node),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links, rows - 1 AS n_copies
FROM documents d JOIN t ON t.text = coalesce(d.text, '') JOIN r USING (node) LEFT JOIN k ON k.a = t.node
"""


@query("op8_ngram_join", _SQL)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_texts(table(spark, sf_dir, "documents")).drop("node")
