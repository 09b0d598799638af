"""Vector bin packing of examples into training sequences.

An example asks for tokens, segments and loss-bearing tokens at once, and a sequence has a limit on each.
Examples longer than a sequence are first cut into full sequences and a rest. Rests go to even blocks
by a hash, and each block is packed by the dot-product heuristic: a sequence takes, again and again, the
example that fits and whose demands point most along what the sequence has left, each limit weighted
by how much of it the block's examples ask for. A block is a bounded number of rows whatever the table
holds, so blocks are packed side by side, and a block leaves about one sequence badly filled.

NULL text: empty, so the end id alone. NULL doc_id and equal rows: packed like others. An empty table
gives an empty result. Other columns stay, but for
`sequence_id` and `offset`, which are the result's. An example over a limit by itself raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from charlake.llm.common import slices, unused
from charlake.llm.registry import query, table
from charlake.llm.tokens import encoder, vocabulary
from charlake.operators.scratch import written

CAPACITY = 2_048
MAX_SEGMENTS = 128
# Rests packed together in one task.
BLOCK_ROWS = 2_048

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long"
_FIRST_PACKED = 1 << 62  # sequences packed from rests are numbered from here on, full ones by task below it


def pack_vectors(demands: np.ndarray, limits: Sequence[int]) -> np.ndarray:
    """The bin of each row of `demands` (rows x limits), by the dot-product heuristic. Bins are numbered from 0."""
    demands, limits = np.asarray(demands, np.int64), np.asarray(limits, np.int64)
    if (demands > limits).any():
        raise ValueError("an example is larger than a sequence's limits")
    bins = np.full(len(demands), -1, np.int64)
    scaled = demands / limits
    weights = scaled.mean(axis=0) if len(demands) else np.ones(len(limits))
    left = np.arange(len(demands))
    now = 0
    while len(left):
        rest, open_rows = limits.copy(), np.ones(len(left), bool)
        need, pull = demands[left], scaled[left] * weights
        while True:
            fits = open_rows & (need <= rest).all(axis=1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, pull @ (rest / limits), -1.0)))
            bins[left[best]], open_rows[best] = now, False
            rest = rest - need[best]
        left = left[open_rows]
        now += 1
    return bins


def pieces(docs: DataFrame, path: str, kind: str, end_id: int, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut into full sequences (numbered) and a rest (sequence_id NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, full = encoder(path, kind), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, keys = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                out: list[tuple] = []
                for key, ids in zip(keys[a:b], coder.encode(texts[a:b]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        part = ids[start : start + capacity]
                        out.append((key, start, len(part), zlib.crc32(part.tobytes()), len(ids), full if len(part) == capacity else None))
                        full += len(part) == capacity
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, _PIECES)


def pack(examples: DataFrame, limits: dict[str, int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The examples with `sequence_id` and, as `offset`, the tokens before them there.

    `limits` gives a limit for each demand column; the first one counts the tokens. NULL demands count as 0.
    """
    row, of_block, *needs = unused(examples, "_row", "_block", *(f"_need_{i}" for i in range(len(limits))))
    rows = written(examples.withColumn(row, F.monotonically_increasing_id()), "packing")
    blocks = max(1, -(-rows.count() // block_rows))
    fields = [f for f in examples.schema if f.name not in ("sequence_id", "offset")]
    names = [f.name for f in fields]

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by(row)
        demands = np.column_stack([block.column(c).to_numpy() for c in needs])
        bins = pack_vectors(demands, list(limits.values()))
        ids = _FIRST_PACKED + (block.column(of_block)[0].as_py() << 24) + bins
        before = pd.Series(demands[:, 0]).groupby(bins).cumsum().to_numpy() - demands[:, 0]
        return block.select(names).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(before))

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "sequence_id long, offset long"])
    demand = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(n) for c, n in zip(limits, needs, strict=True)]
    placed = rows.select(*names, *demand, row, F.pmod(F.xxhash64(row), F.lit(blocks)).alias(of_block))
    return placed.groupBy(of_block).applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, kind: str = "words", end_id: int = 1, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, text: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's first token has nothing before it to be predicted from, so it bears no loss; all others do.
    """
    cut = written(pieces(docs, path, kind, end_id, capacity, text), "pieces")
    names = [x.split()[0] for x in _PIECES.split(", ")][:-1]
    rests = cut.where("sequence_id IS NULL").withColumns(
        {"_segments": F.lit(1), "_loss": F.col("length") - F.when(F.col("start") == 0, 1).otherwise(0)}
    )
    limits = {"length": capacity, "_segments": max_segments, "_loss": max_loss or capacity}
    packed = pack(rests, limits).select(*names, "sequence_id", "offset")
    full = cut.where("sequence_id IS NOT NULL").select(*names, "sequence_id", F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


@query("op4_vector_packing")
def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
