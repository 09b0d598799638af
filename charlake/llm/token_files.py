"""Token ids as ORC files: stripes of run-length encoded ids, row indexes and Bloom filters on doc_id.

Rows are range-partitioned and sorted by doc_id before they are encoded, so files follow each other in
ascending doc_id order and a reader prunes files and stripes by their doc_id ranges; stripes are read
in parallel. `write_tokens` writes them, `read_tokens` reads them back with each document's place in the
stream of all ids, `read_documents` reads a few documents through the indexes.

NULL doc_id: first in order, told apart by no more than their rows, which keep their order in `row`, their number in the file's task. NULL text: empty, so the end id alone. Equal
rows are all written. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from charlake.llm.common import slices
from charlake.llm.registry import query, table
from charlake.llm.tokens import encoder, vocabulary
from charlake.operators.scratch import new_path, written

STRIPE_BYTES = 8 << 20
INDEX_ROWS = 1_000
BLOOM_ERROR = 0.01


def encoded(docs: DataFrame, path: str, kind: str, end_id: int, text: str = "text") -> DataFrame:
    """doc_id, ids (the text's ids, then the end id), row (the row's number in its task), in the order of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, row = encoder(path, kind), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts]):
                ids = [np.append(x, np.uint32(end_id)).astype(np.int32) for x in coder.encode(texts[a:b])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                numbers = pa.array(np.arange(row, row + b - a))
                row += b - a
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column, numbers], ["doc_id", "ids", "row"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, row long")


def write_tokens(docs: DataFrame, folder: str, path: str, kind: str, end_id: int, text: str = "text") -> None:
    """Write the ids of all documents below `folder`. doc_id, then the row's own number, decides the order."""
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (
        encoded(rows, path, kind, end_id).write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(BLOOM_ERROR))
        .option("orc.create.index", "true").option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.stripe.size", str(STRIPE_BYTES)).orc(folder)
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crcs = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("row"), batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())],
            ["file", "row", "doc_id", "n_tokens", "ids_crc32"],
        )


def task_number(file: Column) -> Column:
    """The number of the task that wrote a file. As text, 100000 would stand before 99999."""
    return F.regexp_extract(file, r"^part-(\d+)", 1).cast("long")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files.

    A document starts after the ids of the files before its own, and of the rows before it in its file.
    A file's sums are one row, so the list of files is all that is ordered in one place.
    """
    files = spark.read.schema("doc_id long, ids array<int>, row long").orc(folder)
    rows = files.select(F.col("_metadata.file_name").alias("file"), "row", "doc_id", "ids")
    rows = written(rows.mapInArrow(_digests, "file string, row long, doc_id long, n_tokens long, ids_crc32 long"), "token-rows")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_end", F.sum("n_tokens").over(inside))
    ends = rows.groupBy("file").agg(F.max("_end").alias("_sum"))
    before = Window.orderBy(task_number(F.col("file")), "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    return rows.join(starts, "file").select("doc_id", (F.col("_first") + F.col("_end") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, folder: str, doc_ids: Sequence[int]) -> DataFrame:
    """The ids of some documents; files, stripes and row groups without them are skipped by their ranges and Bloom filters."""
    return spark.read.schema("doc_id long, ids array<int>").orc(folder).where(F.col("doc_id").isin(*doc_ids))


@query("op10_orc_tokens")
def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"), "bytes", 0)
    return read_tokens(spark, folder)
