"""Language by compression: a text's language is the one whose dictionary compresses it to the fewest bytes.

Each language has a zstandard raw-content dictionary: slices of `SLICE_CHARS` characters, at places drawn by
hash, from at most `SAMPLE_ROWS` different texts of it, drawn by hash as well; `DICTIONARY_BYTES` in all. Texts and
dictionaries are lower-cased and reduced to words of letters. A whole text is compressed with every dictionary in pieces of
`PIECE_BYTES`, and the sizes of the pieces are added up. The language of the smallest sum is predicted, the first by name if
two are equal; the prediction is rejected if the next sum is less than `LEAST_MARGIN` larger, as a share of it, or less than
`LEAST_BYTES` bytes. The score is the share of the best language when each weighs 2 to the minus of its bytes more than the best.

The sample is bounded by its documented sizes, whatever the tables' size; equal texts count once in it, so groups of copies
do not fill it. Rows with crc32(doc_id) mod 3 = 1 are never learned from. Scoring reads the texts where they lie, without a shuffle.

NULL text, or one without letters: `und`, score 0, rejected. NULL doc_id: never held out, never learned from. NULL lang: not
learned from. Without any row to learn from every text is `und`. Equal rows are all scored. An empty table gives an
empty result. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from charlake.llm.registry import query, table

# Bounds of the labelled sample, of each language.
SAMPLE_ROWS, SLICE_CHARS, DICTIONARY_BYTES = 100, 1_024, 64 << 10
PIECE_BYTES = 8_192
LEAST_MARGIN, LEAST_BYTES = 0.02, 3
UNKNOWN = "und"

Model = dict[str, bytes]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def words(text: str) -> Column:
    """Lower-case words of letters with single blanks between them; empty without a letter."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}]+", " "))


def learn(docs: DataFrame, text: str = "text") -> Model:
    """The dictionary of each language."""
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    rows = rows.select("doc_id", F.col("lang").cast("string").alias("lang"), words(text).alias("text")).where("text <> ''")
    rows = rows.withColumn("luck", F.xxhash64("text"))
    # Numbers of the different texts only: the texts of those drawn are fetched by their ids.
    luck = rows.groupBy("lang", "luck").agg(F.min("doc_id").alias("doc_id"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("luck", "doc_id"))
    drawn = luck.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).select("lang", "luck", "doc_id")
    start = F.pmod(F.shiftright("luck", 7), F.greatest(F.length("text") - SLICE_CHARS, F.lit(1))).cast("int")
    found = rows.join(F.broadcast(drawn), ["lang", "luck", "doc_id"]).select("lang", "luck", F.substring("text", start + 1, F.lit(SLICE_CHARS)).alias("slice")).distinct()
    model: Model = {}
    for row in sorted(found.collect(), key=lambda r: (r["lang"], r["luck"], r["slice"])):
        model[row["lang"]] = (model.get(row["lang"], b"") + row["slice"].encode() + b" ")[:DICTIONARY_BYTES]
    return model


def compressors(model: Model) -> dict[str, zstandard.ZstdCompressor]:
    """By language, in order of names."""
    out = {}
    for lang, content in sorted(model.items()):
        settings = zstandard.ZstdCompressionParameters.from_level(
            6, source_size=PIECE_BYTES, dict_size=len(content), strategy=zstandard.STRATEGY_LAZY, min_match=4, search_log=2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=settings)
        out[lang] = zstandard.ZstdCompressor(compression_params=settings, dict_data=held)
    return out


def sizes(text: bytes, tools: list[zstandard.ZstdCompressor]) -> list[int]:
    """Bytes of the whole text with each compressor."""
    pieces = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]
    return [sum(len(tool.compress(piece)) for piece in pieces) for tool in tools]


def chosen(found: list[int]) -> tuple[int, float, float, bool]:
    """The number of the best, its score, its margin, and whether it is rejected."""
    best = int(np.argmin(found))
    more = np.array(found) - found[best]
    least = min((int(x) for i, x in enumerate(more) if i != best), default=found[best])
    margin = least / (found[best] + least)
    return best, float(1 / np.exp2(-more.astype(float)).sum()), margin, margin < LEAST_MARGIN or least < LEAST_BYTES


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin (the next language's bytes more, as a share of its bytes), rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = compressors(sent.value)
        names, used = list(tools), list(tools.values())
        for batch in batches:
            rows = [
                (names[r[0]], *r[1:]) if (r := chosen(sizes(body, used)) if body and used else None) else (UNKNOWN, 0.0, 0.0, True)
                for body in (x.as_buffer().to_pybytes() for x in batch.column(2))
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), words(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean")


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, learn(docs))
