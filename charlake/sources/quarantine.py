"""Rows that cannot be taken in, kept with the reason instead of lost: rows read = rows typed + rows in quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from charlake.config import USER_TABLE_TYPES, ChatConfig
from charlake.functions.text import is_blank, strip
from charlake.operators.scratch import written
from charlake.operators.shape import typed_columns
from charlake.plans.typed_table import has_transcript, type_user_table
from charlake.schemas import USER_CSV
from charlake.sources.files import CSV

RAW, REASON = "registro", "motivo"
# Reasons, the first that holds counts.
MALFORMED, NO_KEY, BAD_VALUE, NO_TALK = "mal formado", "sin usuario", "valor", "sin conversación"

_CHECKED = ("date", "timestamp", "number", "integer", "double")


def checked_schema(schema: StructType = USER_CSV) -> StructType:
    """The schema with a column for the text of records that do not fit it."""
    return StructType([*schema, StructField(RAW, StringType())])


def csv_options(multi_line: bool = True) -> dict[str, str]:
    """Whether a record fits is told from all of its columns, so the parser must not leave any out."""
    return CSV | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "columnPruning": "false", "multiLine": str(multi_line).lower()}


def read_csv_checked(spark: SparkSession, path: str, schema: StructType = USER_CSV, multi_line: bool = True) -> DataFrame:
    """CSV rows with `registro`, NULL for those that have the schema's columns, no more and no fewer."""
    return spark.read.schema(checked_schema(schema)).options(**csv_options(multi_line)).csv(path)


def _unread(df: DataFrame, types: Mapping[str, str], cfg: ChatConfig) -> Column:
    """The names of columns that hold a text their type cannot take, in order, joined by commas; empty for none.

    A missing value, the no-date label and a zero that means NULL are no errors.
    """
    typed = dict(zip(df.columns, typed_columns(df, types, zero_as_null=False), strict=True))
    names = []
    for c in df.columns:
        if types.get(c.lower()) in _CHECKED:
            said = ~is_blank(F.col(c)) & (strip(F.col(c)) != cfg.no_date_label)
            names.append(F.when(said & typed[c].isNull(), F.lit(c)))
    return F.concat_ws(",", *names) if names else F.lit("")


def with_reason(rows: DataFrame, cfg: ChatConfig = ChatConfig(), types: Mapping[str, str] = USER_TABLE_TYPES) -> DataFrame:
    """Adds `motivo`: why a row of the user table's CSV is not typed, NULL if it is."""
    unread = _unread(rows, types, cfg)
    return rows.withColumn(
        REASON,
        F.when(F.col(RAW).isNotNull(), F.lit(MALFORMED))
        .when(F.coalesce(strip(F.col("usuario_id")), F.lit("")) == "", F.lit(NO_KEY))
        .when(unread != "", F.concat(F.lit(f"{BAD_VALUE}: "), unread))
        .when(~has_transcript(), F.lit(NO_TALK)),
    )


def typed_and_bad(rows: DataFrame, cfg: ChatConfig = ChatConfig()) -> tuple[DataFrame, DataFrame]:
    """The typed rows, and the others as they came with their reason. `rows` has `motivo`."""
    good = rows.where(F.col(REASON).isNull()).drop(RAW, REASON)
    return type_user_table(good, cfg), rows.where(F.col(REASON).isNotNull())


def counts(rows: DataFrame) -> DataFrame:
    """motivo (empty for typed rows), filas."""
    return rows.groupBy(F.coalesce(REASON, F.lit("")).alias(REASON)).agg(F.count(F.lit(1)).alias("filas"))


def ingest_csv(spark: SparkSession, path: str, out_dir: str, bad_dir: str, cfg: ChatConfig = ChatConfig()) -> DataFrame:
    """All CSV rows below a folder to typed Parquet or to quarantine, and how many went where.

    The rows are written once before they are split, so the texts are parsed once and both sides see the same rows.
    """
    rows = written(with_reason(read_csv_checked(spark, path), cfg), "checked-csv")
    typed, bad = typed_and_bad(rows, cfg)
    typed.write.mode("overwrite").parquet(out_dir)
    bad.write.mode("overwrite").parquet(bad_dir)
    return counts(rows)
