"""The item table, derived from the given tables.

Events become items: signups are registrations, errors and purchases are feedback, the rest are
visits. A conversation is an item of the user and time of the event with its number. The profile
each item carries comes from the event's own columns, so no join is needed for it. Expressions in
SQL text are the same in Spark and in the checking SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.config import PROFILE_FIELDS, ChatConfig
from charlake.functions.transcripts import questions_of
from charlake.operators.conversations import asked_first, summaries
from charlake.operators.parts import by_parts
from charlake.schemas import FEEDBACK, ITEMS, SUMMARY

CFG = ChatConfig(
    excluded_city_words=("cali", "oeste"),
    excluded_name_words=("prueba 1", "demo"),
    excluded_names=("pruebas qa", "customer#000000003"),
    first_day=date(2024, 1, 3),
    last_day=date(2024, 1, 27),
)

# Turns in one cell of text. Values are of whole conversations.
TURNS_PER_CELL = 1_000

K = "CAST(replace(substr(props, 7), '}', '') AS INT)"

KIND = "CASE event_type WHEN 'signup' THEN 'REGISTER' WHEN 'error' THEN 'FEEDBACK' WHEN 'purchase' THEN 'FEEDBACK' ELSE 'VISIT' END"

CREATED = "CASE WHEN k < 5 THEN NULL ELSE ts END"

PROFILE = {
    "nombre": (
        "CASE WHEN k < 8 THEN NULL WHEN k < 16 THEN '' WHEN k < 20 THEN 'nan' WHEN k < 23 THEN 'Prueba ' || CAST(user_id AS STRING) "
        "WHEN k < 26 THEN ' PRUEBAS QA ' ELSE '  Customer#' || lpad(CAST(user_id AS STRING), 9, '0') || ' ' END"
    ),
    "ciudad": (
        "CASE WHEN value < 2 THEN 'Cali' WHEN value < 6 THEN 'Norte (zona ' || CAST(k AS STRING) || ')' "
        "WHEN value < 9 THEN NULL WHEN value < 14 THEN '' ELSE ' Sur ' END"
    ),
    "gerencia": "CASE WHEN value < 16 THEN '' ELSE 'G-' || event_type END",
    "oficinas_asesoras": "CASE WHEN value < 12 THEN 'null' ELSE 'OA-' || CAST(k AS STRING) END",
    "subgerencia": "CASE WHEN value < 20 THEN '' ELSE 'S-' || CAST(k AS STRING) END",
    "nivel_directivo": "CASE WHEN event_type = 'purchase' THEN 'Jefe' ELSE NULL END",
}

FEEDBACK_VALUES = {
    "type": "CASE WHEN k > 95 THEN '' WHEN event_type = 'error' THEN 'dislike' ELSE 'like' END",
    "comment": (
        "CASE WHEN k < 30 THEN '' WHEN k < 35 THEN 'None' WHEN k < 40 THEN 'nota' || chr(10) || CAST(k AS STRING) "
        "ELSE 'nota ' || CAST(k AS STRING) END"
    ),
    "option": "CASE WHEN k < 60 THEN '' WHEN k < 70 THEN NULL ELSE 'opción ' || event_type END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number `k` of their properties."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", F.expr(K).alias("k")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, segmento, messages: a conversation's turns in order, at most 1,000 in a cell."""
    return by_parts(turns(spark, sf_dir), ["conv_id"], ["turn", "role", "text"], TURNS_PER_CELL, "segmento", _messages)


def _messages(rows: DataFrame, group: list[str]) -> DataFrame:
    message = F.struct("turn", "role", "text", F.lit(None).cast("timestamp").alias("ts"))
    return rows.groupBy(*group).agg(F.array_sort(F.collect_list(message)).alias("messages"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def profile() -> Column:
    return F.struct(*[F.expr(PROFILE[f]).alias(f) for f in PROFILE_FIELDS])


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr(KIND)
    feedback = F.struct(*[F.expr(sql).alias(f) for f, sql in FEEDBACK_VALUES.items()])
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("usuario_id"),
        F.concat(kind, F.lit("#"), iso(F.col("ts"))).alias("sk"),
        kind.alias("kind"),
        F.col("ts").alias("item_ts"),
        F.expr(CREATED).alias("created_at"),
        profile().alias("profile"),
        F.lit(None).cast(ITEMS["messages"].dataType).alias("messages"),
        F.when(kind == "FEEDBACK", feedback).cast(FEEDBACK).alias("feedback"),
    )


def conversation_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of conversations as stored items of their own, some microseconds apart."""
    ts = F.expr("ts + make_dt_interval(CAST(conv_id % 29 AS INT), 0, 0, CAST(segmento / 1000000 AS DECIMAL(18, 6)))")
    return _begun(conversations(spark, sf_dir), spark, sf_dir, ts)


def _begun(rows: DataFrame, spark: SparkSession, sf_dir: str, ts: Column, *more: str) -> DataFrame:
    """Rows with a conv_id as items, spread over the month, so that feedback falls before and after them."""
    began = rows.join(events(spark, sf_dir), F.col("conv_id") == F.col("event_id"), "left")
    return began.select(
        F.col("user_id").cast("string").alias("usuario_id"),
        F.concat(F.lit("CONVERSATION#"), iso(ts)).alias("sk"),
        F.lit("CONVERSATION").alias("kind"),
        ts.alias("item_ts"),
        F.when(F.col("k") >= 5, ts).alias("created_at"),
        profile().alias("profile"),
        F.col("messages").cast(ITEMS["messages"].dataType).alias("messages"),
        F.lit(None).cast(FEEDBACK).alias("feedback"),
        *more,
    )


_BEGAN = "ts + make_dt_interval(CAST(conv_id % 29 AS INT))"


def whole_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per event and per conversation of any length, which has a summary in place of its messages."""
    none = F.lit(None).cast(ITEMS["messages"].dataType).alias("messages")
    talks = summaries(turns(spark, sf_dir), CFG.role_words, CFG.user_roles, CFG.reply_roles).select("*", none)
    seen = event_items(spark, sf_dir).withColumn("resumen", F.lit(None).cast(SUMMARY))
    return seen.unionByName(_begun(talks, spark, sf_dir, F.expr(_BEGAN), "resumen"))


def text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of `whole_items`, a row per cell of a conversation, with the questions first asked in it."""

    def build(rows: DataFrame, group: list[str]) -> DataFrame:
        return _messages(rows, group).withColumn("preguntas", questions_of(F.col("messages"), CFG.role_words))

    cells = by_parts(
        turns(spark, sf_dir), ["conv_id"], ["turn", "role", "text"], TURNS_PER_CELL, "segmento", build,
        across=lambda parts: asked_first(parts, "conv_id", "segmento", "preguntas"),
    )
    return _begun(cells, spark, sf_dir, F.expr(_BEGAN), "segmento", "preguntas")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as they are stored, of bounded size."""
    return event_items(spark, sf_dir).unionByName(conversation_items(spark, sf_dir))
