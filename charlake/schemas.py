"""Declared schemas; nothing is inferred."""

from pyspark.sql import types as T

from charlake.config import PROFILE_FIELDS, USER_TABLE_COLUMNS

MESSAGE = T.StructType([
    T.StructField("turn", T.IntegerType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

PROFILE = T.StructType([T.StructField(name, T.StringType()) for name in PROFILE_FIELDS])

FEEDBACK = T.StructType([T.StructField(name, T.StringType()) for name in ("type", "comment", "option")])

# What the tables need of a conversation, whatever its length: its last exchange, turns by role, and how often words stand in its text.
SUMMARY = T.StructType([
    T.StructField("pregunta", T.StringType()),
    T.StructField("respuesta", T.StringType()),
    T.StructField("turnos_usuario", T.LongType()),
    T.StructField("turnos_bot", T.LongType()),
    T.StructField("mensajes", T.LongType()),
    T.StructField("con_preguntas", T.BooleanType()),
    T.StructField("dice_bot", T.LongType()),
    T.StructField("dice_usuario", T.LongType()),
    T.StructField("dice_preguntas", T.LongType()),
])

# One row per stored item. (usuario_id, sk) is its key.
ITEMS = T.StructType([
    T.StructField("usuario_id", T.StringType()),
    T.StructField("sk", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("item_ts", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("profile", PROFILE),
    T.StructField("messages", T.ArrayType(MESSAGE)),
    T.StructField("feedback", FEEDBACK),
])


# A scalar in the store's typed JSON. One tag is set per value.
TYPED_SCALAR = T.StructType([
    T.StructField("S", T.StringType()),
    T.StructField("N", T.StringType()),
    T.StructField("BOOL", T.BooleanType()),
    T.StructField("NULL", T.BooleanType()),
    T.StructField("SS", T.ArrayType(T.StringType())),
    T.StructField("NS", T.ArrayType(T.StringType())),
    T.StructField("BS", T.ArrayType(T.StringType())),
])

# The user table as CSV holds it: all text, plus the row's part number.
USER_CSV = T.StructType([T.StructField(name, T.StringType()) for name in (*USER_TABLE_COLUMNS, "parte")])
