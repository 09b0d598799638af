"""The user table, typed, with token counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from charlake.config import USER_TABLE_TYPES, ChatConfig
from charlake.functions.text import strip
from charlake.functions.tokens import sum_tokens
from charlake.functions.transcripts import bot_texts, split_transcript, user_texts
from charlake.operators.shape import typed_columns

TRANSCRIPT = "conversacion_completa"


def has_transcript() -> Column:
    return F.col(TRANSCRIPT).isNotNull() & (strip(F.col(TRANSCRIPT)) != "")


def type_user_table(
    users: DataFrame, cfg: ChatConfig = ChatConfig(), tokenizer: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Typed columns plus `token_pregunta` and `token_respuesta`; rows without a transcript are dropped.

    A filter and two selects, so it runs in the scan's own stage. `tokenizer` gives the tokens of a text in place
    of the estimate: a function of a column, or a UDF of any scalar kind, which gets the texts of many rows at once. Without a transcript column the token columns are NULL.
    """
    if TRANSCRIPT not in users.columns:
        missing = F.lit(None).cast("int")
        return users.select(
            *typed_columns(users, USER_TABLE_TYPES, cfg.zero_as_null),
            missing.alias("token_pregunta"), missing.alias("token_respuesta"),
        )
    split = users.where(has_transcript()).select("*", split_transcript(F.col(TRANSCRIPT)).alias("_messages"))
    return split.select(
        *typed_columns(users, USER_TABLE_TYPES, cfg.zero_as_null),
        sum_tokens(user_texts(F.col("_messages")), tokenizer).cast("int").alias("token_pregunta"),
        sum_tokens(bot_texts(F.col("_messages")), tokenizer).cast("int").alias("token_respuesta"),
    )
