"""One row per feedback, with the exchange it was about and the user's profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from charlake.config import FEEDBACK_TABLE_COLUMNS, PROFILE_FIELDS, ChatConfig
from charlake.functions.text import blank_to_empty, single_line
from charlake.functions.transcripts import last_exchange
from charlake.operators.aggregates import last_non_blank
from charlake.operators.asof import asof_join
from charlake.operators.joins import latest_per_key, without_names
from charlake.operators.shape import enforce_columns
from charlake.sources.items import CONVERSATION, FEEDBACK, is_kind

ORDER = ("item_ts", "sk")


def exchanges(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Conversations with their last user message and its reply, on one line each: the item's summary has them, else its messages."""
    if "resumen" in items.columns:
        asked, replied = F.coalesce("resumen.pregunta", F.lit("")), F.coalesce("resumen.respuesta", F.lit(""))
    else:
        asked, replied = last_exchange(F.col("messages"), cfg.user_roles, cfg.reply_roles)
    return items.where(is_kind(CONVERSATION) & F.col("usuario_id").isNotNull()).select(
        "usuario_id", *ORDER,
        single_line(asked, cfg.max_message_chars).alias("mensaje_usuario"),
        single_line(replied, cfg.max_message_chars).alias("mensaje_bot"),
    )


def matchable() -> Column:
    """Whether a feedback has a user and a time; never NULL."""
    return F.coalesce(F.col("usuario_id") != "", F.lit(False)) & F.col("item_ts").isNotNull()


def dropped_feedback(items: DataFrame) -> DataFrame:
    """The feedback that `match_feedback` leaves out."""
    return items.where(is_kind(FEEDBACK) & ~matchable())


def feedback_rows(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Feedback with a user and a time; others match nothing and are dropped."""
    return items.where(is_kind(FEEDBACK) & matchable()).select(
        "usuario_id", *ORDER, F.to_date("created_at").alias("fecha"),
        F.coalesce("feedback.type", F.lit("")).alias("feedback"),
        single_line(F.col("feedback.comment"), cfg.max_message_chars).alias("comentario"),
        F.coalesce("feedback.option", F.lit("")).alias("opcion_respuesta"),
        *[blank_to_empty(F.col(f"profile.{f}")).alias(f) for f in PROFILE_FIELDS],
    )


def match_feedback(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Each feedback with the newest earlier exchange that has a user message, else the oldest earlier one."""
    return asof_join(
        feedback_rows(items, cfg),
        exchanges(items, cfg).where(F.col("item_ts").isNotNull()),
        by=["usuario_id"], on="item_ts", payload=["mensaje_usuario", "mensaje_bot"], tie="sk", left_tie="sk",
        prefer=F.col("mensaje_usuario") != "", fallback="oldest", rows_per_window=cfg.rows_per_window,
    )


def user_profiles(items: DataFrame, mode: str = "last_non_empty") -> DataFrame:
    """One profile per user from their conversations: each field's last value, or the last item's fields."""
    rows = items.where(is_kind(CONVERSATION) & F.col("usuario_id").isNotNull()).select(
        "usuario_id", *ORDER, *[blank_to_empty(F.col(f"profile.{f}")).alias(f) for f in PROFILE_FIELDS]
    )
    if mode == "latest":
        return latest_per_key(rows, "usuario_id", PROFILE_FIELDS, ORDER)
    if mode != "last_non_empty":
        raise ValueError(f"unknown profile mode: {mode}")
    return rows.groupBy("usuario_id").agg(*[last_non_blank(F.col(f), F.struct(*ORDER)).alias(f) for f in PROFILE_FIELDS])


def with_user_profile(matched: DataFrame, profiles: DataFrame) -> DataFrame:
    """Matched feedback takes the user's profile; the rest keeps its own."""
    known = profiles.select("usuario_id", *[F.col(f).alias(f"_{f}") for f in PROFILE_FIELDS])
    joined = matched.join(known, "usuario_id", "left")
    return joined.select(
        *[c for c in matched.columns if c not in PROFILE_FIELDS],
        *[F.when(F.col("matched"), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in PROFILE_FIELDS],
    )


def build_feedback_table(items: DataFrame, cfg: ChatConfig = ChatConfig(), profile: str = "last_non_empty") -> DataFrame:
    """The thirteen columns. A missing date is NULL, other missing values are empty."""
    full = with_user_profile(match_feedback(items, cfg), user_profiles(items, profile))
    kept = without_names(full, "nombre", cfg.excluded_names)
    return enforce_columns(kept, FEEDBACK_TABLE_COLUMNS).na.fill("")
