"""Values of whole conversations from their turns, by partial aggregates: one row per conversation.

A conversation of any length costs a task one row of partial sums; its turns are never put into one cell.
Turns are ordered by turn, role and text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from charlake.functions.text import count_of
from charlake.functions.transcripts import canonical_role, message_text
from charlake.operators.skew import join_on
from charlake.schemas import SUMMARY

_PLACE = ("turn", "role", "text")


def last_exchanges(turns: DataFrame, user_roles: Sequence[str], reply_roles: Sequence[str]) -> DataFrame:
    """conv_id, pregunta, respuesta: the last user message and the first reply after it, else the last reply there is."""
    place, role = F.struct(*_PLACE), F.lower("role")
    asked = F.when(role.isin(*user_roles), place)
    said = F.when(role.isin(*reply_roles), place)
    ends = turns.groupBy("conv_id").agg(F.max(asked).alias("_asked"), F.max(said).alias("_last"))
    replies = turns.where(role.isin(*reply_roles)).withColumn("_place", place)
    after = replies.join(ends.select("conv_id", "_asked"), "conv_id").where(F.col("_place") > F.col("_asked"))
    following = after.groupBy("conv_id").agg(F.min("_place").alias("_next"))
    return ends.join(following, "conv_id", "left").select(
        "conv_id",
        F.coalesce(F.col("_asked.text"), F.lit("")).alias("pregunta"),
        F.coalesce(F.col("_next.text"), F.col("_last.text"), F.lit("")).alias("respuesta"),
    )


def distinct_questions(turns: DataFrame, role_words: Mapping[str, str]) -> DataFrame:
    """conv_id, pregunta and its first place: each of the user's questions once. Repeats go before the shuffle."""
    spoken = turns.select("conv_id", *_PLACE, canonical_role(F.col("role"), role_words).alias("who"), message_text(F.col("text")).alias("pregunta"))
    asked = spoken.where((F.col("who") == "user") & (F.col("pregunta") != ""))
    first = asked.groupBy("conv_id", "pregunta").agg(F.min(F.struct(*_PLACE)).alias("p"))
    return first.select("conv_id", "pregunta", "p.turn", "p.role", "p.text")


def question_counts(turns: DataFrame, role_words: Mapping[str, str]) -> DataFrame:
    """conv_id, n: how many different questions, 0 for none."""
    asked = distinct_questions(turns, role_words).groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return turns.select("conv_id").distinct().join(asked, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n"))


def text_counts(turns: DataFrame, role_words: Mapping[str, str]) -> DataFrame:
    """conv_id with what a count in the rendered transcript gives: `bot`, `user` and `user:`, and turns, messages and whether there is a question.

    Messages are counted one by one: no word can reach over the mark between two messages.
    """
    who = canonical_role(F.col("role"), role_words)
    said = turns.select("conv_id", who.alias("who"), message_text(F.col("text")).alias("text"))
    lines = said.select("*", F.concat("who", F.lit(": "), "text").alias("line"))
    return lines.groupBy("conv_id").agg(
        F.sum(count_of(F.col("line"), "bot")).alias("bot"), F.sum(count_of(F.col("line"), "user")).alias("usuario"),
        F.sum(count_of(F.lower("line"), "user:")).alias("preguntas"), F.count_if(F.col("who") == "user").alias("turnos"),
        F.count_if(F.col("who") == "bot").alias("turnos_bot"), F.count(F.lit(1)).alias("mensajes"),
        F.bool_or((F.col("who") == "user") & (F.col("text") != "")).alias("con_preguntas"),
    )


def summaries(turns: DataFrame, role_words: Mapping[str, str], user_roles: Sequence[str], reply_roles: Sequence[str]) -> DataFrame:
    """conv_id, resumen: a `SUMMARY` of each conversation, reduced from its turns."""
    ends = last_exchanges(turns, user_roles, reply_roles)
    rows = text_counts(turns, role_words).join(ends, "conv_id", "left")
    of = {"turnos_usuario": "turnos", "dice_bot": "bot", "dice_usuario": "usuario", "dice_preguntas": "preguntas"}
    return rows.select("conv_id", F.struct(*[F.col(of.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in SUMMARY]).alias("resumen"))


def asked_first(cells: DataFrame, key: str, part: str, questions: str) -> DataFrame:
    """Of several cells of one key, each question only where it was asked first. A cell's questions are bounded, a key's are not."""
    asked = cells.select(key, part, F.posexplode(questions).alias("_at", "_q"))
    first = asked.groupBy(key, "_q").agg(F.min(F.struct(part, "_at")).alias("_p"))
    kept = first.groupBy(key, F.col(f"_p.{part}").alias(part)).agg(F.array_sort(F.collect_list(F.struct("_p._at", "_q"))).alias("_kept"))
    found = F.coalesce(F.transform("_kept", lambda e: e["_q"]), F.array().cast("array<string>"))
    return join_on(cells, kept, [key, part], "left").withColumn(questions, found).drop("_kept")
