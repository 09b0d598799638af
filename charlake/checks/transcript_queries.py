"""Conversations: rendering, questions, counts, role texts, last exchange, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import CFG, conversations, turns
from charlake.checks.registry import query
from charlake.config import BOT_PREFIXES, MESSAGE_SEPARATOR, USER_PREFIXES
from charlake.functions.text import single_line
from charlake.functions.tokens import estimate_tokens
from charlake.functions.transcripts import (
    bot_texts, canonical_role, count_questions_text, count_turns_text, join_texts, last_exchange, message_text,
    questions_text, render_messages, render_text, split_transcript, texts_by_prefix, user_texts,
)
from charlake.operators.conversations import distinct_questions, last_exchanges, question_counts, text_counts
from charlake.operators.parts import by_parts
from charlake.operators.reports import question_coverage

KEY = ["conv_id", "segmento"]

# Questions in one cell of text.
QUESTIONS_PER_CELL = 10_000


def rendered(spark, d) -> DataFrame:
    return conversations(spark, d).select(*KEY, render_messages(F.col("messages"), CFG.role_words).alias("t"))


@query("transcript_render", S.with_(S.SEG, S.MSG, S.TALK, select="SELECT conv_id, segmento, transcript AS conversacion FROM talk"))
def transcript_render(spark, d):
    return rendered(spark, d).withColumnRenamed("t", "conversacion")


@query("transcript_render_json", S.with_(S.SEG, S.MSG, S.TALK, select="SELECT conv_id, segmento, transcript AS conversacion FROM talk"))
def transcript_render_json(spark, d):
    """From the stored JSON text: typed where there is a system turn, else plain."""
    plain = F.to_json(F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["text"].alias("text"))))
    typed = F.to_json(F.transform("messages", lambda m: F.struct(F.struct(
        F.struct(m["role"].alias("S")).alias("from"), F.struct(m["text"].alias("S")).alias("text")
    ).alias("M"))))
    system = F.exists("messages", lambda m: m["role"] == "system")
    text = F.when(system, F.concat(F.lit('{"L":'), typed, F.lit("}"))).otherwise(plain)
    return conversations(spark, d).select(*KEY, render_text(text, CFG.role_words).alias("conversacion"))


@query("user_questions", S.with_(S.TURN, S.QUESTION, (
    f"part AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY pos) - 1) // {QUESTIONS_PER_CELL} AS INTEGER) AS parte FROM question), "
    "cells AS (SELECT conv_id, parte, string_agg(txt, ' | ' ORDER BY pos) AS preguntas FROM part GROUP BY conv_id, parte)"
), select=(
    "SELECT p.conv_id, coalesce(parte, 0) AS parte, coalesce(preguntas, '') AS preguntas, CAST(n AS INTEGER) AS n "
    "FROM per_conv p LEFT JOIN cells c ON c.conv_id = p.conv_id"
)))
def user_questions(spark, d):
    """Each question of a conversation once. The text goes on in further cells; `n` is the conversation's in each of them."""
    rows = turns(spark, d)
    order = ["turn", "role", "text"]

    def cell(part_rows, group):
        asked = F.array_sort(F.collect_list(F.struct(*order, "pregunta")))
        return part_rows.groupBy(*group).agg(F.array_join(F.transform(asked, lambda q: q["pregunta"]), MESSAGE_SEPARATOR).alias("preguntas"))

    cells = by_parts(distinct_questions(rows, CFG.role_words), ["conv_id"], order, QUESTIONS_PER_CELL, "parte", cell)
    return question_counts(rows, CFG.role_words).join(cells, "conv_id", "left").select(
        "conv_id", F.coalesce("parte", F.lit(0)).alias("parte"), F.coalesce("preguntas", F.lit("")).alias("preguntas"), "n"
    )


@query("user_questions_text", S.with_(S.SEG, S.MSG, S.ASKED, select=(
    "SELECT b.conv_id, b.segmento, coalesce(preguntas, '') AS preguntas "
    "FROM (SELECT DISTINCT conv_id, segmento FROM seg) b LEFT JOIN asked a ON a.conv_id = b.conv_id AND a.segmento = b.segmento"
)))
def user_questions_text(spark, d):
    return rendered(spark, d).select(*KEY, questions_text(F.col("t"), CFG.rules()).alias("preguntas"))


def _count(x: str, word: str) -> str:
    return f"((length({x}) - length(replace({x}, '{word}', ''))) // {len(word)})"


_LINE = "who || ': ' || txt"


@query("turn_count_text", S.with_(S.TURN, select=(
    f"SELECT conv_id, CAST(greatest(sum({_count(_LINE, 'bot')}), sum({_count(_LINE, 'user')}), 1) AS BIGINT) AS turnos FROM turn GROUP BY conv_id"
)))
def turn_count_text(spark, d):
    counts = text_counts(turns(spark, d), CFG.role_words)
    return counts.select("conv_id", F.greatest("bot", "usuario", F.lit(1).cast("long")).alias("turnos"))


@query("turn_count_cell", S.with_(S.SEG, S.MSG, S.TALK, select=(
    f"SELECT conv_id, segmento, CAST(greatest({_count('transcript', 'bot')}, {_count('transcript', 'user')}, 1) AS INTEGER) AS turnos, "
    f"CAST({_count('lower(transcript)', 'user:')} AS INTEGER) AS preguntas FROM talk"
)))
def turn_count_cell(spark, d):
    """The same counts in one rendered cell, as they are read back from text."""
    return rendered(spark, d).select(*KEY, count_turns_text(F.col("t")).alias("turnos"), count_questions_text(F.col("t")).alias("preguntas"))


def _who():
    return canonical_role(F.col("role"), CFG.role_words)


@query("turn_count", (
    "SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS usuario, count(*) FILTER (WHERE role = 'assistant') AS bot, "
    "greatest(count(*) FILTER (WHERE role = 'user'), count(*) FILTER (WHERE role = 'assistant'), 1) AS turnos FROM conversations GROUP BY conv_id"
))
def turn_count(spark, d):
    """Straight from the turns: partial counts, so a long conversation costs one row per task."""
    counts = turns(spark, d).groupBy("conv_id").agg(
        F.count_if(_who() == "user").alias("usuario"), F.count_if(_who() == "bot").alias("bot")
    )
    return counts.withColumn("turnos", F.greatest("usuario", "bot", F.lit(1).cast("bigint")))


@query("question_count", S.with_(S.TURN, select=(
    f"SELECT conv_id, CAST(sum({_count(f'lower({_LINE})', 'user:')}) AS BIGINT) AS texto, count(*) FILTER (WHERE who = 'user') AS turnos FROM turn GROUP BY conv_id"
)))
def question_count(spark, d):
    return text_counts(turns(spark, d), CFG.role_words).select("conv_id", F.col("preguntas").alias("texto"), "turnos")


@query("transcript_split", S.with_(S.SEG, S.MSG, select=(
    "SELECT conv_id, segmento, CAST(row_number() OVER (PARTITION BY conv_id, segmento ORDER BY pos) - 1 AS INTEGER) AS pos, "
    f"who || ':' || CASE WHEN txt = '' THEN '' ELSE ' ' || replace(txt, chr(9), ' ') END AS mensaje FROM msg"
)))
def transcript_split(spark, d):
    return rendered(spark, d).select(*KEY, F.posexplode(split_transcript(F.col("t"))).alias("pos", "mensaje"))


_BY_ROLE = " ".join([
    "trim(regexp_replace(coalesce(string_agg(CASE WHEN who = '{0}' AND txt <> '' THEN txt END, ' ' ORDER BY pos), ''), ' {{2,}}', ' ', 'g'))",
])


@query("texts_by_role", S.with_(S.SEG, S.MSG, select=(
    f"SELECT conv_id, segmento, {_BY_ROLE.format('user')} AS usuario, {_BY_ROLE.format('bot')} AS bot, "
    "CAST(count(*) FILTER (WHERE who = 'user' AND txt <> '') AS INTEGER) AS n_usuario, "
    "CAST(count(*) FILTER (WHERE who = 'bot' AND txt <> '') AS INTEGER) AS n_bot FROM msg GROUP BY conv_id, segmento"
)))
def texts_by_role(spark, d):
    t = F.col("m")
    return rendered(spark, d).select(*KEY, split_transcript(F.col("t")).alias("m")).select(
        *KEY,
        join_texts(texts_by_prefix(t, USER_PREFIXES)).alias("usuario"),
        join_texts(texts_by_prefix(t, BOT_PREFIXES)).alias("bot"),
        F.size(user_texts(t)).alias("n_usuario"), F.size(bot_texts(t)).alias("n_bot"),
    )


@query("last_exchange", S.with_(S.TURN, S.LAST, select=(
    f"SELECT conv_id, {S.single_line('pregunta')} AS pregunta, {S.single_line('respuesta')} AS respuesta FROM whole"
)))
def last_exchange_query(spark, d):
    rows = last_exchanges(turns(spark, d), CFG.user_roles, CFG.reply_roles)
    return rows.select("conv_id", single_line(F.col("pregunta")).alias("pregunta"), single_line(F.col("respuesta")).alias("respuesta"))


@query("last_exchange_cell", S.with_(S.SEG, S.EXCHANGE, select=(
    f"SELECT conv_id, segmento, {S.single_line('pregunta')} AS pregunta, {S.single_line('respuesta')} AS respuesta FROM exchange"
)))
def last_exchange_cell(spark, d):
    """The same of one stored item's messages, row by row."""
    asked, replied = last_exchange(F.col("messages"), CFG.user_roles, CFG.reply_roles)
    return conversations(spark, d).select(
        *KEY, single_line(asked).alias("pregunta"), single_line(replied).alias("respuesta")
    )


@query("tokens_by_role", S.with_(S.TURN, select=(
    f"SELECT conv_id, who, CAST(sum({S.tokens('txt')}) AS BIGINT) AS tokens, count(*) AS mensajes FROM turn GROUP BY conv_id, who"
)))
def tokens_by_role(spark, d):
    """Straight from the turns: summed per task before the shuffle."""
    spoken = turns(spark, d).select("conv_id", _who().alias("who"), message_text(F.col("text")).alias("text"))
    return spoken.groupBy("conv_id", "who").agg(
        F.sum(estimate_tokens(F.col("text"))).alias("tokens"), F.count(F.lit(1)).alias("mensajes")
    )


@query("question_coverage", S.with_(S.TURN, S.QUESTION, select=(
    "SELECT count(*) AS conversaciones, count(*) FILTER (WHERE n > 0) AS con_pregunta, count(*) FILTER (WHERE n > 1) AS con_varias FROM per_conv"
)))
def question_coverage_query(spark, d):
    return question_coverage(question_counts(turns(spark, d), CFG.role_words))
