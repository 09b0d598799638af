"""The finished tables and the reports on them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from charlake.catalog.tables import FEEDBACK_VIEW, USER_VIEW, register_views
from charlake.checks import sql as S
from charlake.checks.fixture import CFG, text_cells, whole_items
from charlake.checks.join_queries import LATEST, MATCH, PROFILED, PROFILES
from charlake.checks.registry import query
from charlake.config import FEEDBACK_TABLE_COLUMNS, PROFILE_FIELDS
from charlake.operators.reports import feedback_totals, run_totals
from charlake.plans import build_feedback_table, build_user_table, render_user_table, type_user_table
from charlake.plans.user_table import user_values

_OWN = "NOT es_feedback"


def _first(f: str, label: str = "") -> str:
    return f"coalesce(arg_min({f}, (item_ts, sk)) FILTER (WHERE {_OWN} AND NOT {S.blank(f)} AND {f} <> '{label}'), '{label}') AS {f}"


_TEXT = (
    "'{\"type\": ' || to_json(coalesce(fb_type, '')) || ', \"comment\": ' || to_json(coalesce(fb_comment, '')) "
    "|| ', \"option\": ' || to_json(coalesce(fb_option, '')) || '}'"
)

# A value said in feedback, usable or NULL.
_SAID = "CASE WHEN trim({0}) IS NOT NULL AND lower(trim({0})) NOT IN ('', 'none', 'null') THEN trim({0}) END"

_USER_LEVEL = (
    "who AS (SELECT usuario_id, " + _first("nombre", CFG.anonymous_label) + ", "
    + ", ".join(_first(f) for f in PROFILE_FIELDS[1:])
    + f", arg_min_null(fecha, (item_ts, sk)) FILTER (WHERE {_OWN}) AS fecha_primera_conversacion "
    f"FROM base GROUP BY usuario_id HAVING count(*) FILTER (WHERE {_OWN}) > 0)"
)

BASE = (
    f"base AS (SELECT k.*, CASE WHEN {_OWN} THEN greatest(coalesce(t.n_user, 0), coalesce(t.n_bot, 0), 1) END AS turnos, "
    f"CASE WHEN {_OWN} THEN coalesce(t.n_user, 0) END AS n_preguntas, "
    f"CASE WHEN es_feedback THEN {_TEXT} END AS feedback_text "
    "FROM kept k LEFT JOIN tally t ON t.conv_id = k.conv_id)"
)

_ORDERED = "coalesce(string_agg({0}, ' || ' ORDER BY item_ts, sk), '')"


def _part(order: str, rows: int) -> str:
    return f"CAST((row_number() OVER (PARTITION BY usuario_id ORDER BY {order}) - 1) // {rows} AS INTEGER) AS parte"


# Texts only are in cells; everything else is the user's.
_TEXTS = (
    "cell AS (SELECT b.usuario_id, b.item_ts, b.sk, b.conv_id, coalesce(t.segmento, 0) AS segmento, nullif(t.transcript, '') AS transcript, "
    "nullif(a.preguntas, '') AS pregunta, CASE WHEN coalesce(t.segmento, 0) = 0 THEN b.feedback_text END AS feedback_text "
    "FROM base b LEFT JOIN talk t ON t.conv_id = b.conv_id LEFT JOIN asked a ON a.conv_id = b.conv_id AND a.segmento = t.segmento), "
    f"spoken AS (SELECT *, {_part('item_ts, sk, segmento', CFG.items_per_row)} FROM cell WHERE feedback_text IS NOT NULL OR transcript IS NOT NULL), "
    "joined AS (SELECT usuario_id, parte, item_ts, sk, string_agg(transcript, ' | ' ORDER BY segmento) AS transcript, "
    "max(feedback_text) AS feedback_text, string_agg(pregunta, ' | ' ORDER BY segmento) AS pregunta FROM spoken GROUP BY ALL), "
    f"texts AS (SELECT usuario_id, parte, {_ORDERED.format('transcript')} AS conversacion_completa, "
    f"{_ORDERED.format('feedback_text')} AS feedback_total, {_ORDERED.format('pregunta')} AS pregunta_conversacion "
    "FROM joined GROUP BY usuario_id, parte)"
)

USERS = (
    "said AS (SELECT usuario_id, o, item_ts, sk, v, row_number() OVER (PARTITION BY usuario_id, v ORDER BY o, item_ts, sk) AS nth FROM ("
    f"SELECT usuario_id, 0 AS o, item_ts, sk, {_SAID.format('fb_comment')} AS v FROM base WHERE es_feedback "
    f"UNION ALL SELECT usuario_id, 1, item_ts, sk, {_SAID.format('fb_option')} FROM base WHERE es_feedback) WHERE v IS NOT NULL), "
    "answers AS (SELECT usuario_id, parte, string_agg(v, ' | ' ORDER BY o, item_ts, sk) AS respuesta FROM ("
    f"SELECT *, {_part('o, item_ts, sk', CFG.answers_per_row)} FROM said WHERE nth = 1) GROUP BY usuario_id, parte), "
    "sums AS (SELECT usuario_id, CAST(coalesce(sum(turnos), 0) AS INTEGER) AS numero_conversaciones, "
    "CAST(count(*) FILTER (WHERE fb_type IN ('like', 'dislike')) AS INTEGER) AS numero_feedback, "
    "CAST(coalesce(sum(n_preguntas), 0) AS INTEGER) AS numero_preguntas, "
    "CASE WHEN bool_or(fb_type = 'like') AND bool_or(fb_type = 'dislike') THEN 'mixed' WHEN bool_or(fb_type = 'like') THEN 'like' "
    "WHEN bool_or(fb_type = 'dislike') THEN 'dislike' ELSE '' END AS feedback FROM base GROUP BY usuario_id), "
    f"{_TEXTS}, "
    "cells AS (SELECT * FROM texts FULL JOIN answers USING (usuario_id, parte)), "
    "users AS (SELECT w.usuario_id, w.nombre, w.gerencia, w.ciudad, w.oficinas_asesoras, w.subgerencia, w.nivel_directivo, "
    "w.fecha_primera_conversacion, s.numero_conversaciones, coalesce(c.conversacion_completa, '') AS conversacion_completa, "
    "coalesce(c.feedback_total, '') AS feedback_total, s.numero_feedback, coalesce(c.pregunta_conversacion, '') AS pregunta_conversacion, "
    "s.numero_preguntas, s.feedback, coalesce(c.respuesta, '') AS respuesta_feedback, coalesce(c.parte, 0) AS parte "
    "FROM who w JOIN sums s ON s.usuario_id = w.usuario_id LEFT JOIN cells c ON c.usuario_id = w.usuario_id)"
)

WHOLE = (S.EV, S.SEG, S.MSG, S.TALK, S.ASKED_FIRST, S.TURN, S.TALLY, S.WHOLE_ITEMS, S.KEPT)

USER_TABLES = (*WHOLE, BASE, _USER_LEVEL, USERS)


def users(spark, d, **more):
    return build_user_table(whole_items(spark, d), CFG, cells=text_cells(spark, d), **more)


@query("user_rollup", S.with_(*USER_TABLES, select="SELECT * FROM users"))
def user_rollup(spark, d):
    return users(spark, d)


# The user's last feedback stands on each conversation; counts come from the rendered text.
BASE_LATEST = (
    "base AS (SELECT k.usuario_id, k.sk, k.item_ts, k.fecha, false AS es_feedback, k.nombre, k.ciudad, k.gerencia, k.oficinas_asesoras, "
    "k.subgerencia, k.nivel_directivo, k.conv_id, greatest(coalesce(t.dice_bot, 0), coalesce(t.dice_usuario, 0), 1) AS turnos, "
    "coalesce(t.dice_preguntas, 0) AS n_preguntas, l.f.t AS fb_type, l.f.c AS fb_comment, l.f.o AS fb_option, "
    "k.kind FROM kept k LEFT JOIN tally t ON t.conv_id = k.conv_id "
    "LEFT JOIN latest l ON l.usuario_id = k.usuario_id AND k.kind = 'CONVERSATION' WHERE NOT k.es_feedback)"
)

USERS_LATEST = (
    f"given AS (SELECT *, CASE WHEN coalesce(fb_type, fb_comment, fb_option) IS NOT NULL THEN {_TEXT} END AS feedback_text FROM base), "
    "one AS (SELECT usuario_id, any_value(fb_type) AS t, any_value(fb_comment) AS c, any_value(fb_option) AS o "
    "FROM given WHERE feedback_text IS NOT NULL GROUP BY usuario_id), "
    "sums AS (SELECT usuario_id, CAST(sum(turnos) AS INTEGER) AS numero_conversaciones, CAST(count(feedback_text) AS INTEGER) AS numero_feedback, "
    "CAST(sum(n_preguntas) AS INTEGER) AS numero_preguntas FROM given GROUP BY usuario_id), "
    + _TEXTS.replace("FROM base b", "FROM given b") + ", "
    "users AS (SELECT w.usuario_id, w.nombre, w.gerencia, w.ciudad, w.oficinas_asesoras, w.subgerencia, w.nivel_directivo, "
    "w.fecha_primera_conversacion, s.numero_conversaciones, coalesce(c.conversacion_completa, '') AS conversacion_completa, "
    "coalesce(c.feedback_total, '') AS feedback_total, s.numero_feedback, coalesce(c.pregunta_conversacion, '') AS pregunta_conversacion, "
    "s.numero_preguntas, CASE WHEN o.t IN ('like', 'dislike') THEN o.t ELSE '' END AS feedback, "
    f"concat_ws(' | ', replace({_SAID.format('o.c')}, chr(10), chr(92) || 'n'), {_SAID.format('o.o')}) AS respuesta_feedback, coalesce(c.parte, 0) AS parte "
    "FROM who w JOIN sums s ON s.usuario_id = w.usuario_id LEFT JOIN one o ON o.usuario_id = w.usuario_id LEFT JOIN texts c ON c.usuario_id = w.usuario_id)"
)


@query("user_rollup_latest_feedback", S.with_(
    *WHOLE, LATEST, BASE_LATEST, _USER_LEVEL, USERS_LATEST,
    select="SELECT * FROM users",
))
def user_rollup_latest_feedback(spark, d):
    return users(spark, d, feedback="latest_on_each")


@query("user_table_rendered", S.with_(*USER_TABLES, select=(
    f"SELECT usuario_id, nombre, coalesce(strftime(fecha_primera_conversacion, '%d/%m/%Y'), '{CFG.no_date_label}') AS fecha_primera_conversacion, "
    "CAST(numero_conversaciones AS VARCHAR) AS numero_conversaciones, CAST(parte AS VARCHAR) AS parte FROM users"
)))
def user_table_rendered(spark, d):
    return render_user_table(users(spark, d), CFG).select(
        "usuario_id", "nombre", "fecha_primera_conversacion", "numero_conversaciones", "parte"
    )


TYPED = (
    f"worth AS (SELECT b.usuario_id, b.parte, m.who, sum({S.tokens('m.txt')}) AS tokens FROM spoken b "
    "JOIN msg m ON m.conv_id = b.conv_id AND m.segmento = b.segmento GROUP BY ALL), "
    "typed AS (SELECT usuario_id, nombre, gerencia, ciudad, oficinas_asesoras, subgerencia, nivel_directivo, fecha_primera_conversacion, "
    "nullif(numero_conversaciones, 0) AS numero_conversaciones, conversacion_completa, feedback_total, "
    "nullif(numero_feedback, 0) AS numero_feedback, pregunta_conversacion, numero_preguntas, nullif(feedback, '') AS feedback, "
    "CASE WHEN feedback <> '' THEN respuesta_feedback END AS respuesta_feedback, parte, "
    "CAST(coalesce((SELECT tokens FROM worth s WHERE s.usuario_id = u.usuario_id AND s.parte = u.parte AND s.who = 'user'), 0) AS INTEGER) AS token_pregunta, "
    "CAST(coalesce((SELECT tokens FROM worth s WHERE s.usuario_id = u.usuario_id AND s.parte = u.parte AND s.who = 'bot'), 0) AS INTEGER) AS token_respuesta "
    "FROM users u WHERE conversacion_completa <> '')"
)


@query("typed_user_table", S.with_(*USER_TABLES, TYPED, select="SELECT * FROM typed"))
def typed_user_table(spark, d):
    """From the rendered text, as it comes back from CSV."""
    return type_user_table(render_user_table(users(spark, d), CFG), CFG)


# A caller's tokenizer: words between blanks.
def word_counter():
    @F.pandas_udf("int")
    def words(texts: pd.Series) -> pd.Series:
        return texts.str.count("[^ ]+")

    return words


@query("typed_user_table_udf", S.with_(*USER_TABLES, TYPED.replace(S.tokens("m.txt"), "len(regexp_extract_all(m.txt, '[^ ]+'))"), select=(
    "SELECT usuario_id, parte, token_pregunta, token_respuesta FROM typed"
)))
def typed_user_table_udf(spark, d):
    """Tokens by a caller's pandas UDF in place of the estimate."""
    typed = type_user_table(render_user_table(users(spark, d), CFG), CFG, word_counter())
    return typed.select("usuario_id", "parte", "token_pregunta", "token_respuesta")


_PER_USER = (
    "per_user AS (SELECT usuario_id, any_value(nombre) AS nombre, any_value(numero_conversaciones) AS numero_conversaciones, any_value(feedback) AS feedback, "
    "bool_or(conversacion_completa <> '') AS con_transcript, bool_or(pregunta_conversacion <> '') AS con_preguntas FROM users GROUP BY usuario_id)"
)


@query("drop_blank_transcripts", S.with_(*USER_TABLES, _PER_USER, select=(
    "SELECT count(*) AS antes, count(*) FILTER (WHERE con_transcript) AS despues, "
    "count(*) FILTER (WHERE NOT con_transcript) AS eliminados FROM per_user"
)))
def drop_blank_transcripts(spark, d):
    """Users before and after, from the values alone."""
    spoken = F.col("con_transcript")
    return user_values(whole_items(spark, d), CFG).agg(
        F.count(F.lit(1)).alias("antes"), F.count_if(spoken).alias("despues"), F.count_if(~spoken).alias("eliminados")
    )


@query("run_totals", S.with_(*USER_TABLES, _PER_USER, select=(
    "SELECT count(*) AS usuarios_procesados, CAST(sum(numero_conversaciones) AS BIGINT) AS total_conversaciones, "
    "count(*) FILTER (WHERE feedback <> '') AS usuarios_con_feedback, count(*) FILTER (WHERE con_preguntas) AS usuarios_con_preguntas, "
    f"count(*) FILTER (WHERE nombre <> '{CFG.anonymous_label}') AS nombres_reales FROM per_user"
)))
def run_totals_query(spark, d):
    return run_totals(user_values(whole_items(spark, d), CFG), CFG.anonymous_label)


FEEDBACK_TABLES = (S.EV, S.TURN, S.LAST, S.WHOLE_ITEMS, MATCH, PROFILES, PROFILED, (
    "fbt AS (SELECT " + ", ".join(FEEDBACK_TABLE_COLUMNS) + f" FROM profiled WHERE NOT lower({S.strip('nombre')}) IN ("
    + ", ".join(f"'{n}'" for n in CFG.excluded_names) + "))"
))


@query("feedback_table", S.with_(*FEEDBACK_TABLES, select="SELECT * FROM fbt"))
def feedback_table(spark, d):
    return build_feedback_table(whole_items(spark, d), CFG)


@query("feedback_totals", S.with_(*FEEDBACK_TABLES, select=(
    "SELECT count(*) AS total_feedbacks, count(*) FILTER (WHERE feedback = 'like') AS likes, "
    "count(*) FILTER (WHERE feedback = 'dislike') AS dislikes, count(*) FILTER (WHERE comentario <> '') AS with_comments, "
    "count(*) FILTER (WHERE mensaje_usuario <> '') AS with_user_messages, count(*) FILTER (WHERE mensaje_bot <> '') AS with_bot_messages FROM fbt"
)))
def feedback_totals_query(spark, d):
    return feedback_totals(build_feedback_table(whole_items(spark, d), CFG))


@query("sql_user_report", S.with_(*USER_TABLES, TYPED, select=(
    "SELECT ciudad, count(*) AS usuarios, CAST(sum(n) AS BIGINT) AS conversaciones, count(f) AS con_feedback, CAST(sum(t) AS BIGINT) AS tokens FROM ("
    "SELECT usuario_id, ciudad, any_value(numero_conversaciones) AS n, any_value(feedback) AS f, sum(token_pregunta + token_respuesta) AS t "
    "FROM typed GROUP BY usuario_id, ciudad) GROUP BY ciudad"
)))
def sql_user_report(spark, d):
    """SQL over the curated view."""
    register_views(users=type_user_table(users(spark, d), CFG))
    return spark.sql(
        "SELECT ciudad, count(*) AS usuarios, sum(n) AS conversaciones, count(f) AS con_feedback, sum(t) AS tokens FROM ("
        "SELECT usuario_id, ciudad, max(numero_conversaciones) AS n, max(feedback) AS f, sum(token_pregunta + token_respuesta) AS t "
        f"FROM {USER_VIEW} GROUP BY usuario_id, ciudad) GROUP BY ciudad"
    )


@query("sql_feedback_report", S.with_(*FEEDBACK_TABLES, select=(
    "SELECT fecha, feedback, count(*) AS filas, count(DISTINCT usuario_id) AS usuarios FROM fbt GROUP BY fecha, feedback"
)))
def sql_feedback_report(spark, d):
    register_views(feedback=build_feedback_table(whole_items(spark, d), CFG))
    return spark.sql(
        f"SELECT fecha, feedback, count(*) AS filas, count(DISTINCT usuario_id) AS usuarios FROM {FEEDBACK_VIEW} GROUP BY fecha, feedback"
    )
