"""Joins: last feedback, excluded names, as-of matches, profiles, row concat."""

from __future__ import annotations

from pyspark.sql import functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import CFG, event_items, events, items, table, whole_items
from charlake.checks.registry import query
from charlake.config import PROFILE_FIELDS
from charlake.operators import reports
from charlake.operators.asof import asof_join
from charlake.operators.joins import join_latest, without_names, without_names_table
from charlake.plans.feedback_table import dropped_feedback, match_feedback, user_profiles, with_user_profile
from charlake.sources.items import CONVERSATION, FEEDBACK, is_kind, is_other

FIELDS = ("type", "comment", "option")

LATEST = (
    "latest AS (SELECT usuario_id, arg_max(struct_pack(t := fb_type, c := fb_comment, o := fb_option), (item_ts, sk)) AS f "
    "FROM items WHERE kind = 'FEEDBACK' GROUP BY usuario_id)"
)


def flat(rows):
    return rows.select("usuario_id", "sk", "item_ts", *[F.col(f"feedback.{f}").alias(f) for f in FIELDS])


@query("latest_feedback_join", S.with_(S.EV, S.SEG, S.ITEMS, LATEST, select=(
    "SELECT i.usuario_id, i.sk, l.f.t AS type, l.f.c AS comment, l.f.o AS option FROM items i "
    "LEFT JOIN latest l ON l.usuario_id = i.usuario_id WHERE i.kind = 'CONVERSATION'"
)))
def latest_feedback_join(spark, d):
    all_items = items(spark, d)
    given = flat(event_items(spark, d).where(is_kind(FEEDBACK)))
    joined = join_latest(flat(all_items.where(is_kind(CONVERSATION))), given, "usuario_id", FIELDS, ("item_ts", "sk"))
    return joined.select("usuario_id", "sk", *FIELDS)


@query("merge_union", S.with_(S.EV, S.SEG, S.ITEMS, LATEST, select=(
    "SELECT i.usuario_id, i.sk, l.f.t AS type, CAST(NULL AS VARCHAR) AS nombre FROM items i "
    "LEFT JOIN latest l ON l.usuario_id = i.usuario_id WHERE i.kind = 'CONVERSATION' "
    "UNION ALL SELECT usuario_id, sk, NULL, nombre FROM items WHERE kind = 'VISIT'"
)))
def merge_union(spark, d):
    """Merged conversations and the other rows by column name; columns one side lacks are NULL."""
    merged = latest_feedback_join(spark, d).select("usuario_id", "sk", "type")
    others = event_items(spark, d).where(is_other()).select("sk", "usuario_id", "profile.nombre")
    return merged.unionByName(others, allowMissingColumns=True)


# Names to leave out, as a list and as a table: customers of the poorest twentieth.
_EXCLUDED = "SELECT c_name FROM customer WHERE c_acctbal < 0"


@query("exclude_names_anti", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    f"SELECT usuario_id, sk, nombre FROM items WHERE NOT coalesce(lower({S.strip('nombre')}) IN ("
    + ", ".join(f"'{n}'" for n in CFG.excluded_names)
    + f"), false) AND NOT coalesce(lower({S.strip('nombre')}) IN (SELECT lower(c_name) FROM customer WHERE c_acctbal < 0), false)"
)))
def exclude_names_anti(spark, d):
    rows = items(spark, d).select("usuario_id", "sk", "profile.nombre")
    poor = table(spark, d, "customer").where("c_acctbal < 0").select("c_name")
    return without_names_table(without_names(rows, "nombre", CFG.excluded_names), "nombre", poor, "c_name")


@query("asof_simple", (
    "SELECT f.event_id, f.user_id, v.event_id AS previo, v.event_type AS tipo, v.event_id IS NOT NULL AS matched "
    "FROM (SELECT * FROM events WHERE event_type = 'error') f "
    "ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'error') v ON f.user_id = v.user_id AND f.ts >= v.ts"
))
def asof_simple(spark, d):
    """Every error with the user's last other event before it."""
    rows = events(spark, d).select("event_id", "user_id", "ts", "event_type")
    errors = rows.where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    others = rows.where(F.col("event_type") != "error").select(
        "user_id", "ts", F.col("event_id").alias("previo"), F.col("event_type").alias("tipo")
    )
    matched = asof_join(
        errors, others, by=["user_id"], on="ts", payload=["previo", "tipo"], tie="previo", left_tie="event_id",
        rows_per_window=CFG.rows_per_window,
    )
    return matched.select("event_id", "user_id", "previo", "tipo", "matched")


MATCH = (
    "conv AS (SELECT i.usuario_id, i.sk, i.item_ts, "
    f"{S.single_line('x.pregunta')} AS mensaje_usuario, {S.single_line('x.respuesta')} AS mensaje_bot "
    "FROM items i JOIN whole x ON x.conv_id = i.conv_id "
    "WHERE i.usuario_id IS NOT NULL AND i.item_ts IS NOT NULL), "
    "fbk AS (SELECT * FROM items WHERE kind = 'FEEDBACK' AND usuario_id <> '' AND item_ts IS NOT NULL), "
    "hits AS (SELECT f.usuario_id, f.sk, "
    "arg_max(struct_pack(u := c.mensaje_usuario, b := c.mensaje_bot), (c.item_ts, c.sk)) FILTER (WHERE c.mensaje_usuario <> '') AS best, "
    "arg_min(struct_pack(u := c.mensaje_usuario, b := c.mensaje_bot), (c.item_ts, c.sk)) AS oldest "
    "FROM fbk f JOIN conv c ON c.usuario_id = f.usuario_id AND c.item_ts <= f.item_ts GROUP BY ALL), "
    "matched AS (SELECT f.*, coalesce(h.best, h.oldest) AS m FROM fbk f LEFT JOIN hits h ON h.usuario_id = f.usuario_id AND h.sk = f.sk)"
)


@query("feedback_asof", S.with_(S.EV, S.TURN, S.LAST, S.WHOLE_ITEMS, MATCH, select=(
    "SELECT usuario_id, sk, m.u AS mensaje_usuario, m.b AS mensaje_bot, m IS NOT NULL AS matched FROM matched"
)))
def feedback_asof(spark, d):
    return match_feedback(whole_items(spark, d), CFG).select("usuario_id", "sk", "mensaje_usuario", "mensaje_bot", "matched")


def _last(f: str) -> str:
    return f"coalesce(arg_max({S.strip(f)}, (item_ts, sk)) FILTER (WHERE NOT {S.blank(f)}), '') AS {f}"


PROFILES = (
    f"prof AS (SELECT usuario_id, {', '.join(_last(f) for f in PROFILE_FIELDS)} FROM items "
    "WHERE kind = 'CONVERSATION' AND usuario_id IS NOT NULL GROUP BY usuario_id)"
)

PROFILED = (
    "profiled AS (SELECT m.usuario_id, m.sk, m.item_ts, CAST(m.created_at AS DATE) AS fecha, "
    "coalesce(m.m.u, '') AS mensaje_usuario, coalesce(m.m.b, '') AS mensaje_bot, m.m IS NOT NULL AS matched, "
    f"coalesce(m.fb_type, '') AS feedback, {S.single_line('m.fb_comment')} AS comentario, coalesce(m.fb_option, '') AS opcion_respuesta, "
    + ", ".join(f"CASE WHEN m.m IS NOT NULL THEN p.{f} ELSE {S.clean('m.' + f)} END AS {f}" for f in PROFILE_FIELDS)
    + " FROM matched m LEFT JOIN prof p ON p.usuario_id = m.usuario_id)"
)


@query("feedback_profile", S.with_(S.EV, S.TURN, S.LAST, S.WHOLE_ITEMS, MATCH, PROFILES, PROFILED, select=(
    f"SELECT usuario_id, sk, matched, {', '.join(PROFILE_FIELDS)} FROM profiled"
)))
def feedback_profile(spark, d):
    rows = whole_items(spark, d)
    full = with_user_profile(match_feedback(rows, CFG), user_profiles(rows))
    return full.select("usuario_id", "sk", "matched", *PROFILE_FIELDS)


@query("feedback_profile_latest", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT usuario_id, "
    + ", ".join(f"arg_max({S.clean(f)}, (item_ts, sk)) AS {f}" for f in PROFILE_FIELDS)
    + " FROM items WHERE kind = 'CONVERSATION' AND usuario_id IS NOT NULL GROUP BY usuario_id"
)))
def feedback_profile_latest(spark, d):
    """Only the last conversation's fields, blank ones too."""
    return user_profiles(items(spark, d), mode="latest")


@query("match_stats", S.with_(S.EV, S.TURN, S.LAST, S.WHOLE_ITEMS, MATCH, select=(
    "SELECT (SELECT count(*) FROM items WHERE kind = 'FEEDBACK') AS feedback, "
    "count(*) FILTER (WHERE m IS NOT NULL) AS con_conversacion, count(*) FILTER (WHERE m IS NULL) AS sin_conversacion, "
    "(SELECT count(*) FROM items WHERE kind = 'FEEDBACK' AND (usuario_id IS NULL OR usuario_id = '' OR item_ts IS NULL)) AS descartados FROM matched"
)))
def match_stats(spark, d):
    """Matched, unmatched and dropped feedback, each counted apart."""
    rows = whole_items(spark, d)
    dropped = dropped_feedback(rows).select(F.lit(None).cast("boolean").alias("matched"))
    seen = match_feedback(rows, CFG).select("matched").unionByName(dropped)
    return reports.match_stats(seen)
