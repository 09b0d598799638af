"""Group-by operators on items."""

from __future__ import annotations

from pyspark.sql import functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import CFG, items
from charlake.checks.registry import query
from charlake.config import DIALOGUE_SEPARATOR, PROFILE_FIELDS
from charlake.functions.text import blank_to_empty
from charlake.functions.transcripts import render_messages
from charlake.operators.aggregates import first_non_blank, ordered_concat
from charlake.operators.parts import by_parts
from charlake.operators.reports import funnel, null_profile
from charlake.plans.user_table import ORDER
from charlake.sources.items import not_register

_KNOWN = "FROM items WHERE kind <> 'REGISTER' AND usuario_id IS NOT NULL GROUP BY usuario_id"


def known(spark, d):
    return items(spark, d).where(not_register() & F.col("usuario_id").isNotNull()).select("usuario_id", *ORDER, "profile.*")


def _first(f: str, more: str = "") -> str:
    return f"coalesce(arg_min({f}, (item_ts, sk)) FILTER (WHERE NOT {S.blank(f)}{more}), '')"


@query("first_non_empty", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT usuario_id, " + ", ".join(f"{_first(f)} AS {f}" for f in PROFILE_FIELDS[1:]) + f" {_KNOWN}"
)))
def first_non_empty(spark, d):
    order = F.struct(*ORDER)
    return known(spark, d).groupBy("usuario_id").agg(*[first_non_blank(F.col(f), order).alias(f) for f in PROFILE_FIELDS[1:]])


@query("first_real_name", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    f"SELECT usuario_id, coalesce(arg_min({S.strip('nombre')}, (item_ts, sk)) FILTER (WHERE NOT {S.blank('nombre')} "
    f"AND {S.strip('nombre')} <> 'PRUEBAS QA'), '{CFG.anonymous_label}') AS nombre {_KNOWN}"
)))
def first_real_name(spark, d):
    """As the label, one more name is passed over."""
    name = blank_to_empty(F.col("nombre"))
    label = CFG.anonymous_label
    return known(spark, d).groupBy("usuario_id").agg(
        first_non_blank(name, F.struct(*ORDER), default=label, ignore=(label, "PRUEBAS QA")).alias("nombre")
    )


@query("ordered_concat", S.with_(S.EV, S.SEG, S.MSG, S.TALK, S.ITEMS, (
    "numbered AS (SELECT i.usuario_id, i.item_ts, i.sk, t.transcript, "
    f"CAST((row_number() OVER (PARTITION BY i.usuario_id ORDER BY i.item_ts, i.sk) - 1) // {CFG.items_per_row} AS INTEGER) AS parte "
    "FROM items i JOIN talk t ON t.conv_id = i.conv_id AND t.segmento = i.segmento WHERE i.usuario_id IS NOT NULL)"
), select=(
    "SELECT usuario_id, parte, string_agg(transcript, ' || ' ORDER BY item_ts, sk) AS conversaciones FROM numbered GROUP BY usuario_id, parte"
)))
def ordered_concat_query(spark, d):
    """A user's dialogues in time order; long histories go on in further parts."""
    rows = items(spark, d).where((F.col("kind") == "CONVERSATION") & F.col("usuario_id").isNotNull()).select(
        "usuario_id", *ORDER, render_messages(F.col("messages"), CFG.role_words).alias("t")
    )

    def build(part_rows, group):
        return part_rows.groupBy(*group).agg(
            ordered_concat(F.col("t"), [F.col(o) for o in ORDER], DIALOGUE_SEPARATOR).alias("conversaciones")
        )

    return by_parts(rows, ["usuario_id"], ORDER, CFG.items_per_row, "parte", build)


@query("column_null_profile", S.with_(S.EV, S.SEG, S.ITEMS, select=" UNION ALL ".join(
    f"SELECT '{f}' AS columna, count({f}) AS validos, count(*) - count({f}) AS nulos FROM items"
    for f in ("usuario_id", "created_at", *PROFILE_FIELDS, "fb_type", "fb_comment", "fb_option")
)))
def column_null_profile(spark, d):
    return null_profile(items(spark, d).select(
        "usuario_id", "created_at", "profile.*",
        *[F.col(f"feedback.{f}").alias(f"fb_{f}") for f in ("type", "comment", "option")],
    ))


@query("filter_funnel", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT 0 AS paso, 'inicial' AS nombre, count(*) AS filas FROM items "
    "UNION ALL SELECT 1, 'sin_registro', count(*) FROM items WHERE kind <> 'REGISTER' "
    "UNION ALL SELECT 2, 'con_usuario', count(*) FROM items WHERE kind <> 'REGISTER' AND usuario_id IS NOT NULL "
    "UNION ALL SELECT 3, 'con_fecha', count(*) FROM items WHERE kind <> 'REGISTER' AND usuario_id IS NOT NULL AND created_at IS NOT NULL"
)))
def filter_funnel(spark, d):
    return funnel(items(spark, d), {
        "sin_registro": not_register(), "con_usuario": F.col("usuario_id").isNotNull(), "con_fecha": F.col("created_at").isNotNull(),
    })


