"""Feedback values: counts, classes and answers, from structs and from stored text."""

from __future__ import annotations

from pyspark.sql import functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import event_items
from charlake.checks.registry import query
from charlake.functions import feedback as fb
from charlake.functions.text import is_blank
from charlake.operators.parts import by_parts
from charlake.sources.items import FEEDBACK, is_kind

FB = "fb AS (SELECT usuario_id, sk, item_ts, fb_type, fb_comment, fb_option FROM items WHERE kind = 'FEEDBACK' AND usuario_id IS NOT NULL)"

ANSWERS_PER_ROW = 10_000


def given(spark, d):
    return event_items(spark, d).where(is_kind(FEEDBACK) & F.col("usuario_id").isNotNull()).select(
        "usuario_id", "sk", "item_ts", "feedback.*"
    )


def stored(spark, d):
    """The stored text form, single or double quoted."""
    double = fb.feedback_text(F.col("type"), F.col("comment"), F.col("option"))
    quoted = F.when(F.col("type") == "like", F.translate(double, '"', "'")).otherwise(double)
    return given(spark, d).select("usuario_id", "sk", quoted.alias("texto"))


@query("feedback_count", S.with_(S.EV, S.SEG, S.ITEMS, FB, select=(
    "SELECT usuario_id, count(*) FILTER (WHERE fb_type IN ('like', 'dislike')) AS por_tipo, CAST(count(*) AS BIGINT) AS por_texto FROM fb GROUP BY usuario_id"
)))
def feedback_count(spark, d):
    """By type, and by text: a text without a known type still counts as one."""
    double = fb.feedback_text(F.col("type"), F.col("comment"), F.col("option"))
    return given(spark, d).groupBy("usuario_id").agg(
        F.count_if(F.lower("type").isin("like", "dislike")).alias("por_tipo"),
        F.sum(fb.count_text(double)).alias("por_texto"),
    )


_CLASS = (
    "CASE WHEN bool_or(fb_type = 'like') AND bool_or(fb_type = 'dislike') THEN 'mixed' "
    "WHEN bool_or(fb_type = 'like') THEN 'like' WHEN bool_or(fb_type = 'dislike') THEN 'dislike' ELSE '' END"
)


@query("feedback_class", S.with_(S.EV, S.SEG, S.ITEMS, FB, select=f"SELECT usuario_id, {_CLASS} AS feedback FROM fb GROUP BY usuario_id"))
def feedback_class(spark, d):
    word = F.lower(F.trim("type"))
    return given(spark, d).groupBy("usuario_id").agg(
        fb.class_of(
            F.coalesce(F.bool_or(word == "like"), F.lit(False)), F.coalesce(F.bool_or(word == "dislike"), F.lit(False))
        ).alias("feedback")
    )


@query("feedback_class_text", S.with_(S.EV, S.SEG, S.ITEMS, FB, select="SELECT usuario_id, sk, fb_type AS feedback FROM fb"))
def feedback_class_text(spark, d):
    return stored(spark, d).select("usuario_id", "sk", fb.class_text(F.col("texto")).alias("feedback"))


@query("feedback_answers_text", S.with_(S.EV, S.SEG, S.ITEMS, FB, select=(
    "SELECT usuario_id, sk, concat_ws(' | ', CASE WHEN fb_comment <> '' AND lower(fb_comment) <> 'none' "
    "THEN replace(fb_comment, chr(10), chr(92) || 'n') END, nullif(fb_option, '')) AS respuesta FROM fb"
)))
def feedback_answers_text(spark, d):
    """The text form keeps a line break escaped, as it was stored."""
    return stored(spark, d).select("usuario_id", "sk", fb.answers_text(F.col("texto")).alias("respuesta"))


@query("feedback_answers", S.with_(S.EV, S.SEG, S.ITEMS, FB, (
    "said AS (SELECT usuario_id, 0 AS orden, trim(fb_comment) AS valor, item_ts, sk FROM fb UNION ALL SELECT usuario_id, 1, trim(fb_option), item_ts, sk FROM fb)"
), (
    "uniq AS (SELECT usuario_id, valor, min(orden) AS orden, arg_min(sk, (orden, item_ts, sk)) AS sk, min(item_ts) AS t0, "
    "arg_min(item_ts, (orden, item_ts, sk)) AS item_ts FROM said "
    "WHERE valor IS NOT NULL AND lower(valor) NOT IN ('', 'none', 'null', 'nan') GROUP BY usuario_id, valor)"
), (
    f"part AS (SELECT *, CAST((row_number() OVER (PARTITION BY usuario_id ORDER BY orden, item_ts, sk) - 1) // {ANSWERS_PER_ROW} AS INTEGER) AS parte FROM uniq)"
), select="SELECT usuario_id, parte, string_agg(valor, ' | ' ORDER BY orden, item_ts, sk) AS respuestas FROM part GROUP BY usuario_id, parte"))
def feedback_answers(spark, d):
    """Each answer of a user once: comments in time order, then options. Repeats go before the shuffle."""
    rows = given(spark, d)
    said = rows.select("usuario_id", F.explode(F.array(
        F.struct(F.lit(0).alias("orden"), F.trim("comment").alias("valor"), "item_ts", "sk"),
        F.struct(F.lit(1).alias("orden"), F.trim("option").alias("valor"), "item_ts", "sk"),
    )).alias("s")).select("usuario_id", "s.*").where(~is_blank(F.col("valor")))
    first = said.groupBy("usuario_id", "valor").agg(F.min(F.struct("orden", "item_ts", "sk")).alias("o"))
    once = first.select("usuario_id", "valor", "o.orden", "o.item_ts", "o.sk")

    def build(part_rows, group):
        entry = F.struct("orden", "item_ts", "sk", "valor")
        ordered = F.array_sort(F.collect_list(entry))
        return part_rows.groupBy(*group).agg(
            F.array_join(F.transform(ordered, lambda e: e["valor"]), " | ").alias("respuestas")
        )

    return by_parts(once, ["usuario_id"], ["orden", "item_ts", "sk"], ANSWERS_PER_ROW, "parte", build)
