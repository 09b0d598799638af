"""Attributes and keys that are not known beforehand."""

from __future__ import annotations

from pyspark.sql import functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import event_items, events
from charlake.checks.registry import query
from charlake.operators.scratch import new_path
from charlake.sources.attributes import attribute, key_census, key_rows, read_typed_attributes
from charlake.sources.items import FEEDBACK, is_kind


def _s(c):
    return F.struct(c.cast("string").alias("S"))


def _n(c):
    return F.struct(c.cast("string").alias("N"))


@query("typed_attributes", S.with_(S.EV, select=(
    "SELECT CAST(event_id AS VARCHAR) AS sk, CAST(user_id AS VARCHAR) AS usuario_id, CAST(k AS BIGINT) AS nivel, event_type || ' \"' || CAST(k AS VARCHAR) || '\"' AS marca, "
    "CAST(k + 1 AS BIGINT) AS hondo, CAST(k / 4.0 AS DOUBLE) AS medida, CASE WHEN k > 50 THEN true ELSE false END AS activo, "
    "CASE WHEN k % 2 = 0 THEN 'a' ELSE 'b' END AS etiqueta, true AS vacio FROM ev"
)))
def typed_attributes(spark, d):
    """Two further attributes with maps in lists in maps, number and text sets, and a NULL, from an export."""
    k, path = F.col("k"), new_path(spark, "attributes")
    marks = F.concat(
        F.lit('{"L":['), F.to_json(_s(F.concat("event_type", F.lit(' "'), k.cast("string"), F.lit('"')))),
        F.lit(',{"M":{"dentro":{"L":[{"M":{"v":'), F.to_json(_n(k + 1)), F.lit("}}]}}}]}"),
    )
    text = F.concat(
        F.lit('{"Item":{"PK":'), F.to_json(_s(F.concat(F.lit("USER#"), F.col("user_id").cast("string")))), F.lit(',"SK":'), F.to_json(_s(F.col("event_id"))),
        F.lit(',"Detalle":{"M":{"nivel":'), F.to_json(_n(k)), F.lit(',"marcas":'), marks,
        F.lit('}},"Medidas":{"NS":["0","'), (k / 4).cast("string"), F.lit('"]},"Etiquetas":{"SS":["'), F.when(k % 2 == 0, "a").otherwise("b"),
        F.lit('"]},"Activo":{"BOOL":'), (k > 50).cast("string"), F.lit('},"Vacio":{"NULL":true}}}'),
    )
    events(spark, d).select(text.alias("value")).write.text(path)
    return read_typed_attributes(spark, path).select(
        "sk", "usuario_id", attribute("$.Detalle.nivel", "bigint").alias("nivel"), attribute("$.Detalle.marcas[0]", "string").alias("marca"),
        attribute("$.Detalle.marcas[1].dentro[0].v", "bigint").alias("hondo"), attribute("$.Medidas[1]", "double").alias("medida"),
        attribute("$.Activo", "boolean").alias("activo"), attribute("$.Etiquetas[0]", "string").alias("etiqueta"),
        F.is_variant_null(F.try_variant_get("atributos", "$.Vacio", "variant")).alias("vacio"),
    )


def _given(spark, d):
    """Feedback texts with keys of three kinds besides the usual ones; a tenth is no JSON."""
    k = F.regexp_extract("sk", r"\.(\d+)Z$", 1).cast("int") % 10
    more = F.to_json(F.struct(
        F.col("feedback.type").alias("type"), F.col("feedback.comment").alias("comment"), k.alias("puntos"),
        F.when(k > 4, F.array(F.lit("web"), F.col("profile.gerencia"))).alias("canales"), F.struct((k > 6).alias("grave")).alias("extra"),
    ))
    return event_items(spark, d).where(is_kind(FEEDBACK) & F.col("usuario_id").isNotNull()).select(
        "usuario_id", "sk", F.when(k == 3, F.concat(F.lit("texto "), k.cast("string"))).otherwise(more).alias("texto")
    )


_GIVEN = (
    "src AS (SELECT usuario_id, sk, fb_type, fb_comment, CAST(regexp_extract(sk, '\\.(\\d+)Z$', 1) AS INTEGER) % 10 AS n, gerencia FROM items WHERE kind = 'FEEDBACK' AND usuario_id IS NOT NULL)"
)
_ROWS = (
    "keyed_rows AS (SELECT usuario_id, sk, '' AS clave, 'texto ' || n AS valor FROM src WHERE n = 3 "
    "UNION ALL SELECT s.usuario_id, s.sk, j.key AS clave, CASE j.type WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN j.value ->> '$' ELSE CAST(j.value AS VARCHAR) END AS valor "
    "FROM src s, json_each(CAST(json_merge_patch(json_object('type', fb_type, 'comment', fb_comment, 'puntos', n, 'extra', json_object('grave', n > 6)), "
    "CASE WHEN n > 4 THEN json_object('canales', json_array('web', gerencia)) ELSE '{}' END) AS VARCHAR)) j WHERE n <> 3)"
)


@query("feedback_keys", S.with_(S.EV, S.SEG, S.ITEMS, _GIVEN, _ROWS, select="SELECT usuario_id, sk, clave, valor FROM keyed_rows"))
def feedback_keys(spark, d):
    """Every key of the feedback objects as a row of its own, and texts that are no object."""
    return key_rows(_given(spark, d), "texto").drop("tipo")


@query("feedback_key_census", S.with_(S.EV, S.SEG, S.ITEMS, _GIVEN, _ROWS, select="SELECT clave, count(*) AS filas, count(valor) AS con_valor FROM keyed_rows GROUP BY clave"))
def feedback_key_census(spark, d):
    return key_census(key_rows(_given(spark, d), "texto")).drop("tipos")
