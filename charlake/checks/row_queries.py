"""Scans, projections, filters and scalar functions: no shuffle beyond the fixture's own."""

from __future__ import annotations

from pyspark.sql import functions as F

from charlake.checks import sql as S
from charlake.checks.fixture import CFG, CREATED, KIND, event_items, events, iso, items, table, turns
from charlake.checks.registry import query
from charlake.config import PROFILE_FIELDS
from charlake.functions.dates import in_window_or_null, parse_date, parse_timestamp, render_date
from charlake.functions.feedback import feedback_text, parse_feedback
from charlake.functions.text import blank_to_empty, drop_parenthesis, matches_any, normalize_transcript, single_line
from charlake.functions.tokens import estimate_tokens, quarter_tokens
from charlake.functions.transcripts import canonical_role, infer_question
from charlake.operators.reports import sample_rows
from charlake.operators.rules import with_inferred_question
from charlake.operators.shape import enforce_columns, typed_columns
from charlake.plans.user_table import clean_profile, with_default_city
from charlake.schemas import TYPED_SCALAR
from charlake.sources.items import (
    CONVERSATION, FEEDBACK, REGISTER, holds_kind, is_kind, is_other, not_register, profile_from_text, sort_key_kind, sort_key_time,
    typed_scalar, user_id,
)

# --- keys and profiles ------------------------------------------------------

# Sort keys good and bad: no kind, no time, a bad time, a date only.
_SK = (
    "CASE WHEN event_type = 'click' THEN 'CLICK' WHEN k < 10 THEN 'VISIT#' WHEN k < 20 THEN 'FEEDBACK#ayer' "
    "WHEN k < 30 THEN 'NOTE#2024-01-' || lpad(CAST(1 + user_id % 28 AS STRING), 2, '0') ELSE NULL END"
)
_PK = "CASE WHEN k < 50 THEN 'USER#' || CAST(user_id AS STRING) ELSE CAST(user_id AS STRING) || 'USER#' END"


@query("key_parse", S.with_(S.EV, (
    f"k1 AS (SELECT event_id, {_PK} AS pk, coalesce({_SK}, 'CONVERSATION#' || {S.iso('ts')}) AS sk FROM ev)"
), select=(
    "SELECT event_id, regexp_replace(pk, '^USER#', '') AS usuario_id, "
    "CASE WHEN contains(sk, '#') THEN split_part(sk, '#', 1) ELSE 'UNKNOWN' END AS kind, "
    "epoch_us(try_cast(replace(substr(sk, strpos(sk, '#') + 1), 'Z', '') AS TIMESTAMP)) AS item_us FROM k1"
)))
def key_parse(spark, d):
    keys = events(spark, d).select(
        "event_id", F.expr(_PK).alias("pk"),
        F.coalesce(F.expr(_SK), F.concat(F.lit("CONVERSATION#"), iso(F.col("ts")))).alias("sk"),
    )
    return keys.select(
        "event_id", user_id(F.col("pk")).alias("usuario_id"), sort_key_kind(F.col("sk")).alias("kind"),
        F.unix_micros(sort_key_time(F.col("sk"))).alias("item_us"),
    )


@query("profile_extract", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT sk, usuario_id, " + ", ".join(f"{S.clean(f)} AS {f}" for f in PROFILE_FIELDS) + " FROM items"
)))
def profile_extract(spark, d):
    """From the struct, by way of its JSON text."""
    text = F.to_json("profile")
    return items(spark, d).select("sk", "usuario_id", profile_from_text(text).alias("p")).select(
        "sk", "usuario_id", *[blank_to_empty(F.col(f"p.{f}")).alias(f) for f in PROFILE_FIELDS]
    )


@query("city_clean", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT sk, usuario_id, CASE WHEN contains(ciudad, '(') AND contains(ciudad, ')') "
    f"THEN {S.strip('split_part(ciudad, chr(40), 1)')} ELSE ciudad END AS ciudad FROM items"
)))
def city_clean(spark, d):
    return items(spark, d).select("sk", "usuario_id", drop_parenthesis(F.col("profile.ciudad")).alias("ciudad"))


_DEFAULTED = S.KEPT.split(" FROM placed")[0].replace("kept AS", "filled AS") + " FROM placed)"


@query("profile_defaults", S.with_(S.EV, S.SEG, S.ITEMS, _DEFAULTED, select=(
    "SELECT usuario_id, sk, nombre, ciudad FROM filled"
)))
def profile_defaults(spark, d):
    rows = items(spark, d).where(not_register() & F.col("usuario_id").isNotNull())
    named = rows.select("usuario_id", "sk", *clean_profile(CFG))
    return with_default_city(named, CFG).select("usuario_id", "sk", "nombre", "ciudad")


@query("enforce_schema", "SELECT CAST(c_custkey AS VARCHAR) AS usuario_id, c_name AS nombre, '' AS fecha, '' AS feedback FROM customer")
def enforce_schema(spark, d):
    have = table(spark, d, "customer").select(
        "c_acctbal", F.col("c_name").alias("nombre"), F.col("c_custkey").cast("string").alias("usuario_id")
    )
    return enforce_columns(have, ["usuario_id", "nombre", "fecha", "feedback"])


@query("role_canonical", (
    "SELECT conv_id, CAST(turn AS INTEGER) AS turn, CASE lower(role) WHEN 'assistant' THEN 'bot' ELSE lower(role) END AS who FROM conversations"
))
def role_canonical(spark, d):
    return turns(spark, d).select("conv_id", "turn", canonical_role(F.upper("role"), CFG.role_words).alias("who"))


@query("turns_explode", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT i.usuario_id, i.sk, CAST(s.turn AS INTEGER) AS turn, s.role, s.text FROM items i "
    "JOIN seg s ON s.conv_id = i.conv_id AND s.segmento = i.segmento"
)))
def turns_explode(spark, d):
    rows = items(spark, d).where(is_kind(CONVERSATION)).select("usuario_id", "sk", F.explode("messages").alias("m"))
    return rows.select(
        "usuario_id", "sk", "m.turn",
        F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"),
    )


@query("feedback_extract", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT usuario_id, sk, coalesce(fb_type, '') AS tipo, coalesce(fb_comment, '') AS comentario, "
    "coalesce(fb_option, '') AS opcion FROM items WHERE kind = 'FEEDBACK'"
)))
def feedback_extract(spark, d):
    """From the stored text form."""
    text = feedback_text(F.col("feedback.type"), F.col("feedback.comment"), F.col("feedback.option"))
    parsed = event_items(spark, d).where(is_kind(FEEDBACK)).select("usuario_id", "sk", parse_feedback(text).alias("f"))
    return parsed.select(
        "usuario_id", "sk",
        *[F.coalesce(f"f.{name}", F.lit("")).alias(alias)
          for name, alias in (("type", "tipo"), ("comment", "comentario"), ("option", "opcion"))],
    )


# --- filters ----------------------------------------------------------------


@query("kind_split", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT CASE kind WHEN 'CONVERSATION' THEN 'conversation' WHEN 'FEEDBACK' THEN 'feedback' ELSE 'other' END AS grupo, "
    "count(*) AS filas FROM items WHERE kind <> 'REGISTER' GROUP BY ALL"
)))
def kind_split(spark, d):
    group = (
        F.when(is_kind(CONVERSATION), F.lit("conversation")).when(is_kind(FEEDBACK), F.lit("feedback"))
        .when(is_other(), F.lit("other"))
    )
    return items(spark, d).where(not_register()).groupBy(group.alias("grupo")).agg(F.count(F.lit(1)).alias("filas"))


@query("kind_contains", S.with_(S.EV, (
    f"odd AS (SELECT CASE WHEN k % 3 = 0 THEN lower(kind) WHEN k % 3 = 1 THEN 'old-' || kind ELSE kind END AS word FROM (SELECT *, {KIND} AS kind FROM ev))"
), select=(
    "SELECT 'contains' AS regla, count(*) FILTER (WHERE contains(upper(word), 'REGISTER')) AS registros, "
    "count(*) FILTER (WHERE contains(upper(word), 'FEEDBACK')) AS feedback, count(*) AS filas FROM odd "
    "UNION ALL SELECT 'equals', count(*) FILTER (WHERE word = 'REGISTER'), count(*) FILTER (WHERE word = 'FEEDBACK'), count(*) FROM odd"
)))
def kind_contains(spark, d):
    """The user table's rule and the feedback table's, on lower-case and prefixed sort keys."""
    k = F.col("k")
    word = F.expr(KIND)
    odd = F.when(k % 3 == 0, F.lower(word)).when(k % 3 == 1, F.concat(F.lit("old-"), word)).otherwise(word)
    rows = events(spark, d).select(F.concat(odd, F.lit("#"), F.col("ts").cast("string")).alias("sk")).withColumn("kind", sort_key_kind(F.col("sk")))

    def counted(rule, is_register, is_feedback):
        return rows.agg(F.lit(rule).alias("regla"), F.count_if(is_register).alias("registros"), F.count_if(is_feedback).alias("feedback"), F.count(F.lit(1)).alias("filas"))

    return counted("contains", holds_kind(REGISTER), holds_kind(FEEDBACK)).unionByName(counted("equals", is_kind(REGISTER), is_kind(FEEDBACK)))


@query("exclude_pattern", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT usuario_id, sk, ciudad, nombre FROM items "
    f"WHERE NOT {S.matches('ciudad', CFG.excluded_city_words)} AND NOT {S.matches('nombre', CFG.excluded_name_words)}"
)))
def exclude_pattern(spark, d):
    return items(spark, d).select("usuario_id", "sk", "profile.ciudad", "profile.nombre").where(
        ~matches_any(F.col("ciudad"), CFG.excluded_city_words) & ~matches_any(F.col("nombre"), CFG.excluded_name_words)
    )


@query("date_window_null_ok", S.with_(S.EV, S.SEG, S.ITEMS, select=(
    "SELECT usuario_id, sk, CAST(created_at AS DATE) AS fecha FROM items WHERE created_at IS NULL OR "
    f"CAST(created_at AS DATE) BETWEEN DATE '{CFG.first_day}' AND DATE '{CFG.last_day}'"
)))
def date_window_null_ok(spark, d):
    rows = items(spark, d).select("usuario_id", "sk", F.to_date("created_at").alias("fecha"))
    return rows.where(in_window_or_null(F.col("fecha"), CFG.first_day, CFG.last_day))


@query("sample_rows", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def sample(spark, d):
    return sample_rows(table(spark, d, "events").select("event_id", "event_type", "value"), "event_id", 5)


# --- texts ------------------------------------------------------------------


@query("text_single_line", f"SELECT doc_id, {S.single_line('text')} AS linea, {S.single_line('text', 200)} AS corta FROM documents")
def text_single_line(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", single_line(F.col("text")).alias("linea"), single_line(F.col("text"), 200).alias("corta")
    )


_PIPED = r"replace(replace(text, chr(10), '|'), '. ', ' || ')"
_FLAT = rf"regexp_replace(translate({S.strip(_PIPED)}, chr(10) || chr(13) || chr(9), '   '), ' {{2,}}', ' ', 'g')"


@query("transcript_normalize", (
    rf"SELECT doc_id, {S.strip(rf'regexp_replace(replace({_FLAT}, chr(124), chr(32) || chr(124) || chr(32)), $$ \|(?:  \|)+ $$, $$ | $$, $$g$$)')} "
    "AS texto FROM documents"
))
def transcript_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", normalize_transcript(F.expr(_PIPED)).alias("texto"))


_RULES = (
    (r"th\w+ (?:is|are)", "¿Qué es?"),
    (r"(?:ment|tion)\b", "¿Cómo se hace?"),
    (r"\bund\b", "¿Con quién?"),
    (r"el chip", "¿Qué es el CHIP?"),
)


@query("infer_question_rules", (
    "SELECT conv_id, CAST(turn AS INTEGER) AS turn, CASE WHEN length(trim(text)) < 10 THEN NULL "
    + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{q}'" for p, q in _RULES)
    + " END AS pregunta FROM conversations WHERE role = 'assistant'"
))
def infer_question_rules(spark, d):
    replies = turns(spark, d).where(F.col("role") == "assistant")
    return replies.select("conv_id", "turn", infer_question(F.col("text"), _RULES).alias("pregunta"))


@query("infer_question_table", (
    "WITH rules AS (SELECT item_id AS prioridad, lower(regexp_extract(text, '([A-Za-z]{4})[^A-Za-z]*$', 1)) AS patron FROM benchmark), "
    "good AS (SELECT * FROM rules WHERE patron <> ''), "
    "hits AS (SELECT c.conv_id, c.turn, min(g.prioridad) AS p FROM conversations c JOIN good g ON contains(lower(c.text), g.patron) WHERE c.role = 'assistant' GROUP BY ALL) "
    "SELECT c.conv_id, CAST(c.turn AS INTEGER) AS turn, CASE WHEN length(trim(c.text)) >= 10 THEN 'regla ' || h.p END AS pregunta "
    "FROM conversations c LEFT JOIN hits h ON h.conv_id = c.conv_id AND h.turn = c.turn WHERE c.role = 'assistant'"
))
def infer_question_table(spark, d):
    """Rules from a table, one for each benchmark item: the end of its last word."""
    word = F.lower(F.regexp_extract("text", "([A-Za-z]{4})[^A-Za-z]*$", 1))
    rules = table(spark, d, "benchmark").select(F.col("item_id").alias("prioridad"), F.nullif(word, F.lit("")).alias("patron"), F.concat(F.lit("regla "), F.col("item_id").cast("string")).alias("pregunta"))
    replies = turns(spark, d).where(F.col("role") == "assistant")
    return with_inferred_question(replies, "text", rules).select("conv_id", "turn", "pregunta")


@query("token_estimate", f"SELECT doc_id, {S.tokens('text')} AS tokens FROM documents")
def token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", estimate_tokens(F.col("text")).alias("tokens"))


@query("token_estimate_quarter", (
    "SELECT conv_id, CAST(turn AS INTEGER) AS turn, CAST(greatest(1, length(text) // 4) AS INTEGER) AS tokens FROM conversations"
))
def token_estimate_quarter(spark, d):
    return turns(spark, d).select("conv_id", "turn", quarter_tokens(F.col("text")).alias("tokens"))


# --- dates, casts, JSON -----------------------------------------------------

_DAY = "(1 + user_id % 28)"
_DATE_TEXT = (
    f"CASE WHEN k < 10 THEN NULL WHEN k < 15 THEN '' WHEN k < 20 THEN 'ayer' "
    f"WHEN k < 40 THEN '2024-02-' || lpad(CAST({_DAY} AS STRING), 2, '0') "
    f"WHEN k < 60 THEN lpad(CAST({_DAY} AS STRING), 2, '0') || '/03/2024' "
    f"WHEN k < 80 THEN '4/' || CAST({_DAY} AS STRING) || '/2024' "
    f"WHEN k < 90 THEN '2024-13-45' ELSE '2024-05-' || lpad(CAST({_DAY} AS STRING), 2, '0') || 'T10:20:30' END"
)


def _strp(x: str, fmt: str) -> str:
    return f"CAST(try_strptime({x}, '{fmt}') AS DATE)"


_DATE_SQL = (
    "coalesce("
    rf"CASE WHEN regexp_full_match(t, '\d{{4}}-\d{{2}}-\d{{2}}') THEN {_strp('t', '%Y-%m-%d')} END, "
    rf"CASE WHEN regexp_full_match(t, '\d{{2}}/\d{{2}}/\d{{4}}') THEN coalesce({_strp('t', '%d/%m/%Y')}, {_strp('t', '%m/%d/%Y')}) END, "
    rf"CASE WHEN regexp_full_match(t, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN {_strp('t', '%m/%d/%Y')} END, "
    "CAST(try_cast(t AS TIMESTAMP) AS DATE))"
)


@query("date_parse_multi", S.with_(S.EV, f"d AS (SELECT event_id, {_DATE_TEXT} AS t FROM ev)", select=(
    f"SELECT event_id, {_DATE_SQL} AS fecha FROM d"
)))
def date_parse_multi(spark, d):
    return events(spark, d).select("event_id", parse_date(F.expr(_DATE_TEXT)).alias("fecha"))


@query("date_render", S.with_(S.EV, select=(
    f"SELECT event_id, coalesce(strftime({CREATED}, '%d/%m/%Y'), 'Sin fecha') AS dia FROM ev"
)))
def date_render(spark, d):
    day = F.to_date(F.expr(CREATED))
    return events(spark, d).select("event_id", render_date(day, CFG.no_date_label).alias("dia"))


_MIXED = [
    "CAST(event_id AS STRING) AS usuario_id",
    "CASE WHEN k < 10 THEN '0' WHEN k < 20 THEN '' WHEN k < 30 THEN 'x' || CAST(k AS STRING) ELSE CAST(k AS STRING) END AS numero_conversaciones",
    "CASE WHEN k < 10 THEN '' WHEN k < 20 THEN 'n/a' ELSE CAST(value AS STRING) END AS valor",
    "CASE WHEN k < 10 THEN NULL WHEN k < 50 THEN '2024-02-03T04:05:06' ELSE 'tarde' END AS momento",
    "CASE WHEN k < 60 THEN '0' ELSE CAST(k AS STRING) END AS numero_preguntas",
    "event_type AS otro",
]


@query("typed_cast", S.with_(S.EV, f"m AS (SELECT {', '.join(_MIXED)} FROM ev)", select=(
    "SELECT usuario_id, CASE WHEN numero_conversaciones <> '0' THEN try_cast(numero_conversaciones AS INTEGER) END AS numero_conversaciones, "
    "try_cast(nullif(valor, '') AS DOUBLE) AS valor, epoch_us(try_cast(momento AS TIMESTAMP)) AS momento_us, "
    "try_cast(numero_preguntas AS INTEGER) AS numero_preguntas, otro FROM m"
)))
def typed_cast(spark, d):
    spec = {
        "usuario_id": "string", "numero_conversaciones": "integer", "valor": "double", "momento": "timestamp",
        "numero_preguntas": "number",
    }
    mixed = events(spark, d).selectExpr(*_MIXED)
    typed = mixed.select(*typed_columns(mixed, spec))
    return typed.select(
        "usuario_id", "numero_conversaciones", "valor", F.unix_micros("momento").alias("momento_us"), "numero_preguntas", "otro"
    )


_ENUM = (
    "CASE WHEN k < 20 THEN ' Like ' WHEN k < 40 THEN 'DISLIKE' WHEN k < 50 THEN 'mixed' WHEN k < 60 THEN '' "
    "WHEN k < 70 THEN NULL ELSE 'like, dislike' END"
)


@query("enum_gate", S.with_(S.EV, f"e AS (SELECT event_id, {_ENUM} AS f, event_type AS r FROM ev)", select=(
    "SELECT event_id, CASE WHEN lower(trim(f)) IN ('like', 'dislike', 'mixed') THEN lower(trim(f)) END AS feedback, "
    "CASE WHEN lower(trim(f)) IN ('like', 'dislike', 'mixed') THEN r END AS respuesta_feedback FROM e"
)))
def enum_gate(spark, d):
    rows = events(spark, d).select(
        "event_id", F.expr(_ENUM).alias("feedback"), F.col("event_type").alias("respuesta_feedback")
    )
    return rows.select(*typed_columns(rows, {"feedback": "feedback", "respuesta_feedback": "answer"}))


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.otro') AS otro FROM events")
def json_field(spark, d):
    parsed = table(spark, d, "events").select("event_id", F.from_json("props", "k int, otro string").alias("p"))
    return parsed.select("event_id", "p.k", "p.otro")


_NUMBER = "CASE WHEN k < 50 THEN CAST(k AS STRING) WHEN k < 70 THEN CAST(k AS STRING) || '.5' ELSE 'x' || CAST(k AS STRING) END"


@query("typed_scalar_decode", S.with_(S.EV, f"n AS (SELECT event_id, event_type, k, {_NUMBER} AS n FROM ev)", select=(
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'texto ' || CAST(k AS VARCHAR) WHEN 'view' THEN n "
    "WHEN 'error' THEN CASE WHEN k > 50 THEN 'true' ELSE 'false' END WHEN 'signup' THEN NULL "
    "ELSE '[\"a\",\"' || CAST(k AS VARCHAR) || '\"]' END AS valor FROM n"
)))
def typed_scalar_decode(spark, d):
    """Typed scalars, one tag each, from their JSON text."""
    text = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(F.concat(F.lit("texto "), F.col("k").cast("string")).alias("S"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.expr(_NUMBER).alias("N"))))
        .when(F.col("event_type") == "error", F.to_json(F.struct((F.col("k") > 50).alias("BOOL"))))
        .when(F.col("event_type") == "signup", F.to_json(F.struct(F.lit(True).alias("NULL"))))
        .otherwise(F.to_json(F.struct(F.array(F.lit("a"), F.col("k").cast("string")).alias("SS"))))
    )
    return events(spark, d).select("event_id", F.from_json(text, TYPED_SCALAR).alias("v")).select(
        "event_id", typed_scalar(F.col("v")).alias("valor")
    )


@query("timestamp_parse", S.with_(S.EV, select=(
    f"SELECT event_id, CASE WHEN k < 50 THEN epoch_us(ts) WHEN k < 70 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS us FROM ev"
)))
def timestamp_parse(spark, d):
    text = (
        F.when(F.col("k") < 50, iso(F.col("ts"))).when(F.col("k") < 70, F.lit("sin hora"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )
    return events(spark, d).select("event_id", F.unix_micros(parse_timestamp(text)).alias("us"))
