"""The three tables on hand-made items."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from charlake.config import FEEDBACK_TABLE_COLUMNS, USER_TABLE_COLUMNS, ChatConfig
from charlake.operators.reports import feedback_totals, funnel, null_profile, observed, run_totals
from charlake.plans import build_feedback_table, build_user_table, render_user_table, type_user_table
from tests.rows import at, frame, item

CFG = ChatConfig(first_day=date(2025, 8, 4), last_day=date(2025, 12, 31), excluded_name_words=("prueba",), excluded_names=("de prueba",))
TALK = [("user", "hola"), ("bot", "¿qué tal?"), ("user", "bien"), ("user", "hola")]


@pytest.fixture(scope="module")
def items(spark):
    return frame(spark, [
        item("a", "REGISTER", at(0), nombre="Registro"),
        item("a", "CONVERSATION", at(10), messages=TALK, nombre="", gerencia="G1"),
        item("a", "CONVERSATION", at(5), messages=[("bot", "saludo")], nombre=" Ana ", ciudad="Norte (z)", created=None),
        item("a", "FEEDBACK", at(11), feedback=("like", "bueno", None), nombre="Ana F"),
        item("a", "FEEDBACK", at(12), feedback=("dislike", "None", "lento")),
        item("a", "FEEDBACK", at(1), feedback=("like", "temprano", "")),
        item("b", "CONVERSATION", at(3), messages=[("user", "x")]),
        item("b", "NOTE", at(4), gerencia="G2"),
        item("c", "CONVERSATION", at(3), messages=TALK, ciudad="CALI"),
        item("d", "CONVERSATION", at(3), messages=TALK, nombre="Una PRUEBA"),
        item("e", "FEEDBACK", at(3), feedback=("like", "solo", "")),
        item("f", "CONVERSATION", at(3), messages=TALK, created=at(-100 * 24 * 60)),
        item(None, "CONVERSATION", at(3), messages=TALK),
        item("g", "CONVERSATION", at(9), messages=[("user", "g1")], nombre="De prueba"),
        item("g", "FEEDBACK", at(10), feedback=("like", "", "")),
    ])


def by_user(df):
    return {r.usuario_id: r for r in df.collect()}


def test_user_table(items):
    table = build_user_table(items, CFG)
    assert table.columns == [*USER_TABLE_COLUMNS, "parte"]
    users = by_user(table)
    assert set(users) == {"a", "b"}
    a, b = users["a"], users["b"]
    assert (a.nombre, a.ciudad, a.gerencia) == ("Ana", "Norte", "G1")
    assert a.fecha_primera_conversacion is None  # the first conversation's day, missing as it is
    assert a.conversacion_completa == "bot: saludo || user: hola | bot: ¿qué tal? | user: bien | user: hola"
    assert a.pregunta_conversacion == "hola | bien"
    assert (a.numero_conversaciones, a.numero_preguntas, a.numero_feedback) == (4, 3, 3)
    assert a.feedback == "mixed" and a.respuesta_feedback == "temprano | bueno | lento"
    assert a.feedback_total.count(" || ") == 2
    assert (b.nombre, b.ciudad, b.gerencia) == ("Usuario Anónimo", "Bogotá", "G2")
    assert b.fecha_primera_conversacion == date(2025, 9, 1)
    assert (b.numero_conversaciones, b.feedback, b.feedback_total) == (2, "", "")


def test_user_table_with_last_feedback_on_each(items):
    a = by_user(build_user_table(items, CFG, feedback="latest_on_each"))["a"]
    one = '{"type": "dislike", "comment": "None", "option": "lento"}'
    assert a.feedback_total == f"{one} || {one}"
    assert (a.numero_feedback, a.feedback, a.respuesta_feedback) == (2, "dislike", "lento")
    assert (a.numero_conversaciones, a.numero_preguntas) == (4, 3)
    with pytest.raises(ValueError):
        build_user_table(items, CFG, feedback="other")


def test_own_feedback_stays_if_the_user_gave_none(spark):
    rows = [item("u", "CONVERSATION", at(1), messages=TALK, feedback=("like", "propio", ""))]
    row = build_user_table(frame(spark, rows), CFG, feedback="latest_on_each").first()
    assert (row.feedback, row.respuesta_feedback, row.numero_feedback) == ("like", "propio", 1)


def test_typed_table(items):
    users = by_user(type_user_table(render_user_table(build_user_table(items, CFG), CFG), CFG))
    a, b = users["a"], users["b"]
    assert (a.token_pregunta, a.token_respuesta) == (3, 3)
    assert a.fecha_primera_conversacion is None and b.fecha_primera_conversacion == date(2025, 9, 1)
    assert (b.numero_feedback, b.numero_preguntas, b.feedback, b.respuesta_feedback) == (None, 1, None, None)
    kept = by_user(type_user_table(render_user_table(build_user_table(items, CFG), CFG), replace(CFG, zero_as_null=False)))
    assert kept["b"].numero_feedback == 0


def test_typed_table_without_transcripts(spark):
    row = type_user_table(spark.createDataFrame([("u", "like ", "r")], "usuario_id string, feedback string, respuesta_feedback string")).first()
    assert row.asDict() == {
        "usuario_id": "u", "feedback": "like", "respuesta_feedback": "r", "token_pregunta": None, "token_respuesta": None,
    }


def test_typed_table_drops_blank_transcripts(spark):
    df = spark.createDataFrame([("u", " \t"), ("v", None), ("w", "user: a")], "usuario_id string, conversacion_completa string")
    assert [r.usuario_id for r in type_user_table(df).collect()] == ["w"]


def test_feedback_table(items):
    table = build_feedback_table(items, CFG)
    assert tuple(table.columns) == FEEDBACK_TABLE_COLUMNS
    rows = {(r.usuario_id, r.comentario): r for r in table.collect()}
    assert set(rows) == {("a", "bueno"), ("a", "None"), ("a", "temprano"), ("e", "solo")}
    good, early, alone = rows["a", "bueno"], rows["a", "temprano"], rows["e", "solo"]
    assert (good.mensaje_usuario, good.mensaje_bot, good.nombre) == ("hola", "¿qué tal?", "Ana")
    assert (good.ciudad, good.gerencia, good.fecha) == ("Norte (z)", "G1", date(2025, 9, 1))
    assert (early.mensaje_usuario, early.mensaje_bot, early.nombre) == ("", "", "")
    assert (alone.mensaje_usuario, alone.opcion_respuesta) == ("", "")


def test_feedback_table_profile_of_last_conversation(items):
    rows = {(r.usuario_id, r.comentario): r for r in build_feedback_table(items, CFG, profile="latest").collect()}
    assert (rows["a", "bueno"].nombre, rows["a", "bueno"].ciudad, rows["a", "bueno"].gerencia) == ("", "", "G1")
    with pytest.raises(ValueError):
        build_feedback_table(items, CFG, profile="other")


def test_oldest_conversation_if_none_has_a_question(spark):
    rows = [
        item("u", "CONVERSATION", at(1), messages=[("bot", "uno")]), item("u", "CONVERSATION", at(2), messages=[("bot", "dos")]),
        item("u", "CONVERSATION", None, messages=[("user", "sin hora")]), item("u", "FEEDBACK", at(3), feedback=("like", "", "")),
        item("u", "FEEDBACK", None, feedback=("like", "", "")),
    ]
    (row,) = build_feedback_table(frame(spark, rows), CFG).collect()
    assert (row.mensaje_usuario, row.mensaje_bot) == ("", "uno")


def test_values_do_not_hang_on_the_size_of_cells(spark):
    rows = [item("u", "VISIT", at(0), nombre="Ana"), item("u", "CONVERSATION", at(1), messages=[("user", "uno"), ("bot", "dos")])]
    rows += [item("u", "FEEDBACK", at(2), feedback=("like", "igual", "")), item("u", "FEEDBACK", at(3), feedback=("dislike", "igual", "otra"))]
    rows += [item("u", "VISIT", at(4)), item("u", None, at(5))]
    for mode in ("each_once", "latest_on_each"):
        (whole,) = build_user_table(frame(spark, rows), CFG, mode).collect()
        parts = build_user_table(frame(spark, rows), replace(CFG, items_per_row=1, answers_per_row=1), mode).orderBy("parte").collect()
        assert [p.parte for p in parts] == list(range(len(parts)))
        for name in ("nombre", "fecha_primera_conversacion", "numero_conversaciones", "numero_feedback", "numero_preguntas", "feedback"):
            assert {p[name] for p in parts} == {whole[name]}, name
        for name, mark in (("conversacion_completa", " || "), ("feedback_total", " || ")):
            assert mark.join(p[name] for p in parts if p[name]) == whole[name]
        if mode == "each_once":
            assert whole.feedback == "mixed" and whole.respuesta_feedback == "igual | otra" and len(parts) == 3
            assert " | ".join(p.respuesta_feedback for p in parts if p.respuesta_feedback) == whole.respuesta_feedback
            assert whole.numero_conversaciones == 4  # one talk, two visits and the row without a kind


def test_reports(items):
    users = build_user_table(items, CFG)
    assert run_totals(users, CFG.anonymous_label).first().asDict() == {
        "usuarios_procesados": 2, "total_conversaciones": 6, "usuarios_con_feedback": 1, "usuarios_con_preguntas": 2, "nombres_reales": 1,
    }
    parts = build_user_table(items, replace(CFG, items_per_row=1))
    assert run_totals(parts, CFG.anonymous_label).first() == run_totals(users, CFG.anonymous_label).first()
    assert feedback_totals(build_feedback_table(items, CFG)).first().asDict() == {
        "total_feedbacks": 4, "likes": 3, "dislikes": 1, "with_comments": 4, "with_user_messages": 2, "with_bot_messages": 2,
    }
    nulls = {r.columna: (r.validos, r.nulos) for r in null_profile(items.select("usuario_id", "created_at")).collect()}
    assert nulls == {"usuario_id": (14, 1), "created_at": (14, 1)}
    steps = funnel(items, {"con usuario": F.col("usuario_id").isNotNull(), "charla": F.col("kind") == "CONVERSATION"}).collect()
    assert [(r.paso, r.nombre, r.filas) for r in steps] == [(0, "inicial", 15), (1, "con usuario", 14), (2, "charla", 7)]
    counted, seen = observed(items.where("kind = 'FEEDBACK'"), "feedback")
    counted.collect()
    assert seen.get == {"filas": 5}
