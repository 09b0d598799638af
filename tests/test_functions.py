"""Scalar functions on hand-made texts."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from charlake.config import BOT_PREFIXES, PUNCTUATION_CLASS, QUESTION_RULES, USER_PREFIXES, ChatConfig
from charlake.functions import feedback as fb, transcripts as tr
from charlake.functions.dates import in_window_or_null, parse_date, parse_timestamp, render_date
from charlake.functions.text import (
    blank_to_empty, drop_parenthesis, empty_to, is_blank, matches_any, normalize_transcript, single_line, strip,
)
from charlake.functions.tokens import estimate_tokens, quarter_tokens, sum_tokens

ROLES = ChatConfig().role_words


def apply(spark, fn, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def one(spark, fn, value, type_="string"):
    return apply(spark, fn, [value], type_)[0]


def test_blanks(spark):
    values = [None, "", " \t\n", "nan", " None ", "NULL", "x", " null x", "nancy", "\xa0"]
    assert apply(spark, is_blank, values) == [True] * 6 + [False] * 3 + [True]
    assert apply(spark, blank_to_empty, values) == [""] * 6 + ["x", "null x", "nancy", ""]
    assert apply(spark, strip, [" \t a b\n "]) == ["a b"]
    assert apply(spark, lambda c: empty_to(c, "a$1\\"), ["", "b"]) == ["a$1\\", "b"]


def test_city(spark):
    cities = ["Norte (zona 3)", " Sur ", "a (b", "a) b", "(x) y", "a) b (c", "Uno (a) dos (b)", None, ""]
    assert apply(spark, drop_parenthesis, cities) == ["Norte", " Sur ", "a (b", "a) b", "", "a) b", "Uno", None, ""]


def test_patterns(spark):
    fn = lambda c: matches_any(c, ("potosí", "cali"))
    assert apply(spark, fn, ["POTOSÍ", "San Calixto", "bogotá", None]) == [True, True, False, False]
    assert apply(spark, lambda c: matches_any(c, ()), ["cali"]) == [False]


def test_single_line(spark):
    assert one(spark, single_line, " a\r\n\tb c​d\x85e\x07 \xa0 f ") == "a b c d e f"
    assert one(spark, single_line, None) == ""
    assert one(spark, lambda c: single_line(c, 5), "123456") == "12345..."
    assert one(spark, lambda c: single_line(c, 5), "12345") == "12345"
    assert one(spark, lambda c: single_line(c, 2), "ñ😀x") == "ñ😀..."
    assert one(spark, lambda c: single_line(c, None), "x" * 20_000) == "x" * 20_000


def test_normalize(spark):
    assert one(spark, normalize_transcript, " user: a\n\tb|bot:  c||d ") == "user: a b | bot: c | d"


def test_dates(spark):
    texts = ["2024-02-03", "03/02/2024", "4/5/2024", "13/13/2024", "2024-02-03T10:00:00", "ayer", "", None, "2024-02-30"]
    assert apply(spark, parse_date, texts) == [
        date(2024, 2, 3), date(2024, 2, 3), date(2024, 4, 5), None, date(2024, 2, 3), None, None, None, None,
    ]
    assert apply(spark, parse_timestamp, ["2024-03-05T07:08:09Z", "2024-03-05T07:08:09.5+00:00", "no", "", None]) == [
        datetime(2024, 3, 5, 7, 8, 9), datetime(2024, 3, 5, 7, 8, 9, 500000), None, None, None,
    ]
    days = [date(2025, 1, 2), None]
    assert apply(spark, lambda c: render_date(c, "Sin fecha"), days, "date") == ["02/01/2025", "Sin fecha"]
    window = lambda c: in_window_or_null(c, date(2025, 1, 2), date(2025, 1, 4))
    assert apply(spark, window, [date(2025, 1, d) for d in (1, 2, 4, 5)] + [None], "date") == [False, True, True, False, True]


def test_token_estimate(spark):
    def by_hand(t):
        if not t:
            return 0
        n = len(t)
        punctuation = sum(c in ".,;:!?¡¿()[]{}\"'-" for c in t) / n * 0.15
        special = sum(c.isdigit() or c in "@#$%&*+=/<>" for c in t) / n * 0.1
        return max(1, int(n / 3.8 * (1 + t.count(" ") / n * 0.2 + punctuation + special)))

    texts = ["", None, "a", "Un texto llano", "¿Cuesta 3,50 € (más IVA)? 2 & 4", "x" * 500, "a b c d e", "[1] {2} #3 x²", "🙂🙂🙂🙂"]
    assert apply(spark, estimate_tokens, texts) == [by_hand(t) for t in texts]
    assert apply(spark, quarter_tokens, ["", "abcd", "a" * 9]) == [1, 1, 2]
    assert one(spark, sum_tokens, texts, "array<string>") == sum(by_hand(t) for t in texts)
    assert one(spark, lambda c: sum_tokens(c, tokenizer=F.length), ["ab", "c"], "array<string>") == 3
    assert PUNCTUATION_CLASS.startswith("[")


MESSAGES = "array<struct<turn:int,role:string,text:string>>"


def test_render(spark):
    talk = [(0, " Usuario ", " hola\n\nque\ntal "), (1, "assistant", "bien"), (2, "System", "x"), (3, None, None)]
    assert one(spark, lambda c: tr.render_messages(c, ROLES), talk, MESSAGES) == "user: hola que tal | bot: bien | system: x | : "
    assert apply(spark, lambda c: tr.render_messages(c, ROLES), [[], None], MESSAGES) == ["", ""]
    roles = {**ROLES, "nuestro robot": "bot"}
    assert one(spark, lambda c: tr.canonical_role(c, roles), "Nuestro Robot") == "bot"


@pytest.mark.parametrize("text, want", [
    ('[{"from": "user", "text": "a"}, {"from": "bot", "text": "b\\nc"}]', "user: a | bot: b c"),
    ('[{"M": {"from": {"S": "user"}, "text": {"S": "a"}}}]', "user: a"),
    ('{"L": [{"M": {"from": {"S": "bot"}, "text": {"S": "a"}}}]}', "bot: a"),
    ('{"from": "user", "text": "sola"}', "user: sola"),
    (" user: ya escrito ", "user: ya escrito"),
    ("[roto", "[roto"), ("null", ""), ("", ""), (None, ""),
])
def test_render_text(spark, text, want):
    assert one(spark, lambda c: tr.render_text(c, ROLES), text) == want


@pytest.mark.parametrize("text, want", [
    ("user: a | bot: b | user: c | user: a", "a | c"),
    ("user: a | bot: x || user: b | bot: y || USER: a", "a | b"),
    ("User: única pregunta", "única pregunta"),
    ("user: ", ""),
    ("bot: El trámite cuesta mucho", "¿Cuál es el costo del trámite?"),
    ("bot: nada que ver aquí", ""),
    ("bot: si", ""),
    ("hola user: que hora es", "que hora es"),
    ("nan", ""), ("", ""), (None, ""),
])
def test_questions_text(spark, text, want):
    assert one(spark, lambda c: tr.questions_text(c, QUESTION_RULES), text) == want


def test_inferred_questions(spark):
    replies = [
        "El trámite de cambio de nombre se realiza en línea", "El certificado plano incluye datos", "Busque el CHIP del predio",
        "Los requisitos son dos", "La duración es de tres", "Nuestra sede principal", "El horario de la atención", "corto", None,
    ]
    assert apply(spark, lambda c: tr.infer_question(c, QUESTION_RULES), replies) == [
        QUESTION_RULES[0][1], QUESTION_RULES[1][1], QUESTION_RULES[2][1], QUESTION_RULES[4][1], QUESTION_RULES[5][1],
        QUESTION_RULES[6][1], QUESTION_RULES[7][1], None, None,
    ]
    place = ChatConfig(office="la alcaldía").rules()
    assert one(spark, lambda c: tr.infer_question(c, place), "Nuestra sede principal") == "¿Dónde queda ubicado la alcaldía?"


def test_text_counts(spark):
    texts = ["user: a | bot: b | user: robot", "", None, "hola", "USER: x"]
    assert apply(spark, tr.count_turns_text, texts) == [2, 1, 1, 1, 1]
    assert apply(spark, tr.count_questions_text, texts) == [2, 0, 0, 0, 1]


def test_split_and_role_texts(spark):
    text = "user: a | bot: b\nc ||  Usr: d || b: e | ​u: f || asistente: | otro: g | user: a  a"
    split = tr.split_transcript
    assert one(spark, split, text) == [
        "user: a", "bot: b c", "Usr: d", "b: e", "​u: f", "asistente:", "otro: g", "user: a  a",
    ]
    assert one(spark, lambda c: tr.user_texts(split(c)), text) == ["a", "d", "f", "a  a"]
    assert one(spark, lambda c: tr.bot_texts(split(c)), text) == ["b c", "e"]
    assert one(spark, lambda c: tr.join_texts(tr.texts_by_prefix(split(c), USER_PREFIXES)), text) == "a d a a"
    assert one(spark, lambda c: tr.join_texts(tr.texts_by_prefix(split(c), BOT_PREFIXES)), text) == "b c e"


@pytest.mark.parametrize("talk, want", [
    ([], ("", "")),
    ([("user", "p")], ("p", "")),
    ([("bot", "a"), ("bot", "b")], ("", "b")),
    ([("user", "p"), ("bot", "a"), ("user", "q"), ("system", "b"), ("bot", "c")], ("q", "b")),
    ([("user", "p"), ("bot", "a"), ("user", "q")], ("q", "a")),
    ([("User", "p"), ("Assistant", "a"), ("otro", "z")], ("p", "a")),
])
def test_last_exchange(spark, talk, want):
    cfg = ChatConfig()
    fn = lambda c: F.array(*tr.last_exchange(c, cfg.user_roles, cfg.reply_roles))
    assert tuple(one(spark, fn, [(i, r, t) for i, (r, t) in enumerate(talk)], MESSAGES)) == want


STORED = [
    ("{'type': 'like', 'comment': 'muy bien', 'option': 'None'}", 1, "like", "muy bien"),
    ('{"type": "dislike", "comment": "", "option": "lento"}', 1, "dislike", "lento"),
    ("{'type': 'like', 'comment': 'a'} || {'type': 'dislike', 'comment': 'b', 'option': 'a'}", 2, "mixed", "a | b"),
    ('[{"type" : "like"}, {"type" : "dislike"}]', 1, "mixed", ""),
    ('{"type" : "like", "comment" : "dos", "option" : "tres"}', 1, "like", "dos | tres"),
    ("texto largo sin tipo", 1, "", ""), ("corto", 0, "", ""), ("nan", 0, "", ""), ("", 0, "", ""), (None, 0, "", ""),
]


@pytest.mark.parametrize("text, count, word, answers", STORED)
def test_stored_feedback(spark, text, count, word, answers):
    assert one(spark, fb.count_text, text) == count
    assert one(spark, fb.class_text, text) == word
    assert one(spark, fb.answers_text, text) == answers


def test_feedback_values(spark):
    text = lambda c: fb.feedback_text(c["t"], c["c"], c["o"])
    value = one(spark, text, ("like", 'di "hola"\n[x]', None), "struct<t:string,c:string,o:string>")
    assert value == '{"type": "like", "comment": "di \\"hola\\"\\n[x]", "option": ""}'
    parsed = one(spark, fb.parse_feedback, value)
    assert (parsed.type, parsed.comment, parsed.option) == ("like", 'di "hola"\n[x]', "")
    assert apply(spark, fb.feedback_class_or_null, [" Like", "MIXED", "no", "", None]) == ["like", "mixed", None, None, None]
    assert one(spark, fb.distinct_answers, "a | b | a |  | c") == "a | b | c"
    assert one(spark, lambda c: fb.answers_of(c, F.array(F.lit("o"), F.lit("b"), F.lit(None))), ["a", None, "None", "b"], "array<string>") == "a | b | o"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "bot"]), st.text(alphabet="abñ ?.\n", max_size=12)), max_size=6))
def test_render_then_split(spark, talk):
    """Texts without pipes come back from the rendered transcript."""
    messages = [(i, r, t) for i, (r, t) in enumerate(talk)]
    back = lambda c: tr.user_texts(tr.split_transcript(tr.render_messages(c, ROLES)))
    tidy = lambda t: t.strip().replace("\n\n", " ").replace("\n", " ").strip()
    assert one(spark, back, messages, MESSAGES) == [tidy(t) for r, t in talk if r == "user" and tidy(t)]
