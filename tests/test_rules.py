"""Question rules as a table: the first by priority, whatever their number."""

import random
import re

import pytest
from pyspark.sql import functions as F

from charlake.config import QUESTION_RULES
from charlake.functions.transcripts import infer_question, infer_question_of_many, rule_number
from charlake.operators import rules as rules_module
from charlake.operators.rules import rules_of, with_inferred_question

TEXTS = [
    "El trámite de pasaporte es así.", "horario de\natención: ocho", "El horario de atención al público", "Cuesta diez; documentos necesarios: dos", "nada que ver aquí", "corto", None, "", "   costo   ",
    "una respuesta  con el chip dentro", "requisitos " * 500,
]


def test_the_given_rules(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = rows.select("i", infer_question(F.col("t"), QUESTION_RULES).alias("one"), infer_question_of_many(F.col("t"), QUESTION_RULES).alias("many")).collect()
    assert [r.one for r in got] == [r.many for r in got] and sum(r.one is not None for r in got) == 5


def test_a_thousand_rules(spark):
    """Against each rule by itself; rules that overlap, with anchors, groups and alternatives."""
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzñé"
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    patterns = [rnd.choice([word(3), f"({word(2)}|{word(3)})", f"^{word(1)}", f"{word(1)}[a-f]+{word(1)}", rf"\b{word(2)}", f"{word(2)}$"]) for _ in range(1_000)]
    texts = [" ".join(word(rnd.randrange(1, 7)) for _ in range(rnd.randrange(12))) for _ in range(300)] + ["", "ñ"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    column = rule_number(F.col("t"), patterns)
    got = {r.i: r.n for r in rows.select("i", column.alias("n")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == next((n for n, p in enumerate(patterns, 1) if re.search(p, t)), 0), t
    plan = rows.select(column)._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == 0
    assert {r.n for r in rows.select(rule_number(F.col("t"), []).alias("n")).collect()} == {0}


def test_priority_decides(spark, monkeypatch):
    """Not the order of the rows nor the place in the text; rules without a pattern and repeated ones do no harm."""
    rules = spark.createDataFrame([(3, "primero", "C"), (1, "último", "A"), (2, None, "B"), (1, "último", "A"), (None, "respuesta", "Z")], "prioridad int, patron string, pregunta string")
    replies = spark.createDataFrame([(1, "primero y último"), (2, "lo primero es esto"), (3, "otra respuesta"), (4, None)], "pregunta_id int, t string")
    assert [r.pregunta for r in with_inferred_question(replies, "t", rules).orderBy("pregunta_id").collect()] == ["A", "C", "Z", None]
    assert {r.pregunta for r in with_inferred_question(replies, "t", rules.limit(0)).collect()} == {None}
    monkeypatch.setattr(rules_module, "MAX_RULES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        rules_of(rules)
