"""Values of whole conversations, however long."""

from charlake.config import ChatConfig
from charlake.operators.conversations import distinct_questions, last_exchanges, question_counts, text_counts

CFG = ChatConfig()
TURNS = "conv_id long, turn int, role string, text string"


def test_a_long_conversation_is_one(spark):
    rows = [(1, i, "assistant", f"b{i}") for i in range(2_500) if i not in (3, 999, 1_001)]
    rows += [(1, 3, "user", "igual"), (1, 999, "user", "igual"), (1, 1_001, "user", "última")]
    turns = spark.createDataFrame([*rows, (2, 0, "bot", "sin pregunta"), (3, 0, "user", None), (None, 0, "user", "¿quién?")], TURNS)
    ends = {r.conv_id: (r.pregunta, r.respuesta) for r in last_exchanges(turns.where("conv_id IS NOT NULL"), CFG.user_roles, CFG.reply_roles).collect()}
    assert ends == {1: ("última", "b1002"), 2: ("", "sin pregunta"), 3: ("", "")}
    counts = {r.conv_id: r.n for r in question_counts(turns.where("conv_id IS NOT NULL"), CFG.role_words).collect()}
    assert counts == {1: 2, 2: 0, 3: 0}
    first = {r.pregunta: r.turn for r in distinct_questions(turns.where("conv_id = 1"), CFG.role_words).collect()}
    assert first == {"igual": 3, "última": 1_001}
    sums = text_counts(turns.where("conv_id = 1"), CFG.role_words).first()
    assert (sums.usuario, sums.bot, sums.preguntas, sums.turnos) == (3, 2_497, 3, 3)
