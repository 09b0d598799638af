"""Hot keys take another plan; the rows must be the same."""

import random
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from charlake.checks import fixture
from charlake.checks.fixture import CFG
from charlake.config import ChatConfig
from charlake.operators.asof import asof_join
from charlake.operators import skew
from charlake.operators.skew import hot_keys, with_ordinal
from charlake.plans import build_feedback_table, build_user_table
from charlake.functions.transcripts import summary_of
from charlake.operators.conversations import summaries
from charlake.plans.feedback_table import dropped_feedback, match_feedback
from tests.compare import difference
from tests.rows import at, feedback_matches, frame, item, plain

OPEN = ChatConfig(first_day=None, excluded_city_words=())


def crowd(seed=7, n=600):
    """A user with half of all items, times with ties, conversations with and without a user message."""
    rnd = random.Random(seed)
    rows, used = [], set()
    for i in range(n):
        user = "hot" if i % 2 else f"u{rnd.randrange(12)}"
        kind = rnd.choice(["CONVERSATION", "CONVERSATION", "FEEDBACK", "VISIT"])
        ts = at(rnd.randrange(80 if i % 3 else 3000))
        if (user, kind, ts) in used:
            continue
        used.add((user, kind, ts))
        name = rnd.choice(["", None, f" Nombre {i}", "nan"])
        if kind == "CONVERSATION":
            talk = rnd.choice([
                [("user", f"pregunta {i}"), ("bot", f"respuesta {i}")], [("bot", f"hola {i}")], [("user", f"sola\n{i}")],
                [("system", "inicio"), ("user", f"p {i}"), ("assistant", "r1"), ("user", f"q {i}")], [],
            ])
            rows.append(item(user, kind, ts, messages=talk, nombre=name))
        elif kind == "FEEDBACK":
            rows.append(item(user, kind, ts, feedback=(rnd.choice(["like", "dislike"]), f"c{i % 5}", rnd.choice([None, "o"])), nombre=name))
        else:
            rows.append(item(user, kind, ts, nombre=name))
    return rows


@pytest.fixture(scope="module")
def rows():
    return crowd()


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("rows_per_window", [1_000_000, 25])
def test_match_against_every_pair(spark, rows, rows_per_window):
    want = feedback_matches(rows)
    got = match_feedback(frame(spark, rows), replace(OPEN, rows_per_window=rows_per_window)).collect()
    assert len(got) == len(want)
    for r in got:
        expected = want[r.usuario_id, r.sk]
        assert r.matched == (expected is not None)
        assert (r.mensaje_usuario, r.mensaje_bot) == (expected or (None, None))


def test_feedback_table_does_not_depend_on_the_plan(spark, rows):
    items = frame(spark, rows)
    assert values(build_feedback_table(items, OPEN)) == values(build_feedback_table(items, replace(OPEN, rows_per_window=10)))


def test_ordinal_is_a_row_number(spark):
    rows = [("a" if i % 3 else "b", i * 7919 % 1000, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = {(r.k, r.id): r.n for r in with_ordinal(skew.in_slices(df, ["k"], ["t", "id"], 8), ["k"], ["t", "id"], "n").collect()}
    for key in "ab":
        ordered = sorted((t, i) for k, t, i in rows if k == key)
        assert [got[key, i] for _, i in ordered] == list(range(len(ordered)))


def test_hot_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 4, "k string")
    assert hot_keys(df, ["k"], 5) == (None, 0)
    found, rows = hot_keys(df, ["k"], 2)
    assert {r.k for r in found.collect()} == {"a", None} and rows == 9


def test_many_hot_keys_stay_a_frame(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 3)
    df = spark.range(40).select((F.col("id") % 8).cast("string").alias("k"), "id")
    found, rows = hot_keys(df, ["k"], 4)
    assert found.count() == 8 and rows == 40
    small, large, slices = skew.split_hot(df, ["k"], 4)
    assert (small.count(), large.count(), slices) == (0, 40, 8)


def test_user_in_parts_is_whole(spark, rows):
    """Cells of at most ten items in time order, which together are the one row's; values are the user's in each of them."""
    items = frame(spark, rows)
    whole = {r.usuario_id: r for r in build_user_table(items, OPEN).collect()}
    parts = {}
    for r in build_user_table(items, replace(OPEN, items_per_row=10)).collect():
        parts.setdefault(r.usuario_id, []).append(r)
    assert set(parts) == set(whole) and {r.parte for r in whole.values()} == {0}
    counts = {}
    for i in map(plain, rows):  # items with a text
        counts[i.user] = counts.get(i.user, 0) + (i.kind == "FEEDBACK" or bool(i.messages))
    for user, row in whole.items():
        mine = sorted(parts[user], key=lambda r: r.parte)
        assert [r.parte for r in mine] == list(range(max(1, -(-counts[user] // 10))))
        for column in ("conversacion_completa", "feedback_total", "pregunta_conversacion"):
            assert " || ".join(r[column] for r in mine if r[column]) == row[column]
        for column in ("numero_conversaciones", "numero_feedback", "numero_preguntas", "feedback", "nombre", "ciudad", "fecha_primera_conversacion"):
            assert {r[column] for r in mine} == {row[column]}


def test_asof_keeps_equal_left_rows(spark):
    """Many left rows at one time, in slices."""
    left = spark.createDataFrame([("k", 5, i) for i in range(300)] + [("k", 1, 1000), ("j", 9, 2000)], "k string, t int, id int")
    right = spark.createDataFrame([("k", 2, "a"), ("k", 5, "b"), ("k", 5, "c"), ("k", 6, "d")], "k string, t int, v string")
    got = {
        r.id: r.v
        for r in asof_join(left, right, ["k"], "t", ["v"], tie="v", left_tie="id", rows_per_window=20).collect()
    }
    assert got == {**{i: "c" for i in range(300)}, 1000: None, 2000: None}


def test_long_conversation_goes_on_in_segments(spark, tmp_path):
    n = 2 * fixture.TURNS_PER_CELL + 500
    talk = spark.range(n).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    other = spark.createDataFrame([(2, 0, "user", "x")], talk.schema)
    nobody = talk.withColumn("conv_id", F.lit(None).cast("bigint")).where("turn < 1200")
    talk.union(other).union(nobody).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.conv_id, r.segmento): r.messages for r in fixture.conversations(spark, str(tmp_path)).collect()}
    assert {k: len(v) for k, v in got.items()} == {
        (1, 0): 1000, (1, 1): 1000, (1, 2): 500, (2, 0): 1, (None, 0): 1000, (None, 1): 200,
    }
    assert [m.turn for s in range(3) for m in got[1, s]] == list(range(n))


def test_given_tables_in_parts(spark):
    """The checked queries' own items with every user in parts."""
    d = "/root/testdata/sf0.001"
    items, cells = fixture.whole_items(spark, d), fixture.text_cells(spark, d)

    def of_users(cfg):
        found = build_user_table(items, cfg, cells=cells).groupBy("usuario_id").agg(F.collect_set(F.struct("numero_conversaciones", "numero_feedback", "feedback", "nombre")).alias("values"), F.max("parte").alias("last"), F.count(F.lit(1)).alias("n"))
        return {r.usuario_id: (r["values"], r["last"], r["n"]) for r in found.collect()}

    whole, parts = of_users(CFG), of_users(replace(CFG, items_per_row=5))
    assert {u: v[0] for u, v in whole.items()} == {u: v[0] for u, v in parts.items()} and all(len(v[0]) == 1 for v in parts.values())
    assert max(v[1] for v in parts.values()) > 5 and all(last + 1 == n for _, last, n in parts.values())


def long_talk(spark, folder):
    """Given events, and a conversation of 2,500 turns with its last question at the end of a cell and the reply after it."""
    d = "/root/testdata/sf0.001"
    spark.read.parquet(f"{d}/events.parquet").write.parquet(f"{folder}/events.parquet")
    n = 2 * fixture.TURNS_PER_CELL + 500
    role = F.when(F.col("id").isin(3, 1_500, 1_999), "user").otherwise("assistant")
    text = F.when(F.col("id").isin(3, 1_500), "igual").when(F.col("id") == 1_999, "última").otherwise(F.concat(F.lit("b"), "id"))
    talk = spark.range(n).select(F.lit(9).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    talk.union(spark.createDataFrame([(11, 0, "user", "corta"), (11, 1, "assistant", "sí")], talk.schema)).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_a_long_conversation_is_one_item(spark, tmp_path):
    """Its exchange, counts and questions do not hang on the cells its text is put into."""
    d = long_talk(spark, tmp_path)
    items, cells = fixture.whole_items(spark, d), fixture.text_cells(spark, d)
    talk = items.where("resumen IS NOT NULL").orderBy(F.desc("resumen.mensajes")).first()
    s = talk.resumen
    assert (s.pregunta, s.respuesta, s.turnos_usuario, s.turnos_bot, s.mensajes, s.con_preguntas) == ("última", "b2000", 3, 2_497, 2_500, True)
    assert [(r.segmento, r.preguntas) for r in cells.where(F.col("sk") == talk.sk).orderBy("segmento").collect()] == [(0, ["igual"]), (1, ["última"]), (2, [])]
    open_ = replace(OPEN, items_per_row=2)
    mine = build_user_table(items, open_, cells=cells).where(F.col("usuario_id") == talk.usuario_id).orderBy("parte").collect()
    assert {r.numero_conversaciones for r in mine} == {mine[0].numero_conversaciones} and mine[0].numero_conversaciones >= 2_497
    text = " | ".join(r.conversacion_completa for r in mine if r.conversacion_completa)
    assert text.count("bot: b") == 2_497 and sum(r.pregunta_conversacion.count("igual") for r in mine) == 1
    later = [r for r in match_feedback(items, OPEN).where(F.col("usuario_id") == talk.usuario_id).collect() if r.matched and r.item_ts >= talk.item_ts]
    assert all((r.mensaje_usuario, r.mensaje_bot) == ("última", "b2000") for r in later)


@pytest.mark.parametrize("name", ["feedback_asof", "feedback_table", "match_stats", "user_rollup", "user_rollup_latest_feedback", "typed_user_table"])
def test_queries_on_a_long_conversation(spark, tmp_path, name):
    d = long_talk(spark, tmp_path)
    con = duckdb.connect()
    for t in ("events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
    assert difference(queries()[name](spark, d), con, oracle_sql()[name]) is None


def test_summary_of_messages_is_that_of_turns(spark, rows):
    """Row by row or from turns, and the tables are the same either way."""
    items = frame(spark, rows)
    spoken = items.where("size(messages) > 0").withColumn("conv_id", F.xxhash64("usuario_id", "sk"))
    turns = spoken.select("conv_id", F.explode("messages").alias("m")).select("conv_id", "m.turn", "m.role", "m.text")
    own = spoken.select("conv_id", summary_of(F.col("messages"), OPEN.role_words, OPEN.user_roles, OPEN.reply_roles).alias("resumen"))
    assert values(own) == values(summaries(turns, OPEN.role_words, OPEN.user_roles, OPEN.reply_roles))


def test_feedback_without_user_or_time_is_counted(spark):
    """Feedback with an empty user id, no user or no time is dropped and counted as such."""
    rows = [item(u, "FEEDBACK", t, feedback=("like", "c", "o")) for u, t in (("u", at(1)), ("", at(2)), (None, at(3)), ("u", None))]
    items = frame(spark, rows)
    assert match_feedback(items, OPEN).count() == 1 and dropped_feedback(items).count() == 3


def test_no_text_below_the_window(spark, rows):
    """What is sorted and windowed are keys, times and numbers; the texts come back by number."""
    from charlake.operators import asof

    right = spark.createDataFrame([("k", 1, "a", "x" * 50)], "k string, t int, id string, body string")
    left = spark.createDataFrame([("k", 2, 7, "y" * 50)], "k string, t int, id int, note string")
    joined = asof_join(left, right, ["k"], "t", ["body"], tie="id", left_tie="id")
    plan = joined._jdf.queryExecution().analyzed().toString()
    window = plan[plan.index("Window"):]
    scans = [line for line in joined._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert any("_payload" not in s and "_row" not in s for s in scans) and "_hit" in window
    columns = asof._matches(joined.sparkSession.createDataFrame([], "_by0 string, _ts int, _tie string, _side int, _hit long, _any long, _left long"), ["_by0"], 10).columns
    assert columns == ["_by0", "_ts", "_tie", "_side", "_hit", "_any", "_left", "_last", "_first"]
    assert joined.first().asDict() == {"k": "k", "t": 2, "id": 7, "note": "y" * 50, "body": "x" * 50, "matched": True}


def test_asof_with_any_column_names_and_repeated_rows(spark):
    """Columns named as the join's own, a payload named as the key's side, rows that are all equal, NULL preference."""
    names = "_row string, t int, _left int, _right int, _ts int, _payload string, matched int, _hit int, v string"
    left = spark.createDataFrame([("k", 5, 1, 2, 3, "p", 4, 5, "l")] * 3, names)
    right = spark.createDataFrame([("k", 4, None, 2, 3, "r", 4, 5, None), ("k", 3, None, 2, 3, "q", 4, 5, "w")] * 2, names)
    got = asof_join(left, right.withColumnRenamed("_payload", "found"), ["_row"], "t", ["found"], tie="_right", left_tie="_left", prefer=F.col("v") == "w").drop("matched").collect()
    assert len(got) == 3 and {r["found"] for r in got} == {"q"} and {r["_payload"] for r in got} == {"p"}
    any_ = asof_join(left.drop("matched"), right.withColumnRenamed("_payload", "found"), ["_row"], "t", ["found"], tie="_right", left_tie="_left", prefer=F.lit(None).cast("boolean"), fallback="oldest").collect()
    assert [(r["found"], r["matched"]) for r in any_] == [("q", True)] * 3


@pytest.mark.parametrize("feedback", ["each_once", "latest_on_each"])
def test_cells_by_bytes(spark, feedback):
    """Items of 400 KB: no cell is above its limit and one item more, parts have no gap and are the whole together."""
    rows = [item("u", "CONVERSATION", at(i), messages=[("user", f"p{i:03d} " + "x" * 400_000), ("bot", f"r{i}")]) for i in range(20)]
    rows += [item("u", "CONVERSATION", at(100), messages=[("user", "y" * 3_000_000)]), item("u", "FEEDBACK", at(200), feedback=("like", "bien", "o"))]
    rows += [item("v", "CONVERSATION", at(i), messages=[("user", f"corta {i}")]) for i in range(30)]
    limit = 1_600_000
    items = frame(spark, rows)
    whole = {r.usuario_id: r for r in build_user_table(items, OPEN, feedback=feedback).collect()}
    parts = {}
    for r in build_user_table(items, replace(OPEN, bytes_per_row=limit), feedback=feedback).collect():
        parts.setdefault(r.usuario_id, []).append(r)
    assert len(parts["v"]) == 1 and len(parts["u"]) >= 6
    mine = sorted(parts["u"], key=lambda r: r.parte)
    assert [r.parte for r in mine] == list(range(len(mine)))
    assert all(len(r.conversacion_completa) <= limit + 400_100 for r in mine if "y" * 100 not in r.conversacion_completa)
    for column in ("conversacion_completa", "feedback_total", "pregunta_conversacion"):
        assert " || ".join(r[column] for r in mine if r[column]) == whole["u"][column]
    assert {r.numero_conversaciones for r in mine} == {21}


def test_weights_run_on_over_slices(spark):
    """The weight before each row, in slices, is a plain running sum."""
    rows = [("a" if i % 3 else "b", i * 7919 % 1000, i, i % 11) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, t int, id int, w int")
    got = {(r.k, r.id): r.n for r in with_ordinal(skew.in_slices(df, ["k"], ["t", "id"], 8), ["k"], ["t", "id"], "n", F.col("w")).collect()}
    for key in "ab":
        total = 0
        for _, i, w in sorted((t, i, w) for k, t, i, w in rows if k == key):
            assert got[key, i] == total
            total += w
