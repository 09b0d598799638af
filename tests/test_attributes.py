"""Typed values of any depth, and keys that are not known beforehand, against plain decoding."""

import json
import random

from pyspark.sql import functions as F

from charlake.sources.attributes import attribute, key_census, key_rows, plain_json, read_typed_attributes
from charlake.sources.items import undecodable


def plain(v):
    """A typed value as Python objects; what has no known tag is its JSON text."""
    if "S" in v:
        return v["S"]
    if "N" in v:
        try:
            return float(v["N"]) if "." in v["N"] else int(v["N"])
        except ValueError:
            return v["N"]
    for tag, made in (("BOOL", lambda x: x), ("NULL", lambda x: None), ("SS", list), ("BS", list), ("NS", lambda x: [float(n) if "." in n else int(n) for n in x])):
        if tag in v:
            return made(v[tag])
    if "L" in v:
        return [plain(x) for x in v["L"]]
    if "M" in v:
        return {k: plain(x) for k, x in v["M"].items()}
    return json.dumps(v, separators=(",", ":"))


def value(rnd, depth):
    kind = rnd.choice(["S", "N", "BOOL", "NULL", "SS", "NS", "BS"] + ["L", "M"] * (3 if depth else 0))
    return {kind: {
        "S": lambda: rnd.choice(["", "a", 'q"u\\o', "é\n\tñ", "{}", "[1]"]), "N": lambda: rnd.choice(["0", "-12", "3.25", "123456789012", "1.50", "x"]), "BOOL": lambda: rnd.random() < 0.5,
        "NULL": lambda: True, "SS": lambda: ["b", 'c"'], "NS": lambda: ["1", "2.5"], "BS": lambda: ["eA=="],
        "L": lambda: [value(rnd, depth - 1) for _ in range(rnd.randrange(4))], "M": lambda: {f"k {i}": value(rnd, depth - 1) for i in range(rnd.randrange(4))},
    }[kind]()}


def test_values_of_any_depth(spark):
    rnd = random.Random(5)
    values = [value(rnd, 5) for _ in range(300)] + [{"B": "eA=="}, {"Q": 1}, {}]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(-1, None)], "i int, v string").repartition(4)
    got = {r.i: r.p for r in rows.select("i", plain_json(F.col("v")).alias("p")).collect()}
    assert got[-1] is None
    for i, v in enumerate(values):
        found, want = json.loads(got[i]), plain(v)
        assert found == want or (isinstance(want, str) and json.loads(found) == json.loads(want)), (v, got[i])


def test_deeper_values_stay_typed(spark):
    text = json.dumps({"L": [{"L": [{"S": "x"}]}]})
    rows = spark.createDataFrame([(text,)], "v string")
    assert json.loads(rows.select(plain_json(F.col("v"), 2).alias("p")).first().p) == [['{"S":"x"}']]
    assert json.loads(rows.select(plain_json(F.col("v"), 3).alias("p")).first().p) == [["x"]]


def test_attributes_of_an_export(spark, tmp_path):
    lines = [
        {"Item": {"PK": {"S": "USER#a"}, "SK": {"S": "X#1"}, "D": {"M": {"n": {"N": "12"}, "l": {"L": [{"M": {"v": {"N": "-3"}}}, {"NULL": True}]}}}, "usuario_id": {"S": "otro"}}},
        {"PK": {"S": "b"}, "SK": {"S": "y"}}, {"foo": 1},
    ]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, lines)) + "\nno es json\n\n")
    rows = read_typed_attributes(spark, str(tmp_path))
    got = rows.select("usuario_id", "sk", attribute("$.D.l[0].v", "int"), attribute("$.D.n", "string"), attribute("$.D.l[9].v", "int"), attribute("$.D", "int"), attribute("$.usuario_id", "string"), "linea").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", "X#1", -3, "12", None, None, "otro", None), ("b", "y", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, '{"foo": 1}'), (None, None, None, None, None, None, None, "no es json"),
    ], key=str)


def test_lines_that_say_nothing(spark, tmp_path):
    """No key, or an attribute that is there and gives nothing; a missing or NULL one is no error."""
    good = [
        {"PK": {"S": "a"}, "SK": {"S": "x"}}, {"Item": {"PK": {"S": "a"}, "Feedback": {"M": {"type": {"S": "like"}}}, "UserData": {"NULL": True}}},
        {"PK": "a", "UserData": {"S": '{"nombre": "n"}'}, "Conversation": {"L": [{"M": {"from": {"S": "user"}, "text": {"S": "t"}}}]}},
    ]
    bad = [{"SK": {"S": "x"}}, {"PK": {"S": "a"}, "Feedback": {"S": "roto {"}}, {"PK": {"S": "a"}, "UserData": {"M": {"otro": {"S": "x"}}}}, {"PK": {"S": "a"}, "Conversation": {"S": ""}}]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, good + bad)) + "\nno es json\n")
    assert tuple(undecodable(spark, str(tmp_path)).first()) == (8, 5)


def test_keys(spark):
    texts = ['{"type":"like","n":1.5,"z":null,"o":{"a":[1,2]}}', "hola", "", None, "[1,2]", "{}", '{"n":"uno"}', "nan", '{"n":"uno"}']
    rows = spark.createDataFrame([(i % 7, "c", t) for i, t in enumerate(texts)], "id int, clave_ string, t string")
    got = key_rows(rows, "t")
    assert sorted(map(tuple, got.select("id", "clave", "tipo", "valor").collect()), key=str) == sorted([
        (0, "type", "STRING", "like"), (0, "n", "DECIMAL", "1.5"), (0, "z", "VOID", None), (0, "o", "OBJECT", '{"a":[1,2]}'),
        (1, "", "STRING", "hola"), (4, "", "STRING", "[1,2]"), (6, "n", "STRING", "uno"), (1, "n", "STRING", "uno"),
    ], key=str)
    assert {r.clave: (r.filas, r.con_valor, r.tipos) for r in key_census(got).collect()} == {"type": (1, 1, 1), "n": (3, 3, 2), "z": (1, 0, 0), "o": (1, 1, 1), "": (2, 2, 1)}
