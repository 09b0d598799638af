"""A caller's tokenizer of any kind gives what a function of columns gives."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from charlake.functions import tokens
from charlake.functions.tokens import sum_tokens
from charlake.plans import type_user_table
from charlake.schemas import USER_CSV

ROWS = [
    (1, ["uno dos", "tres", ""]), (2, []), (3, None), (4, ["é ü  ñ"] * 50), (5, [" "]), (6, ["x" * 3_000, "y z"]), (7, ["uno dos"]), (7, ["uno dos"]),
]


def kinds():
    @F.pandas_udf("int")
    def series(texts: pd.Series) -> pd.Series:
        return texts.str.count("[^ ]+")

    @F.pandas_udf("long")
    def iterator(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.str.count("[^ ]+")

    @F.arrow_udf("int")
    def arrow(texts: pa.Array) -> pa.Array:
        return pc.cast(pc.count_substring_regex(texts, "[^ ]+"), pa.int32())

    @F.arrow_udf("int")
    def arrow_iterator(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pc.cast(pc.count_substring_regex(texts, "[^ ]+"), pa.int32())

    row = F.udf(lambda t: len(t.split(" ")) - t.split(" ").count(""), "int")
    return {"series": series, "iterator": iterator, "arrow": arrow, "arrow_iterator": arrow_iterator, "row": row}


def native(text):
    return F.size(F.filter(F.split(text, " "), lambda w: w != ""))


@pytest.mark.parametrize("kind", ["series", "iterator", "arrow", "arrow_iterator", "row"])
def test_each_kind_is_the_native_one(spark, kind):
    rows = spark.createDataFrame(ROWS, "id int, texts array<string>").repartition(3)
    got = rows.select("id", sum_tokens(F.col("texts"), kinds()[kind]).alias("n"), F.coalesce(sum_tokens(F.col("texts"), native), F.lit(0)).alias("want")).collect()
    assert len(got) == len(ROWS) and all(r["n"] == r["want"] for r in got)
    assert {r["id"]: r["n"] for r in got} == {1: 3, 2: 0, 3: 0, 4: 150, 5: 0, 6: 3, 7: 2}


def test_the_typed_table_takes_a_udf(spark):
    row = {f.name: None for f in USER_CSV} | {"usuario_id": "u", "conversacion_completa": "user: uno dos | bot: tres || user: cuatro", "parte": "0"}
    users = spark.createDataFrame([tuple(row.values()), tuple((row | {"usuario_id": "v", "conversacion_completa": " "}).values())], USER_CSV)
    for tokenizer in (native, *kinds().values()):
        got = type_user_table(users, tokenizer=tokenizer).collect()
        assert [(r.usuario_id, r.token_pregunta, r.token_respuesta) for r in got] == [("u", 3, 1)]
    assert type_user_table(users, tokenizer=kinds()["series"]).schema == type_user_table(users).schema


def test_an_encoder_of_a_vocabulary(spark):
    """A batch encoder set up once an iterator, against the same encoder text by text."""
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = str(public.path("byte_bpe_50k.json"))

    @F.pandas_udf("int")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = tokenizers.Tokenizer.from_file(path)
        for texts in parts:
            yield pd.Series([len(e.ids) for e in encoder.encode_batch(texts.tolist(), add_special_tokens=False)])

    encoder = tokenizers.Tokenizer.from_file(path)
    rows = [(i, [f"pregunta número {j}, ¿cuánto es {i * j}?" for j in range(i % 5)]) for i in range(40)]
    got = spark.createDataFrame(rows, "id int, texts array<string>").select("id", sum_tokens(F.col("texts"), encoded).alias("n")).collect()
    assert {r["id"]: r["n"] for r in got} == {i: sum(len(encoder.encode(t, add_special_tokens=False).ids) for t in ts) for i, ts in rows}


def test_texts_go_in_slices(monkeypatch):
    """Small slices, a long text by itself, arrays that begin inside a slice, missing counts, a wrong number of counts."""
    monkeypatch.setattr(tokens, "SLICE_BYTES", 10)
    seen = []

    def count(texts: pd.Series) -> pd.Series:
        seen.append(len(texts))
        return texts.str.len().where(texts != "none")

    kind = kinds_of("series")
    lists = pa.array([["a" * 4] * 5, None, [], ["b" * 40, "c"], ["none", "d"]], pa.list_(pa.string())).slice(0, 5)
    assert tokens.sums_by_array(lists, count, kind).to_pylist() == [20, 0, 0, 41, None]
    assert max(seen) <= 3 and sum(seen) == 9
    assert tokens.sums_by_array(lists.slice(3, 1), count, kind).to_pylist() == [41]
    assert tokens.sums_by_array(lists.slice(0, 0), count, kind).to_pylist() == []
    with pytest.raises(ValueError, match="counts for"):
        tokens.counts_of(pa.array(["a", "b"]), lambda s: s.iloc[:1].str.len(), kind)
    with pytest.raises(ValueError, match="kind"):
        tokens.counts_of(pa.array(["a"]), len, -1)
    assert np.issubdtype(tokens.counts_of(pa.array(["a"]), count, kind).to_numpy().dtype, np.integer)


def kinds_of(name):
    from pyspark.util import PythonEvalType

    return {"series": PythonEvalType.SQL_SCALAR_PANDAS_UDF}[name]
