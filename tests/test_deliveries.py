"""Deliveries that overlap, are repeated or hold bad rows."""

import shutil

import pytest
from pyspark.sql import functions as F

from charlake.config import ChatConfig
from charlake.schemas import USER_CSV
from charlake.sources.files import write_csv
from charlake.sources.quarantine import ingest_csv, read_csv_checked, with_reason
from charlake.streaming.csv_upsert import newest, read_counts, read_current, read_quarantine, start_csv_upsert, write_base

CFG = ChatConfig()


def user(name, **values):
    row = dict.fromkeys(USER_CSV.fieldNames(), "") | {"usuario_id": name, "conversacion_completa": "user: hola | bot: sí", "parte": "0", "fecha_primera_conversacion": "01/09/2025"} | values
    return tuple(row[c] for c in USER_CSV.fieldNames())


def deliver(spark, folder, *rows):
    write_csv(spark.createDataFrame(list(rows), USER_CSV).repartition(2), str(folder))


def state(df):
    return sorted((r.usuario_id, r.parte, r.nombre) for r in df.collect())


def test_a_later_delivery_replaces_a_user(spark, tmp_path):
    """All rows of a user go, further parts too; an older delivery that comes late changes nothing."""
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: start_csv_upsert(spark, str(src), out, check, CFG, files_per_batch=1).awaitTermination()
    deliver(spark, src / "2025-02", user("a", nombre="v1"), user("a", nombre="v1", parte="1"), user("b", nombre="v1"))
    run()
    assert state(read_current(spark, out)) == [("a", 0, "v1"), ("a", 1, "v1"), ("b", 0, "v1")]
    deliver(spark, src / "2025-03", user("a", nombre="v2"), user("c", nombre="v2, con \"comillas\"\ny línea"))
    deliver(spark, src / "2025-01", user("b", nombre="v0"), user("d", nombre="v0"))
    run()
    now = [("a", 0, "v2"), ("b", 0, "v1"), ("c", 0, "v2, con \"comillas\"\ny línea"), ("d", 0, "v0")]
    assert state(read_current(spark, out)) == now
    run()
    assert state(read_current(spark, out)) == now
    # A state written apart, and a log that goes on from it.
    write_base(spark, out, str(tmp_path / "base"))
    deliver(spark, tmp_path / "in2" / "2025-04", user("d", nombre="v4"))
    start_csv_upsert(spark, str(tmp_path / "in2"), str(tmp_path / "out2"), str(tmp_path / "check2"), CFG).awaitTermination()
    assert state(read_current(spark, str(tmp_path / "out2"), str(tmp_path / "base"))) == [*now[:3], ("d", 0, "v4")]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The same files under a new checkpoint are the same batch again: rows and counts stay."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    deliver(spark, src / "2025-02", user("a"), user("b"), user("", nombre="nadie"))
    found = []
    for i in range(2):
        start_csv_upsert(spark, str(src), out, str(tmp_path / f"check{i}"), CFG).awaitTermination()
        found.append((state(read_current(spark, out)), sorted(map(tuple, read_counts(spark, out).collect())), read_quarantine(spark, out).count()))
    assert found[0] == found[1] and found[0][1] == [("", 2), ("sin usuario", 1)] and found[0][2] == 1
    shutil.rmtree(tmp_path / "in")


def test_a_file_delivered_twice(spark):
    """A part that stands twice in the newest delivery is one row."""
    log = spark.createDataFrame([("a", 0, "x", "d2", 1), ("a", 0, "y", "d2", 2), ("a", 0, "y", "d2", 2), ("a", 1, "z", "d1", 0), ("b", 0, "w", "d1", 0)], "usuario_id string, parte int, nombre string, entrega string, lote int")
    assert state(newest(log)) == [("a", 0, "y"), ("b", 0, "w")]


BAD = [
    (user("a"), None), (user("b", fecha_primera_conversacion="Sin fecha", numero_feedback="0", numero_preguntas=""), None),
    (user("c", numero_conversaciones="tres"), "valor: numero_conversaciones"),
    (user("d", fecha_primera_conversacion="ayer", numero_preguntas="x"), "valor: fecha_primera_conversacion,numero_preguntas"),
    (user(" ", numero_preguntas="x"), "sin usuario"), (user("e", conversacion_completa=" \n"), "sin conversación"), (user("f", feedback="otro"), None),
]


def test_reasons(spark):
    rows = spark.createDataFrame([r for r, _ in BAD], USER_CSV).withColumn("registro", F.lit(None).cast("string"))
    assert [r.motivo for r in with_reason(rows, CFG).collect()] == [m for _, m in BAD]


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_of_other_widths(spark, tmp_path, multi_line):
    head, good = ",".join(USER_CSV.fieldNames()), ",".join(user("a"))
    (tmp_path / "x.csv").write_text(f"{head}\n{good}\nb,solo\n{good},más,otra\n\n")
    got = read_csv_checked(spark, str(tmp_path), multi_line=multi_line).select("usuario_id", "registro").collect()
    assert [(r.usuario_id, r.registro is None) for r in got] == [("a", True), ("b", False), ("a", False)]


def test_rows_read_are_rows_typed_and_kept_apart(spark, tmp_path):
    deliver(spark, tmp_path / "in" / "all", *[r for r, _ in BAD])
    (tmp_path / "in" / "all" / "short.csv").write_text("usuario_id,nombre\nz,corta\n")
    out, bad = str(tmp_path / "typed"), str(tmp_path / "bad")
    found = {r.motivo: r.filas for r in ingest_csv(spark, str(tmp_path / "in" / "*"), out, bad, CFG).collect()}
    assert found == {"": 3, "mal formado": 1, "sin usuario": 1, "sin conversación": 1, "valor: numero_conversaciones": 1, "valor: fecha_primera_conversacion,numero_preguntas": 1}
    assert spark.read.parquet(out).count() == 3 and spark.read.parquet(bad).count() == 5
    kept = {r.usuario_id: r for r in spark.read.parquet(bad).collect()}
    assert kept["z"].registro == "z,corta" and kept["c"].numero_conversaciones == "tres"


def test_no_rows(spark, tmp_path):
    deliver(spark, tmp_path / "in" / "none", *[])
    assert ingest_csv(spark, str(tmp_path / "in" / "none"), str(tmp_path / "o"), str(tmp_path / "b"), CFG).count() == 0
