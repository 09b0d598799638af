"""Sources, sinks and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from charlake.catalog.tables import register_parquet
from charlake.operators.scratch import new_path, scratch_root
from charlake.operators.shape import enforce_columns
from charlake.schemas import TYPED_SCALAR, USER_CSV
from charlake.sources.files import file_inventory, manifest, read_csv, write_csv, write_feedback, write_parquet, write_verified
from charlake.sources.items import read_items, read_typed_export, sort_key_kind, sort_key_time, typed_scalar, user_id
from charlake.streaming.csv_ingest import start_csv_ingest
from tests.rows import at, frame, item

NASTY = 'user: di "qué tal", y\nluego \\ | bot: ¿sí?\r\nno'


def user_rows(spark, *rows):
    columns = USER_CSV.fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], USER_CSV)


def test_csv_comes_back(spark, tmp_path):
    df = user_rows(spark, {"usuario_id": "1", "conversacion_completa": NASTY, "nombre": "", "parte": "0"}, {"usuario_id": "2"})
    path = str(tmp_path / "csv")
    write_csv(df, path)
    back = {r.usuario_id: r for r in read_csv(spark, path, USER_CSV).collect()}
    assert back["1"].conversacion_completa.replace("\r\n", "\n") == NASTY.replace("\r\n", "\n")
    assert back["1"].nombre is None and back["2"].ciudad is None


def test_csv_files_are_split(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.range(25).coalesce(1), path, rows_per_file=10)
    assert file_inventory(spark, path).count() == 3
    doc = json.loads(manifest(spark, path).first().manifest)
    assert len(doc["fileLocations"][0]["URIs"]) == 3
    assert doc["globalUploadSettings"] == {"format": "CSV", "containsHeader": "true"}


def test_manifest_needs_files(spark, tmp_path):
    path = str(tmp_path / "other")
    write_parquet(spark.range(3), path)
    with pytest.raises(ValueError):
        manifest(spark, path)


def test_write_verified(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") > 10, F.col("id").cast("string")).alias("t"))
    row = write_verified(df, str(tmp_path / "p"), files=3).first()
    assert row.asDict() == {"filas": 1000, "columnas": 2, "filas_iguales": True, "valores_iguales": True, "esquema_igual": True}
    assert file_inventory(spark, str(tmp_path / "p"), "*.parquet").count() == 3
    empty = write_verified(df.where("id < 0"), str(tmp_path / "e")).first()
    assert (empty.filas, empty.filas_iguales, empty.valores_iguales) == (0, True, True)


def test_feedback_file(spark, tmp_path):
    for output_format in ("parquet", "both"):
        path = write_feedback(spark.range(4), str(tmp_path) + "/", output_format)
        assert path.endswith("/feedback_analysis.parquet") and spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        write_feedback(spark.range(4), str(tmp_path), "csv")


def test_items_from_json(spark, tmp_path):
    rows = [item("7", "CONVERSATION", at(1), messages=[("user", "a")], nombre="Ana")]
    frame(spark, rows).write.json(str(tmp_path / "items"))
    (row,) = read_items(spark, str(tmp_path / "items"), format="json").collect()
    assert (row.usuario_id, row.item_ts, row.messages[0].text, row.profile.nombre) == ("7", at(1), "a", "Ana")


def test_merged_schemas(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.createDataFrame([(1,)], "a int"), f"{path}/v=1")
    write_parquet(spark.createDataFrame([(2, "x")], "a int, b string"), f"{path}/v=2")
    register_parquet(spark, "merged", path)
    assert [tuple(r) for r in spark.sql("SELECT a, b FROM merged ORDER BY a").collect()] == [(1, None), (2, "x")]


def test_items_and_typed_export(spark, tmp_path):
    rows = [item("7", "CONVERSATION", at(1), messages=[("user", "a")], nombre="Ana"), item("7", "FEEDBACK", at(2), feedback=("like", "c", None))]
    write_parquet(frame(spark, rows), str(tmp_path / "items"))
    assert read_items(spark, str(tmp_path / "items")).count() == 2
    lines = [
        {"Item": {"PK": {"S": "USER#7"}, "SK": {"S": "CONVERSATION#2024-03-05T07:08:09Z"}, "CreatedAt": {"S": "2024-03-05T07:08:09Z"},
                  "UserData": {"M": {"nombre": {"S": "Ana"}, "edad": {"N": "3"}}},
                  "Conversation": {"L": [{"M": {"from": {"S": "user"}, "text": {"S": "qué tal"}, "timestamp": {"S": "2024-03-05T07:08:09Z"}}}, {"M": {}}]}}},
        {"Item": {"PK": {"S": "8"}, "SK": {"S": "suelto"}, "Feedback": {"M": {"type": {"S": "like"}}}}},
    ]
    (tmp_path / "export").mkdir()
    (tmp_path / "export" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    first, second = read_typed_export(spark, str(tmp_path / "export")).orderBy("usuario_id").collect()
    assert (first.usuario_id, first.kind, first.item_ts.isoformat(), first.profile.nombre) == ("7", "CONVERSATION", "2024-03-05T07:08:09", "Ana")
    assert [(m.turn, m.role, m.text) for m in first.messages] == [(0, "user", "qué tal"), (1, "", "")]
    assert (second.usuario_id, second.kind, second.item_ts, second.feedback.type, second.messages) == ("8", "UNKNOWN", None, "like", None)


def test_typed_scalars(spark):
    values = ['{"S":"a"}', '{"N":"12"}', '{"N":"1.50"}', '{"N":"x"}', '{"BOOL":true}', '{"NULL":true}', '{"SS":["a","b"]}', '{"NS":["1","2.5"]}', '{"BS":["YQ=="]}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.t for r in df.select("i", typed_scalar(F.from_json("v", TYPED_SCALAR)).alias("t")).orderBy("i").collect()]
    assert got == ["a", "12", "1.5", "x", "true", None, '["a","b"]', "[1.0,2.5]", '["YQ=="]']


def test_keys(spark):
    df = spark.createDataFrame([("USER#1", "FEEDBACK#2025-01-02T03:04:05Z"), ("1USER#", "X#no"), ("2", "Y"), ("3", "A#B#C")], "pk string, sk string")
    got = [tuple(r) for r in df.select(user_id(F.col("pk")), sort_key_kind(F.col("sk")), sort_key_time(F.col("sk")).cast("string")).collect()]
    assert got == [("1", "FEEDBACK", "2025-01-02 03:04:05"), ("1USER#", "X", None), ("2", "UNKNOWN", None), ("3", "A", None)]


def test_enforced_columns(spark):
    df = enforce_columns(spark.createDataFrame([(1, "x")], "b int, z string"), ["a", "b"])
    assert df.columns == ["a", "b"] and tuple(df.first()) == ("", 1)


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_csv(user_rows(spark, {"usuario_id": "1", "conversacion_completa": NASTY, "numero_conversaciones": "2", "parte": "0"}), source)
    start_csv_ingest(spark, source, out, state).awaitTermination()
    start_csv_ingest(spark, source, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    more = user_rows(spark, {"usuario_id": "2", "conversacion_completa": "user: a", "parte": "0"}, {"usuario_id": "3", "conversacion_completa": " "})
    more.coalesce(1).write.mode("append").options(header="true", quote='"', escape='"').csv(source)
    start_csv_ingest(spark, source, out, state).awaitTermination()
    rows = {r.usuario_id: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"1", "2"} and rows["1"].numero_conversaciones == 2 and rows["2"].token_pregunta == 1


def test_scratch_is_the_named_folder(spark):
    assert new_path(spark, "x").startswith(scratch_root(spark))
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_manifests_in_pieces(spark, tmp_path):
    """Exact pieces in the order of the URIs; an empty folder is an error."""
    from charlake.sources.files import file_inventory, write_manifests

    spark.range(0, 23, 1, 23).write.option("header", True).csv(str(tmp_path / "csv"))
    index = {r.numero: r for r in write_manifests(spark, str(tmp_path / "csv"), str(tmp_path / "out"), 5).collect()}
    uris = sorted(r.uri for r in file_inventory(spark, str(tmp_path / "csv")).collect())
    assert [index[i].archivos for i in range(5)] == [5, 5, 5, 5, 3] and len(index) == 5 and len(uris) == 23
    assert all((index[i].primero, index[i].ultimo) == (uris[5 * i], uris[min(5 * i + 4, 22)]) for i in range(5))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no CSV files"):
        write_manifests(spark, str(tmp_path / "empty"), str(tmp_path / "none"))


def test_many_tasks_write_manifests(spark, tmp_path):
    from charlake.sources.files import write_manifests

    spark.range(0, 64, 1, 64).write.option("header", True).csv(str(tmp_path / "csv"))
    index = write_manifests(spark, str(tmp_path / "csv"), str(tmp_path / "out"), 2).collect()
    made = list((tmp_path / "out" / "manifests").glob("numero=*/part-*"))
    assert len(index) == len(made) == 32 and sum(r.archivos for r in index) == 64
    assert len({p.name.split("-")[1] for p in made}) > 2
