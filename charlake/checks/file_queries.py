"""Sources and sinks: what is written must come back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from charlake.catalog.tables import register_parquet, sync_table
from charlake.checks import sql as S
from charlake.checks.fixture import CFG, items, iso, table, whole_items
from charlake.checks.registry import query
from charlake.checks.table_queries import FEEDBACK_TABLES, TYPED, USER_TABLES, users
from charlake.config import PROFILE_FIELDS
from charlake.operators.scratch import new_path, written
from charlake.plans import build_feedback_table, render_user_table
from charlake.schemas import USER_CSV
from charlake.sources.evolution import read_widened
from charlake.sources.files import file_inventory, manifest, read_csv, read_evolved, write_csv, write_feedback, write_manifests, write_parquet, write_verified
from charlake.sources.items import read_items, read_plain_items, read_typed_export
from charlake.sources.quarantine import ingest_csv
from charlake.streaming.csv_ingest import start_csv_ingest
from charlake.streaming.csv_upsert import read_current, start_csv_upsert

_ITEM_ROWS = S.with_(S.EV, S.SEG, S.ITEMS, (
    "sizes AS (SELECT conv_id, segmento, CAST(count(*) AS INTEGER) AS n FROM seg GROUP BY ALL)"
), select=(
    "SELECT i.usuario_id, i.sk, i.kind, epoch_us(i.item_ts) AS item_us, epoch_us(i.created_at) AS created_us, "
    "i.nombre, i.ciudad, i.fb_type AS tipo, i.fb_comment AS comentario, coalesce(s.n, 0) AS mensajes "
    "FROM items i LEFT JOIN sizes s ON s.conv_id = i.conv_id AND s.segmento = i.segmento"
))


def _item_rows(rows):
    return rows.select(
        "usuario_id", "sk", "kind", F.unix_micros("item_ts").alias("item_us"), F.unix_micros("created_at").alias("created_us"),
        "profile.nombre", "profile.ciudad", F.col("feedback.type").alias("tipo"), F.col("feedback.comment").alias("comentario"),
        F.coalesce(F.size("messages"), F.lit(0)).alias("mensajes"),
    )


@query("items_scan", _ITEM_ROWS)
def items_scan(spark, d):
    path = new_path(spark, "items")
    write_parquet(items(spark, d), path)
    return _item_rows(read_items(spark, path))


@query("typed_export_decode", _ITEM_ROWS.replace("SELECT i.usuario_id, i.sk", "SELECT coalesce(i.usuario_id, '') AS usuario_id, coalesce(i.sk, '') AS sk"))
def typed_export_decode(spark, d):
    """Items as a typed-JSON export, one object per line, and back."""

    def s(c):
        return F.when(c.isNotNull(), F.struct(c.alias("S")))

    def fields(prefix, names):
        return F.struct(F.struct(*[s(F.col(f"{prefix}.{n}")).alias(n) for n in names]).alias("M"))

    # A third of the items holds its attributes as texts.
    as_text = F.pmod(F.xxhash64("sk"), F.lit(3)) == 0
    talk = F.struct(F.transform("messages", lambda m: F.struct(F.struct(
        s(m["role"]).alias("from"), s(m["text"]).alias("text"), s(iso(m["ts"])).alias("timestamp")
    ).alias("M"))).alias("L"))
    profile, given = fields("profile", PROFILE_FIELDS), fields("feedback", ("type", "comment", "option"))
    attributes = {
        "UserData": (profile, F.to_json("profile")),
        "Conversation": (F.when(F.col("messages").isNotNull(), talk), F.to_json(_plain_talk())),
        "Feedback": (F.when(F.col("feedback").isNotNull(), given), F.to_json("feedback")),
    }

    def item(text: bool):
        return F.to_json(F.struct(F.struct(
            s(F.concat(F.lit("USER#"), F.coalesce("usuario_id", F.lit("")))).alias("PK"), s(F.coalesce("sk", F.lit(""))).alias("SK"),
            s(iso(F.col("created_at"))).alias("CreatedAt"), *[(s(t) if text else v).alias(a) for a, (v, t) in attributes.items()],
        ).alias("Item")))

    path = new_path(spark, "export")
    items(spark, d).select(F.when(as_text, item(True)).otherwise(item(False)).alias("value")).write.text(path)
    return _item_rows(read_typed_export(spark, path))


def _plain_talk():
    return F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["text"].alias("text"), iso(m["ts"]).alias("timestamp")))


@query("plain_items_scan", _ITEM_ROWS.replace("SELECT i.usuario_id, i.sk", "SELECT coalesce(i.usuario_id, '') AS usuario_id, coalesce(i.sk, '') AS sk"))
def plain_items_scan(spark, d):
    """Items as plain JSON objects, and back."""
    path = new_path(spark, "plain")
    items(spark, d).select(F.to_json(F.struct(
        F.concat(F.lit("USER#"), F.coalesce("usuario_id", F.lit(""))).alias("PK"), F.coalesce("sk", F.lit("")).alias("SK"),
        iso(F.col("created_at")).alias("CreatedAt"), F.col("profile").alias("UserData"),
        _plain_talk().alias("Conversation"), F.col("feedback").alias("Feedback"),
    )).alias("value")).write.text(path)
    return _item_rows(read_plain_items(spark, path))


_RENDERED = (
    "SELECT usuario_id, nombre, ciudad, coalesce(strftime(fecha_primera_conversacion, '%d/%m/%Y'), 'Sin fecha') AS fecha_primera_conversacion, "
    "CAST(numero_conversaciones AS VARCHAR) AS numero_conversaciones, nullif(conversacion_completa, '') AS conversacion_completa, "
    "nullif(feedback_total, '') AS feedback_total, nullif(respuesta_feedback, '') AS respuesta_feedback, CAST(parte AS VARCHAR) AS parte FROM users"
)


def _csv(spark, d) -> str:
    path = new_path(spark, "users-csv")
    write_csv(render_user_table(users(spark, d), CFG), path)
    return path


@query("csv_roundtrip", S.with_(*USER_TABLES, select=_RENDERED))
def csv_roundtrip(spark, d):
    """Quotes, commas and line breaks come back; an empty text comes back as NULL."""
    return read_csv(spark, _csv(spark, d), USER_CSV).select(
        "usuario_id", "nombre", "ciudad", "fecha_primera_conversacion", "numero_conversaciones", "conversacion_completa",
        "feedback_total", "respuesta_feedback", "parte",
    )


@query("parquet_roundtrip", S.with_(*FEEDBACK_TABLES, select=(
    "SELECT count(*) AS filas, 13 AS columnas, true AS filas_iguales, true AS valores_iguales, true AS esquema_igual FROM fbt"
)))
def parquet_roundtrip(spark, d):
    table = build_feedback_table(whole_items(spark, d), CFG)
    return write_verified(table, new_path(spark, "feedback"))


@query("output_manifest", S.with_(*USER_TABLES, select=(
    "SELECT 'CSV' AS formato, 'true' AS con_encabezado, true AS todos_listados, count(*) AS filas FROM users"
)))
def output_manifest(spark, d):
    """The manifest lists every file, and the files hold every row."""
    path = _csv(spark, d)
    doc = F.from_json("manifest", "fileLocations array<struct<URIs:array<string>>>, globalUploadSettings struct<format:string,containsHeader:string>")
    listed = manifest(spark, path).select(doc.alias("m"), "archivos")
    n_files = F.size(F.col("m.fileLocations")[0]["URIs"])
    rows = read_csv(spark, path, USER_CSV).agg(F.count(F.lit(1)).alias("filas"))
    head = listed.select(
        F.col("m.globalUploadSettings.format").alias("formato"), F.col("m.globalUploadSettings.containsHeader").alias("con_encabezado"),
        (n_files == F.col("archivos")).alias("todos_listados"), F.lit(None).cast("bigint").alias("filas"),
    )
    return head.unionByName(rows, allowMissingColumns=True).agg(*[
        F.max(c).alias(c) for c in ("formato", "con_encabezado", "todos_listados", "filas")
    ])


@query("manifest_parts", S.with_(*USER_TABLES, select="SELECT true AS todos_listados, true AS una_vez, true AS acotados, true AS en_indice, count(*) AS filas FROM users"))
def manifest_parts(spark, d):
    """Manifests of at most four files each: their URIs are the inventory, each once, and the index counts them."""
    path, out = new_path(spark, "users-csv"), new_path(spark, "manifests")
    write_csv(render_user_table(users(spark, d), CFG), path, rows_per_file=10)
    index = write_manifests(spark, path, out, files_per_manifest=4)
    doc = F.from_json("value", "fileLocations array<struct<URIs:array<string>>>")
    listed = spark.read.text(f"{out}/manifests", wholetext=True).select("numero", F.explode(doc["fileLocations"][0]["URIs"]).alias("uri"))
    sizes = listed.groupBy("numero").agg(F.count(F.lit(1)).alias("n")).join(index, "numero")
    kept = file_inventory(spark, path).select("uri").join(listed, "uri", "full")
    rows = read_csv(spark, path, USER_CSV).agg(F.count(F.lit(1)).alias("filas"))
    parts = [
        kept.agg(F.bool_and(F.col("numero").isNotNull()).alias("todos_listados"), (F.count(F.lit(1)) == F.countDistinct("uri")).alias("una_vez")),
        sizes.agg(F.bool_and(F.col("n") <= 4).alias("acotados"), F.bool_and(F.col("n") == F.col("archivos")).alias("en_indice")), rows,
    ]
    together = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return together.agg(*[F.max(c).alias(c) for c in ("todos_listados", "una_vez", "acotados", "en_indice", "filas")])


@query("file_inventory", S.with_(*USER_TABLES, select="SELECT 'csv' AS extension, count(*) AS filas, CAST(0 AS BIGINT) AS vacios FROM users"))
def file_inventory_query(spark, d):
    """The rows of all listed files together. File names differ from run to run."""
    path = _csv(spark, d)
    extension = F.element_at(F.split("archivo", r"\."), -1)
    rows = read_csv(spark, path, USER_CSV).groupBy(F.col("_metadata.file_name").alias("archivo")).agg(F.count(F.lit(1)).alias("filas"))
    return file_inventory(spark, path).join(rows, "archivo", "left").groupBy(extension.alias("extension")).agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"), F.count_if(F.col("bytes") == 0).alias("vacios")
    )


@query("feedback_sink", S.with_(*FEEDBACK_TABLES, select="SELECT feedback, count(*) AS filas FROM fbt GROUP BY feedback"))
def feedback_sink(spark, d):
    """The feedback table written under its fixed name and read back."""
    path = write_feedback(build_feedback_table(whole_items(spark, d), CFG), new_path(spark, "feedback"), "both")
    return spark.read.parquet(path).groupBy("feedback").agg(F.count(F.lit(1)).alias("filas"))


@query("schema_evolution_merge", S.with_(*FEEDBACK_TABLES, select=(
    "SELECT usuario_id, fecha, feedback, mensaje_usuario, CAST(NULL AS VARCHAR) AS canal FROM fbt WHERE feedback <> 'like' "
    "UNION ALL SELECT usuario_id, fecha, feedback, mensaje_usuario, 'web' FROM fbt WHERE feedback = 'like'"
)))
def schema_evolution_merge(spark, d):
    """Likes are written with one more column than the rest; both read as one table."""
    columns = ["usuario_id", "fecha", "feedback", "mensaje_usuario"]
    table = build_feedback_table(whole_items(spark, d), CFG).select(*columns)
    path = new_path(spark, "evolving")
    write_parquet(table.where("feedback <> 'like'"), f"{path}/v=1")
    write_parquet(table.where("feedback = 'like'").withColumn("canal", F.lit("web")), f"{path}/v=2")
    register_parquet(spark, "chat_feedback_evolving", path)
    by_path = read_evolved(spark, f"{path}/v=1", f"{path}/v=2")
    assert set(by_path.columns) == {*columns, "canal"}
    return spark.table("chat_feedback_evolving").select(*columns, "canal")


@query("catalog_table", S.with_(*FEEDBACK_TABLES, select=(
    "SELECT feedback, count(*) AS filas, count(*) FILTER (WHERE feedback = 'like') AS con_canal FROM fbt GROUP BY feedback"
)))
def catalog_table(spark, d):
    """A catalogue table over a folder that gets files with one more column: altered in place, then read by SQL."""
    table = build_feedback_table(whole_items(spark, d), CFG).select("usuario_id", "feedback")
    path, name = new_path(spark, "catalogued"), f"chat_feedback_{uuid.uuid4().hex}"
    write_parquet(table.where("feedback <> 'like'"), path)
    assert sync_table(spark, name, path)["added"] == ["usuario_id", "feedback"]
    table.where("feedback = 'like'").withColumn("canal", F.lit("web")).write.mode("append").parquet(path)
    assert sync_table(spark, name, path) == {"added": ["canal"], "changed": [], "deleted": [], "clashing": []}
    return spark.sql(f"SELECT feedback, count(*) AS filas, count(canal) AS con_canal FROM {name} GROUP BY feedback")


@query("incremental_csv_ingest", S.with_(*USER_TABLES, TYPED, select=(
    "SELECT usuario_id, parte, fecha_primera_conversacion, numero_conversaciones, numero_preguntas, feedback, "
    "nullif(respuesta_feedback, '') AS respuesta_feedback, token_pregunta, token_respuesta FROM typed"
)))
def incremental_csv_ingest(spark, d):
    """All files there are through the stream, then a second run that must find nothing new."""
    path, out, checkpoint = _csv(spark, d), new_path(spark, "ingested"), new_path(spark, "ingest-checkpoint")
    for _ in range(2):
        start_csv_ingest(spark, path, out, checkpoint, CFG).awaitTermination()
    return spark.read.parquet(out).select(
        "usuario_id", "parte", "fecha_primera_conversacion", "numero_conversaciones", "numero_preguntas", "feedback",
        "respuesta_feedback", "token_pregunta", "token_respuesta",
    )




_EVEN = "numero_feedback % 2 = 0"


def _deliveries(spark, d) -> tuple[str, str]:
    """All users in an old form with a further part, then those with an even number of feedbacks as they are."""
    path = new_path(spark, "deliveries")
    rows = written(render_user_table(users(spark, d), CFG), "delivered")
    old = rows.withColumn("nombre", F.lit("viejo"))
    write_csv(old.union(old.where("parte = '0'").withColumn("parte", F.lit("99"))), f"{path}/2024-01-01")
    return path, written(rows.where(_EVEN), "newer")


@query("csv_upsert", S.with_(*USER_TABLES, TYPED, select=(
    f"SELECT usuario_id, nombre, parte, numero_feedback, token_pregunta FROM typed WHERE coalesce(numero_feedback, 0) % 2 = 0 "
    f"UNION ALL SELECT usuario_id, 'viejo', parte, numero_feedback, token_pregunta FROM typed WHERE coalesce(numero_feedback, 0) % 2 = 1 "
    f"UNION ALL SELECT usuario_id, 'viejo', 99, numero_feedback, token_pregunta FROM typed WHERE coalesce(numero_feedback, 0) % 2 = 1 AND parte = 0"
)))
def csv_upsert(spark, d):
    """Two overlapping deliveries through the stream: a user is what the last delivery says, and a third run finds nothing new."""
    path, newer = _deliveries(spark, d)
    out, checkpoint = new_path(spark, "upserted"), new_path(spark, "upsert-checkpoint")
    start_csv_upsert(spark, path, out, checkpoint, CFG).awaitTermination()
    write_csv(newer, f"{path}/2024-02-01")
    for _ in range(2):
        start_csv_upsert(spark, path, out, checkpoint, CFG).awaitTermination()
    return read_current(spark, out).select("usuario_id", "nombre", "parte", "numero_feedback", "token_pregunta")


@query("csv_quarantine", S.with_(*USER_TABLES, select=(
    "SELECT CASE WHEN numero_feedback % 7 = 6 THEN 'sin usuario' WHEN numero_feedback % 3 = 1 THEN 'valor: numero_conversaciones' "
    "WHEN conversacion_completa = '' THEN 'sin conversación' ELSE '' END AS motivo, CAST(count(*) AS BIGINT) AS filas FROM users GROUP BY 1 "
    "UNION ALL SELECT 'mal formado', count(*) FROM users HAVING count(*) > 0"
)))
def csv_quarantine(spark, d):
    """Rows with too few columns, without a user, with an unreadable number or without a conversation are kept apart and counted."""
    rows = written(render_user_table(users(spark, d), CFG), "delivered")
    path = new_path(spark, "dirty")
    given = F.col("numero_feedback").cast("int")
    write_csv(
        rows.withColumn("usuario_id", F.when(given % 7 != 6, F.col("usuario_id")))
        .withColumn("numero_conversaciones", F.when(given % 3 == 1, F.lit("muchas")).otherwise(F.col("numero_conversaciones"))), f"{path}/all"
    )
    write_csv(rows.select("usuario_id", "nombre", "gerencia"), f"{path}/short")
    out, bad = new_path(spark, "typed"), new_path(spark, "quarantine")
    found = ingest_csv(spark, f"{path}/*", out, bad, CFG)
    n_typed, n_bad = spark.read.parquet(out).count(), spark.read.parquet(bad).count()
    sums = dict(found.groupBy((F.col("motivo") == "").alias("typed")).agg(F.sum("filas")).collect())
    # The counts hold only if the two sinks have as many rows.
    assert (sums.get(True, 0), sums.get(False, 0)) == (n_typed, n_bad)
    return found


@query("schema_widening", (
    "SELECT event_id, CAST(user_id AS BIGINT) AS user_id, CAST(value AS DOUBLE) AS value, CASE WHEN event_type = 'click' THEN CAST(event_id % 7 AS VARCHAR) ELSE event_type END AS mark, "
    "CASE WHEN event_type <> 'click' THEN true END AS flag FROM events"
))
def schema_widening(spark, d):
    """Clicks were written with narrower numbers and a number where others have a text: one table, and the catalogue follows."""
    rows, path = table(spark, d, "events"), new_path(spark, "widening")
    clicks = rows.where("event_type = 'click'").select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("double").alias("value"), (F.col("event_id") % 7).cast("int").alias("mark")
    )
    others = rows.where("event_type <> 'click'").select(
        "event_id", F.col("user_id").cast("long").alias("user_id"), F.col("value").cast("double").alias("value"), F.col("event_type").alias("mark"), F.lit(True).alias("flag")
    )
    name = f"chat_events_{uuid.uuid4().hex}"
    write_parquet(clicks, f"{path}/v=1")
    sync_table(spark, name, f"{path}/v=1")
    write_parquet(others, f"{path}/v=2")
    found, evolution = read_widened(spark, f"{path}/v=1", f"{path}/v=2")
    assert evolution.widened == {"user_id": ("bigint", "int")} and evolution.clashes == {"mark": ("int", "string")}
    others.drop("mark").write.mode("append").parquet(f"{path}/v=1")
    assert sync_table(spark, name, f"{path}/v=1") == {"added": ["flag"], "changed": ["user_id"], "deleted": [], "clashing": []}
    assert spark.table(name).agg(F.count("user_id")).first()[0] == found.count()
    return found
