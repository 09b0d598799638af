"""Items to one row per user: profile, conversations, questions and feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from charlake.config import DIALOGUE_SEPARATOR, MESSAGE_SEPARATOR, PROFILE_FIELDS, USER_TABLE_COLUMNS, ChatConfig
from charlake.functions import feedback as fb, transcripts as tr
from charlake.functions.dates import in_window_or_null, render_date
from charlake.functions.text import blank_to_empty, drop_parenthesis, empty_to, is_blank, let, matches_any
from charlake.operators.aggregates import first_non_blank
from charlake.operators.joins import join_latest
from charlake.operators.parts import by_parts
from charlake.operators.scratch import written
from charlake.schemas import ITEMS
from charlake.sources.items import CONVERSATION, FEEDBACK, REGISTER, holds_kind

PART = "parte"
ORDER = ("item_ts", "sk")
# A text's place among a user's texts: a conversation may have several cells.
PLACE = (*ORDER, "segmento")
FEEDBACK_FIELDS = ("type", "comment", "option")


def clean_profile(cfg: ChatConfig) -> list[Column]:
    """The six profile fields, empty for none; the city without its parenthesis, the name labelled if blank."""
    cleaned = {f: blank_to_empty(F.col(f"profile.{f}")) for f in PROFILE_FIELDS}
    cleaned["ciudad"] = drop_parenthesis(cleaned["ciudad"])
    cleaned["nombre"] = empty_to(cleaned["nombre"], cfg.anonymous_label)
    return [c.alias(f) for f, c in cleaned.items()]


def with_default_city(df: DataFrame, cfg: ChatConfig) -> DataFrame:
    """The default city where no place is known at all."""
    nowhere = F.lit(True)
    for f in PROFILE_FIELDS[1:]:
        nowhere = nowhere & (F.col(f) == "")
    return df.withColumn("ciudad", F.when(nowhere, F.lit(cfg.default_city)).otherwise(F.col("ciudad")))


def wanted(cfg: ChatConfig) -> Column:
    return (
        ~matches_any(F.col("ciudad"), cfg.excluded_city_words)
        & ~matches_any(F.col("nombre"), cfg.excluded_name_words)
        & in_window_or_null(F.col("fecha"), cfg.first_day, cfg.last_day)
    )


def entries(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Items as rows of the roll-up, row by row: no shuffle. Feedback passes the filters by itself."""
    more = [c for c in ("resumen", "segmento", "preguntas") if c in items.columns]
    rows = items.select(
        "usuario_id", *ORDER, "messages", *more, *[F.col(f"feedback.{f}").alias(f) for f in FEEDBACK_FIELDS],
        holds_kind(FEEDBACK).alias("es_feedback"), F.to_date("created_at").alias("fecha"), *clean_profile(cfg),
    )
    return with_default_city(rows.where(F.col("es_feedback") | wanted(cfg)), cfg)


def _profile_aggregates(cfg: ChatConfig) -> list[Column]:
    own = F.when(~F.col("es_feedback"), F.struct(*ORDER))
    label = cfg.anonymous_label
    columns = [first_non_blank(F.col("nombre"), own, default=label, ignore=(label,)).alias("nombre")]
    columns += [first_non_blank(F.col(f), own).alias(f) for f in PROFILE_FIELDS[1:]]
    columns.append(F.min_by("fecha", own).alias("fecha_primera_conversacion"))
    columns.append(F.count_if(~F.col("es_feedback")).alias("_own"))
    return columns


def _joined(field: str) -> Column:
    """The entries' texts in order; what belongs to one item goes on after a message mark. Rendered text is empty or real; a question may be a blank word."""
    used = (lambda e: ~is_blank(e[field])) if field == "pregunta" else (lambda e: e[field] != "")

    def text(kept: Column) -> Column:
        def piece(e: Column, i: Column) -> Column:
            before = F.get(kept, i - 1)
            goes_on = before["sk"].eqNullSafe(e["sk"]) & before["item_ts"].eqNullSafe(e["item_ts"]) & (e["segmento"] > 0)
            return F.concat(F.when(i == 0, "").when(goes_on, MESSAGE_SEPARATOR).otherwise(DIALOGUE_SEPARATOR), e[field])

        return F.array_join(F.transform(kept, piece), "")

    return let(F.filter(F.col("_entries"), used), text)


def _transcript(cfg: ChatConfig) -> Column:
    return tr.render_messages(F.col("messages"), cfg.role_words).alias("transcript")


def _feedback_text() -> Column:
    return fb.feedback_text(F.col("type"), F.col("comment"), F.col("option"))


def _cells(rows: DataFrame, group: list[str]) -> DataFrame:
    """The three texts of a user, or of a part of a long history."""
    entry = F.struct(*PLACE, "transcript", "pregunta", "feedback_text")
    grouped = rows.groupBy(*group).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    return grouped.select(
        *group,
        _joined("transcript").alias("conversacion_completa"),
        _joined("feedback_text").alias("feedback_total"),
        _joined("pregunta").alias("pregunta_conversacion"),
    )


_VALUES = (
    "usuario_id", *PROFILE_FIELDS, "fecha_primera_conversacion", "numero_conversaciones", "numero_feedback", "numero_preguntas", "feedback"
)


def _known(items: DataFrame) -> DataFrame:
    return items.where(~holds_kind(REGISTER) & F.col("usuario_id").isNotNull())


def _summarized(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Items with the summary of their conversation: as it comes with them, else from their messages."""
    if "resumen" in items.columns:
        return items
    return items.withColumn("resumen", tr.summary_of(F.col("messages"), cfg.role_words, cfg.user_roles, cfg.reply_roles))


def _of_summary(name: str) -> Column:
    return F.coalesce(F.col(f"resumen.{name}"), F.lit(0))


def _text_rows(items: DataFrame, cells: DataFrame | None) -> DataFrame:
    """The rows that have the texts: the items, or other items and the cells of conversations."""
    if cells is None:
        return items.withColumn("segmento", F.lit(0))
    others = items.where(~holds_kind(CONVERSATION)).select(*ITEMS.fieldNames())
    none = F.lit(None).cast("array<string>").alias("preguntas")
    return others.select("*", F.lit(0).alias("segmento"), none).unionByName(cells.select(*ITEMS.fieldNames(), "segmento", "preguntas"))


def user_values(items: DataFrame, cfg: ChatConfig = ChatConfig()) -> DataFrame:
    """One row per user without the texts, by plain partial aggregates, and whether there are questions and transcripts."""
    own = ~F.col("es_feedback")
    rows = entries(_known(_summarized(items, cfg)), cfg).select(
        "usuario_id", *ORDER, "es_feedback", "fecha", *PROFILE_FIELDS, F.lower(F.trim("type")).alias("_word"),
        F.when(own, F.greatest(_of_summary("turnos_usuario"), _of_summary("turnos_bot"), F.lit(1))).alias("turnos"),
        F.when(own, _of_summary("turnos_usuario")).alias("preguntas"),
        F.coalesce("resumen.con_preguntas", F.lit(False)).alias("_asked"),
        (_of_summary("mensajes") > 0).alias("_spoken"),
    )
    grouped = rows.groupBy("usuario_id").agg(
        *_profile_aggregates(cfg),
        F.coalesce(F.sum("turnos"), F.lit(0)).cast("int").alias("numero_conversaciones"),
        F.count_if(F.col("_word").isin("like", "dislike")).cast("int").alias("numero_feedback"),
        F.coalesce(F.sum("preguntas"), F.lit(0)).cast("int").alias("numero_preguntas"),
        F.coalesce(F.bool_or(F.col("_word") == "like"), F.lit(False)).alias("_like"),
        F.coalesce(F.bool_or(F.col("_word") == "dislike"), F.lit(False)).alias("_dislike"),
        F.bool_or("_asked").alias("con_preguntas"),
        F.bool_or("_spoken").alias("con_transcript"),
    )
    named = grouped.where(F.col("_own") > 0).withColumn("feedback", fb.class_of(F.col("_like"), F.col("_dislike")))
    return named.select(*_VALUES, "con_preguntas", "con_transcript")


def _answers(items: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Each answer of a user once, comments in time order, then options; a long list goes on in further parts."""
    given = _known(items).where(holds_kind(FEEDBACK)).select(
        "usuario_id", *ORDER, F.explode(F.array(
            F.struct(F.lit(0).alias("orden"), F.col("feedback.comment").alias("valor")),
            F.struct(F.lit(1).alias("orden"), F.col("feedback.option").alias("valor")),
        )).alias("s"),
    ).select("usuario_id", *ORDER, "s.orden", F.explode(fb.said(F.array("s.valor"))).alias("valor"))
    first = given.groupBy("usuario_id", "valor").agg(F.min(F.struct("orden", *ORDER)).alias("p")).select("usuario_id", "valor", "p.*")

    def build(rows: DataFrame, group: list[str]) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("orden", *ORDER, "valor")))
        return rows.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda e: e["valor"]), MESSAGE_SEPARATOR).alias("respuesta_feedback"))

    return by_parts(first, ["usuario_id"], ["orden", *ORDER], cfg.answers_per_row, PART, build, size=F.octet_length("valor"), bytes_per_part=cfg.bytes_per_row)


def _build_each_once(items: DataFrame, cfg: ChatConfig, cells: DataFrame | None) -> DataFrame:
    asked = tr.questions_of(F.col("messages"), cfg.role_words) if cells is None else F.col("preguntas")

    def build(rows: DataFrame, group: list[str]) -> DataFrame:
        return _cells(rows.select(
            *group, *PLACE, _transcript(cfg),
            F.array_join(asked, MESSAGE_SEPARATOR).alias("pregunta"),
            F.when(F.col("es_feedback"), _feedback_text()).alias("feedback_text"),
        ), group)

    # Rows without any text have no place in a cell, so no part is empty. They are written once, to be weighed and then put together.
    spoken = entries(_known(_text_rows(items, cells)), cfg).where(F.col("es_feedback") | (F.size("messages") > 0))
    columns = ("usuario_id", *PLACE, "es_feedback", "messages", *FEEDBACK_FIELDS, *(() if cells is None else ("preguntas",)))
    size = tr.text_bytes(F.col("messages")) + F.when(F.col("es_feedback"), F.octet_length(_feedback_text())).otherwise(0)
    spoken = written(spoken.select(*columns, size.alias("_bytes")), "texts")
    texts = by_parts(spoken, ["usuario_id"], PLACE, cfg.items_per_row, PART, build, size=F.col("_bytes"), bytes_per_part=cfg.bytes_per_row)
    parts = texts.join(_answers(items, cfg), ["usuario_id", PART], "full")
    return user_values(items, cfg).select(*_VALUES).join(parts, "usuario_id", "left")


def _build_latest_on_each(items: DataFrame, cfg: ChatConfig, cells: DataFrame | None) -> DataFrame:
    given = _known(items).where(holds_kind(FEEDBACK)).select("usuario_id", *ORDER, "feedback.*")
    said = F.coalesce(*FEEDBACK_FIELDS).isNotNull()

    def merged(rows: DataFrame) -> DataFrame:
        own = entries(_known(rows), cfg).where(~F.col("es_feedback"))
        found = join_latest(own.where(holds_kind(CONVERSATION)), given, "usuario_id", FEEDBACK_FIELDS, ORDER)
        return found.unionByName(own.where(~holds_kind(CONVERSATION)))

    rows = merged(_summarized(items, cfg)).withColumn("feedback_text", F.when(said, _feedback_text()))
    values = rows.groupBy("usuario_id").agg(
        *_profile_aggregates(cfg),
        F.sum(F.greatest(_of_summary("dice_bot"), _of_summary("dice_usuario"), F.lit(1))).cast("int").alias("numero_conversaciones"),
        F.sum(fb.count_text(F.col("feedback_text"))).cast("int").alias("numero_feedback"),
        F.sum(_of_summary("dice_preguntas")).cast("int").alias("numero_preguntas"),
        F.max("feedback_text").alias("_given"),  # the same on each of the user's conversations
    ).withColumns({"feedback": fb.class_text(F.col("_given")), "respuesta_feedback": fb.answers_text(F.col("_given"))})

    asked = tr.questions_text(F.col("transcript"), cfg.rules()) if cells is None else F.array_join("preguntas", MESSAGE_SEPARATOR)

    def build(part: DataFrame, group: list[str]) -> DataFrame:
        return _cells(part.select("*", asked.alias("pregunta")), group)

    # The feedback stands on a conversation once, however many cells it has.
    spoken = merged(_text_rows(items, cells)).select(
        "usuario_id", *PLACE, *(() if cells is None else ("preguntas",)), _transcript(cfg),
        F.when(said & (F.col("segmento") == 0), _feedback_text()).alias("feedback_text"),
    ).where((F.col("transcript") != "") | F.col("feedback_text").isNotNull())
    size = F.octet_length("transcript") + F.coalesce(F.octet_length("feedback_text"), F.lit(0))
    spoken = written(spoken.withColumn("_bytes", size), "texts")
    texts = by_parts(spoken, ["usuario_id"], PLACE, cfg.items_per_row, PART, build, size=F.col("_bytes"), bytes_per_part=cfg.bytes_per_row)
    return values.select(*_VALUES, "respuesta_feedback").join(texts, "usuario_id", "left")


def build_user_table(items: DataFrame, cfg: ChatConfig = ChatConfig(), feedback: str = "each_once", cells: DataFrame | None = None) -> DataFrame:
    """The sixteen columns plus `parte`.

    Items have their messages; or, where conversations are too long for a row, a `resumen` (see `operators.conversations.summaries`),
    and `cells` has the messages: columns of items, `segmento` (from 0) and `preguntas`, the questions first asked in the cell.
    All cells of a conversation have its time and sort key. Values come from whole conversations either way.

    `feedback="each_once"` lists and counts every feedback once, and counts turns and questions by
    role. `feedback="latest_on_each"` puts the user's last feedback on each of their conversations
    and reads counts, questions and classes back from the rendered text.

    Profile, counts, dates and classes are the user's, worked out the same way whatever the user's size, and
    stand in each of the user's rows. `parte` numbers cells of text only: a user has one row, part 0, up to
    `cfg.items_per_row` items with text and `cfg.answers_per_row` different answers; longer texts go on in
    parts 1, 2, …, which follow each other without a gap.
    """
    if feedback not in ("each_once", "latest_on_each"):
        raise ValueError(f"unknown feedback mode: {feedback}")
    if cells is not None:
        if "resumen" not in items.columns:
            raise ValueError("items need a resumen where their messages are in cells")
        # Without their messages items are narrow; they are worked out once for values, answers and texts.
        items = written(items.select("*"), "items")
    rows = (_build_each_once if feedback == "each_once" else _build_latest_on_each)(items, cfg, cells)
    texts = ("conversacion_completa", "feedback_total", "pregunta_conversacion", "respuesta_feedback")
    filled = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in texts} | {PART: F.coalesce(PART, F.lit(0))})
    return filled.select(*USER_TABLE_COLUMNS, PART)


def render_user_table(users: DataFrame, cfg: ChatConfig = ChatConfig()) -> DataFrame:
    """All text, as the CSV sink takes it: dates as `dd/MM/yyyy` or the no-date label."""
    return users.select(*[
        render_date(F.col(c), cfg.no_date_label).alias(c) if kind == "date" else F.col(c).cast("string").alias(c)
        for c, kind in users.dtypes
    ])
