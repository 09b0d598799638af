"""The item store: Parquet or JSON tables of items, and typed-JSON exports of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.config import PROFILE_FIELDS
from charlake.functions.dates import parse_timestamp
from charlake.schemas import ITEMS

REGISTER, CONVERSATION, FEEDBACK = "REGISTER", "CONVERSATION", "FEEDBACK"
FEEDBACK_FIELDS = ("type", "comment", "option")


def read_items(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.schema(ITEMS).format(format).load(path)


def user_id(pk: Column) -> Column:
    return F.regexp_replace(pk, "^USER#", "")


def sort_key_kind(sk: Column) -> Column:
    return F.when(sk.contains("#"), F.substring_index(sk, "#", 1)).otherwise(F.lit("UNKNOWN"))


def sort_key_time(sk: Column) -> Column:
    rest = F.substring(sk, F.locate("#", sk) + 1, F.length(sk))
    return F.when(sk.contains("#"), parse_timestamp(rest))


def is_kind(kind: str) -> Column:
    """A missing kind is none of the kinds."""
    return F.coalesce(F.col("kind") == kind, F.lit(False))


def holds_kind(kind: str) -> Column:
    """The older rule: the kind's word stands anywhere in the sort key, in any case."""
    return F.coalesce(F.upper("sk").contains(kind), F.lit(False))


def not_register() -> Column:
    return F.coalesce(F.col("kind") != REGISTER, F.lit(True))


def is_other() -> Column:
    return not_register() & ~F.coalesce(F.col("kind").isin(CONVERSATION, FEEDBACK), F.lit(False))


# --- typed JSON -------------------------------------------------------------


def typed_number(n: Column) -> Column:
    """A typed number as text: whole numbers as they are, others as a double; bad text stays."""
    whole = n.try_cast("bigint").cast("string")
    real = n.try_cast("double").cast("string")
    return F.coalesce(F.when(n.contains("."), real).otherwise(whole), n)


def typed_scalar(v: Column) -> Column:
    """A typed scalar as text; sets become JSON lists. NULL for the NULL tag."""
    numbers = F.transform(v["NS"], lambda n: n.try_cast("double"))
    return F.coalesce(
        v["S"], typed_number(v["N"]), v["BOOL"].cast("string"),
        F.to_json(v["SS"]), F.to_json(numbers), F.to_json(v["BS"]),
    )


# Attributes are read as text: a nested map or list comes as its JSON, a text as it is.
_ATTRIBUTES = ("PK", "SK", "CreatedAt", "UserData", "Conversation", "Feedback")
_TAGS = ("S", "M", "L")


def read_typed_export(spark: SparkSession, path: str) -> DataFrame:
    """Items from an export of one typed-JSON object per line, wrapped in `Item` or not.

    `UserData`, `Conversation` and `Feedback` may be maps or lists, or texts that hold them.
    """
    tagged = ", ".join(f"{a} struct<{', '.join(f'{t}:string' for t in _TAGS)}>" for a in _ATTRIBUTES)
    raw = _lines(spark, path, f"Item struct<{tagged.replace(' struct', ':struct')}>, {tagged}")
    values = [F.coalesce(*[F.col(f"{place}{a}.{t}") for place in ("Item.", "") for t in _TAGS]).alias(a) for a in _ATTRIBUTES]
    return decode_items(raw.select(*values))


def read_plain_items(spark: SparkSession, path: str) -> DataFrame:
    """Items as plain JSON objects, one per line: `PK`, `SK`, `CreatedAt`, `UserData`, `Conversation`, `Feedback`."""
    return decode_items(_lines(spark, path, ", ".join(f"{a} string" for a in _ATTRIBUTES)))


def undecodable(spark: SparkSession, path: str) -> DataFrame:
    """How many lines there are, and how many are no JSON object with a `PK`, wrapped or not, or have an attribute that says nothing."""
    item = F.coalesce(F.get_json_object("value", "$.Item"), F.col("value"))
    lines = spark.read.text(path).select(item.alias("item"))
    key = F.coalesce(*[F.get_json_object("item", f"$.PK{t}") for t in (".S", "")])
    silent = F.lit(False)
    for name, decode in (("UserData", profile_from_text), ("Conversation", messages_from_text), ("Feedback", feedback_from_text)):
        value = F.get_json_object("item", f"$.{name}")
        given = value.isNotNull() & F.get_json_object("item", f"$.{name}.NULL").isNull()
        found = decode(F.coalesce(*[F.get_json_object("item", f"$.{name}.{t}") for t in _TAGS], value))
        said = F.size(found) > 0 if name == "Conversation" else F.coalesce(*[found[f] for f in (PROFILE_FIELDS if name == "UserData" else FEEDBACK_FIELDS)]).isNotNull()
        silent = silent | (given & ~F.coalesce(said, F.lit(False)))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(key.isNull() | silent).alias("undecodable"))


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def decode_items(raw: DataFrame) -> DataFrame:
    """Items from six text columns. An attribute in no known form gives NULL fields; a conversation in none is one message."""
    sk = F.col("SK")
    return raw.select(
        user_id(F.col("PK")).alias("usuario_id"),
        sk.alias("sk"),
        sort_key_kind(sk).alias("kind"),
        sort_key_time(sk).alias("item_ts"),
        parse_timestamp(F.col("CreatedAt")).alias("created_at"),
        profile_from_text(F.col("UserData")).alias("profile"),
        messages_from_text(F.col("Conversation")).alias("messages"),
        feedback_from_text(F.col("Feedback")).alias("feedback"),
    )


def _untagged(value: Column) -> Column:
    """The text of a typed value, or the value itself."""
    return F.when(value.startswith("{"), F.coalesce(F.get_json_object(value, "$.S"), value)).otherwise(value)


def _fields(c: Column, names: tuple[str, ...]) -> Column:
    """Fields of a JSON object, plain or typed; the object may stand in `M`."""
    parsed = F.from_json(F.coalesce(F.get_json_object(c, "$.M"), c), ", ".join(f"{n} string" for n in names))
    return F.struct(*[_untagged(parsed[n]).alias(n) for n in names])


def profile_from_text(c: Column) -> Column:
    """The profile from a JSON object text."""
    return _fields(c, tuple(PROFILE_FIELDS))


def feedback_from_text(c: Column) -> Column:
    """The feedback from a JSON object text, NULL for no feedback."""
    return F.when(c.isNotNull(), _fields(c, FEEDBACK_FIELDS))


def messages_from_text(c: Column) -> Column:
    """The messages of a JSON list, of one JSON message, or of a rendered transcript (`role: text | role: text`)."""
    text = F.btrim(c)
    inside = F.coalesce(F.get_json_object(text, "$.L"), text)
    listed = F.when(inside.startswith("["), inside).when(inside.startswith("{"), F.concat(F.lit("["), inside, F.lit("]")))
    parsed = F.transform(F.from_json(listed, "array<string>"), lambda m: _fields(m, ("from", "text", "timestamp")))
    plain = F.transform(
        F.split(text, r" \|\|? "),
        lambda m: F.struct(
            F.regexp_extract(m, r"(?s)^\s*(\w+):", 1).alias("from"), F.regexp_replace(m, r"(?s)^\s*\w+:\s*", "").alias("text"), F.lit(None).cast("string").alias("timestamp")
        ),
    )
    found = F.when(listed.isNotNull() & parsed.isNotNull(), parsed).when(F.length(text) > 0, plain)
    return F.transform(
        found,
        lambda m, i: F.struct(
            i.cast("int").alias("turn"), F.coalesce(m["from"], F.lit("")).alias("role"),
            F.coalesce(m["text"], F.lit("")).alias("text"), parse_timestamp(m["timestamp"]).alias("ts"),
        ),
    )
