"""Any attribute of a typed-JSON item, at any depth up to a stated one, and the keys that JSON texts hold.

A typed value is an object of one tag: `S`, `N`, `BOOL`, `NULL`, the sets `SS`, `NS`, `BS`, and the nested `L` and `M`. It is
unwrapped to plain JSON row by row, level by level, and read back as VARIANT, so attributes need not be known beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.functions.text import is_blank, let, strip
from charlake.sources.items import user_id

# Levels of nesting that are unwrapped; what lies deeper stays as its typed JSON text.
DEPTH = 6

_KNOWN = ("S", "N", "BOOL", "NULL", "SS", "NS", "BS", "L", "M")


def quoted(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_replace(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", "$1")


def plain_number(text: Column) -> Column:
    """A typed number as JSON: whole without a dot, else a double; a text that is none stays a text."""
    whole = F.when(~text.contains("."), text.try_cast("decimal(38,0)").cast("string"))
    real = text.try_cast("double")
    finite = ~F.isnan(real) & (F.abs(real) != F.lit(float("inf")))
    return F.coalesce(whole, F.when(finite, F.to_json(F.array(real)).substr(F.lit(2), F.length(F.to_json(F.array(real))) - 2)), quoted(text))


def _list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))


def plain_json(value: Column, depth: int = DEPTH) -> Column:
    """A typed value's JSON text as plain JSON text; NULL for NULL. What has no known tag becomes a text of itself."""
    if depth == 0:
        return quoted(value)

    def of(tags: Column) -> Column:
        def numbers() -> Column:
            return _list(F.transform(F.from_json(tags["NS"], "array<string>"), plain_number))

        # One recursion for lists and maps: the children of both are keyed texts.
        listed = F.transform(F.from_json(tags["L"], "array<string>"), lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")))
        mapped = F.map_entries(F.from_json(tags["M"], "map<string,string>"))
        inside = F.transform(F.coalesce(mapped, listed), lambda c: F.struct(c["key"].alias("key"), F.coalesce(plain_json(c["value"], depth - 1), F.lit("null")).alias("value")))

        def nested(children: Column) -> Column:
            pairs = F.transform(children, lambda c: F.concat(quoted(c["key"]), F.lit(":"), c["value"]))
            as_map = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
            return F.when(tags["M"].isNotNull(), as_map).otherwise(_list(F.transform(children, lambda c: c["value"])))

        return (
            F.when(tags["S"].isNotNull(), quoted(tags["S"]))
            .when(tags["N"].isNotNull(), plain_number(tags["N"]))
            .when(tags["BOOL"].isNotNull(), F.lower(tags["BOOL"]))
            .when(tags["NULL"].isNotNull(), F.lit("null"))
            .when(tags["SS"].isNotNull(), tags["SS"])
            .when(tags["NS"].isNotNull(), numbers())
            .when(tags["BS"].isNotNull(), tags["BS"])
            .when(tags["M"].isNotNull() | tags["L"].isNotNull(), let(inside, nested))
        )

    tagged = F.from_json(value, ", ".join(f"`{t}` string" for t in _KNOWN))
    return F.when(value.isNotNull(), F.coalesce(let(tagged, of), quoted(value)))


def read_typed_attributes(spark: SparkSession, path: str, depth: int = DEPTH) -> DataFrame:
    """usuario_id, sk, atributos (VARIANT with all attributes but the keys), linea (the text, where it is no item).

    One typed-JSON object per line, wrapped in `Item` or not.
    """
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    item = F.coalesce(F.get_json_object("value", "$.Item"), F.col("value"))
    values = lines.select("value", F.from_json(item, "map<string,string>").alias("_all")).select(
        "value", F.map_filter("_all", lambda k, _: ~k.isin("PK", "SK")).alias("_more"),
        *[F.get_json_object(F.try_element_at("_all", F.lit(k)), "$.S").alias(k) for k in ("PK", "SK")],
    )
    pairs = F.transform(F.map_entries("_more"), lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.coalesce(plain_json(e["value"], depth), F.lit("null"))))
    document = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    return values.select(
        user_id(F.col("PK")).alias("usuario_id"), F.col("SK").alias("sk"),
        F.when(F.col("PK").isNotNull(), F.try_parse_json(document)).alias("atributos"),
        F.when(F.col("PK").isNull(), F.col("value")).alias("linea"),
    )


def attribute(path: str, kind: str, column: str = "atributos") -> Column:
    """A value below a path such as `$.Detalle.marcas[0]`; NULL if there is none or it is of another kind."""
    return F.try_variant_get(F.col(column), path, kind)


def key_rows(df: DataFrame, text: str) -> DataFrame:
    """The frame's other columns with `clave`, `tipo` and `valor` for each key of the JSON object in `text`.

    A text that is no JSON object is one row with an empty key and itself as value; a blank one is no row.
    A value is its text, nested ones as JSON; a null value is NULL.
    """
    others = [c for c in df.columns if c != text]
    said = df.where(~is_blank(F.col(text))).select(F.struct(*others).alias("_row"), strip(F.col(text)).alias("_text"), F.try_parse_json(F.col(text)).alias("_json"))
    is_object = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    tvf = df.sparkSession.tvf
    inside = said.where(is_object).lateralJoin(tvf.variant_explode(F.col("_json").outer())).select(
        "_row", F.col("key").alias("clave"), F.schema_of_variant("value").alias("tipo"), F.col("value").cast("string").alias("valor")
    )
    raw = said.where(~is_object).select("_row", F.lit("").alias("clave"), F.lit("STRING").alias("tipo"), F.col("_text").alias("valor"))
    return inside.union(raw).select("_row.*", "clave", F.regexp_replace("tipo", r"[<(].*", "").alias("tipo"), "valor")


def key_census(rows: DataFrame) -> DataFrame:
    """clave, filas, con_valor and tipos (how many kinds) of all keys there are, by partial counts."""
    return rows.groupBy("clave").agg(
        F.count(F.lit(1)).alias("filas"), F.count("valor").alias("con_valor"),
        F.countDistinct(F.when(F.col("tipo") != "VOID", F.col("tipo"))).alias("tipos"),
    )
