"""Feedback values, as structs and as stored text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from charlake.config import FEEDBACK_CLASSES, MESSAGE_SEPARATOR
from charlake.functions.text import count_of, is_blank, let, strip

_EMPTY = "array<string>"


def feedback_text(type_: Column, comment: Column, option: Column) -> Column:
    """`{"type": "like", "comment": "…", "option": "…"}`.

    A quote inside a value is escaped, so the key marks below stand only where the keys are.
    """
    values = {"type": type_, "comment": comment, "option": option}
    text = F.to_json(F.struct(*[F.coalesce(v, F.lit("")).alias(k) for k, v in values.items()]))
    for mark, spaced in (('{"type":', '{"type": '), (',"comment":', ', "comment": '), (',"option":', ', "option": ')):
        text = F.replace(text, F.lit(mark), F.lit(spaced))
    return text


def parse_feedback(c: Column) -> Column:
    """A JSON object to type, comment and option; other text gives NULL fields."""
    return F.from_json(c, "type string, comment string, option string")


def class_of(has_like: Column, has_dislike: Column) -> Column:
    return (
        F.when(has_like & has_dislike, F.lit("mixed"))
        .when(has_like, F.lit("like"))
        .when(has_dislike, F.lit("dislike"))
        .otherwise(F.lit(""))
    )


def count_text(c: Column) -> Column:
    """Likes and dislikes named in the text; other text above 10 characters counts as one."""


    def count(low: Column) -> Column:
        total = F.lit(0)
        for word in ("like", "dislike"):
            total = total + count_of(low, f"'type': '{word}'") + count_of(low, f'"type": "{word}"')
        other = ~is_blank(low) & (F.length(low) > 10)
        return let(total, lambda t: F.when((t == 0) & other, F.lit(1)).otherwise(t))

    return let(F.lower(strip(F.coalesce(c, F.lit("")))), count)


def _values(s: Column, key: str) -> Column:
    return F.concat(
        F.regexp_extract_all(s, F.lit(rf"'{key}':\s*'([^']*)'"), F.lit(1)),
        F.regexp_extract_all(s, F.lit(rf'"{key}":\s*"([^"]*)"'), F.lit(1)),
    )


def class_text(c: Column) -> Column:
    """like, dislike, mixed or empty, from the types in the text."""


    def known(types: Column) -> Column:
        words = F.transform(types, lambda t: F.lower(strip(t)))
        return F.filter(words, lambda w: w.isin("like", "dislike"))

    def parsed(s: Column) -> Column:
        return F.coalesce(
            F.when(s.startswith("[") & s.endswith("]"), F.from_json(s, "array<struct<type:string>>")["type"]),
            F.when(s.startswith("{") & s.endswith("}"), F.array(F.get_json_object(s, "$.type"))),
            F.array().cast(_EMPTY),
        )

    def named(s: Column) -> Column:
        return let(known(_values(s, "type")), lambda q: F.when(F.size(q) > 0, q).otherwise(known(parsed(s))))

    words = let(strip(F.coalesce(c, F.lit(""))), named)
    return let(words, lambda w: class_of(F.array_contains(w, "like"), F.array_contains(w, "dislike")))


def said(values: Column) -> Column:
    """The values that say something, trimmed."""
    cleaned = F.transform(values, lambda v: strip(v))
    return F.filter(cleaned, lambda v: v.isNotNull() & ~F.lower(v).isin("", "none", "null"))


def answers_text(c: Column) -> Column:
    """Comments, then options, in the text; each once, joined by ` | `."""


    def parsed(s: Column) -> Column:
        parts = F.transform(F.split(s, r"\|"), lambda p: F.from_json(strip(p), "comment string, option string"))
        return F.flatten(F.transform(parts, lambda p: said(F.array(p["comment"], p["option"]))))

    def found(s: Column) -> Column:
        quoted = F.concat(said(_values(s, "comment")), said(_values(s, "option")))
        return let(quoted, lambda q: F.when(F.size(q) > 0, q).otherwise(F.coalesce(parsed(s), F.array().cast(_EMPTY))))

    return distinct_answers(F.array_join(let(strip(F.coalesce(c, F.lit(""))), found), MESSAGE_SEPARATOR))


def distinct_answers(c: Column) -> Column:
    """Drop repeated answers from a joined text, keeping the order."""
    parts = F.transform(F.split(c, r" \| "), strip)
    return F.array_join(F.array_distinct(F.filter(parts, lambda p: p != "")), MESSAGE_SEPARATOR)


def answers_of(comments: Column, options: Column) -> Column:
    """Comments, then options, from arrays; each once, joined by ` | `."""
    return F.array_join(F.array_distinct(F.concat(said(comments), said(options))), MESSAGE_SEPARATOR)


def feedback_class_or_null(c: Column) -> Column:
    """Lower-cased class; anything else is NULL."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*FEEDBACK_CLASSES), word)
