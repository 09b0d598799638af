"""Conversations as message arrays and as rendered text.

An item's messages sit in one row, so everything here is row-local: no shuffle, no Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from charlake.config import BOT_PREFIXES, DIALOGUE_SEPARATOR, MESSAGE_SEPARATOR, USER_PREFIXES
from charlake.functions.text import count_of, is_blank, let, strip
from charlake.schemas import SUMMARY

# --- message arrays ---------------------------------------------------------


def canonical_role(role: Column, role_words: Mapping[str, str]) -> Column:
    """Known role words become `user` or `bot`; others stay, lower-cased."""
    name = F.lower(strip(F.coalesce(role, F.lit(""))))
    for target in dict.fromkeys(role_words.values()):
        words = "|".join(re.escape(w) for w, t in role_words.items() if t == target)
        name = F.regexp_replace(name, f"^(?:{words})$", target)
    return name


def message_text(text: Column) -> Column:
    """A message's text on one line: a blank line or a line break is one space."""
    return strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "\n\n|\n", " "))


def render_message(role: Column, text: Column, role_words: Mapping[str, str]) -> Column:
    return F.concat(canonical_role(role, role_words), F.lit(": "), message_text(text))


def render_messages(messages: Column, role_words: Mapping[str, str]) -> Column:
    """`user: … | bot: …`; empty for no messages. The array is in turn order."""
    lines = F.transform(messages, lambda m: render_message(m["role"], m["text"], role_words))
    return F.coalesce(F.array_join(lines, MESSAGE_SEPARATOR), F.lit(""))


def text_bytes(messages: Column) -> Column:
    """Bytes of the rendered messages, or a little more; 0 for none."""
    sizes = F.transform(messages, lambda m: F.coalesce(F.octet_length(m["role"]), F.lit(0)) + F.coalesce(F.octet_length(m["text"]), F.lit(0)) + 8)
    return F.coalesce(F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n), F.lit(0))


def texts_of(messages: Column, role: str, role_words: Mapping[str, str]) -> Column:
    """The non-empty texts of one role, in turn order."""
    mine = F.filter(messages, lambda m: canonical_role(m["role"], role_words) == role)
    return F.filter(F.transform(mine, lambda m: message_text(m["text"])), lambda t: t != "")


def questions_of(messages: Column, role_words: Mapping[str, str]) -> Column:
    """The user's questions, each once, in order."""
    return F.coalesce(F.array_distinct(texts_of(messages, "user", role_words)), F.array().cast("array<string>"))


def count_role(messages: Column, role: str, role_words: Mapping[str, str]) -> Column:
    mine = F.filter(messages, lambda m: canonical_role(m["role"], role_words) == role)
    return F.coalesce(F.size(mine), F.lit(0))


def count_turns(messages: Column, role_words: Mapping[str, str]) -> Column:
    """The larger of the user's and the bot's turns, at least 1."""
    return F.greatest(
        count_role(messages, "user", role_words), count_role(messages, "bot", role_words), F.lit(1)
    )


def last_exchange(messages: Column, user_roles: Sequence[str], reply_roles: Sequence[str]) -> tuple[Column, Column]:
    """The last user message and its reply: the first reply after it, else the last reply there is."""


    def is_user(m: Column) -> Column:
        return F.lower(m["role"]).isin(*user_roles)

    def is_reply(m: Column) -> Column:
        return F.lower(m["role"]).isin(*reply_roles)

    def reply_after(last: Column) -> Column:
        following = F.filter(messages, lambda m, i: is_reply(m) & (i > last))
        any_reply = F.filter(messages, is_reply)
        return F.coalesce(F.try_element_at(following, F.lit(1)), F.try_element_at(any_reply, F.lit(-1)))

    asked = F.try_element_at(F.filter(messages, is_user), F.lit(-1))
    last_user = F.array_max(F.transform(messages, lambda m, i: F.when(is_user(m), i)))
    reply = let(last_user, reply_after)
    return F.coalesce(asked["text"], F.lit("")), F.coalesce(reply["text"], F.lit(""))


def summary_of(messages: Column, role_words: Mapping[str, str], user_roles: Sequence[str], reply_roles: Sequence[str]) -> Column:
    """A `SUMMARY` of the messages of one row; what of it is not used is not computed."""
    asked, replied = last_exchange(messages, user_roles, reply_roles)
    text = render_messages(messages, role_words)
    values = (
        asked, replied, count_role(messages, "user", role_words), count_role(messages, "bot", role_words),
        F.coalesce(F.size(messages), F.lit(0)), F.size(questions_of(messages, role_words)) > 0,
        count_of(text, "bot"), count_of(text, "user"), count_of(F.lower(text), "user:"),
    )
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, SUMMARY, strict=True)])


# --- stored text forms ------------------------------------------------------

_JSON_MESSAGE = (
    "struct<`from`:string,text:string,"
    "M:struct<`from`:struct<S:string>,text:struct<S:string>>>"
)


def _json_lines(parsed: Column, role_words: Mapping[str, str]) -> Column:
    known = F.filter(
        parsed, lambda m: m["from"].isNotNull() | m["text"].isNotNull() | m["M"].isNotNull()
    )
    return F.transform(
        known,
        lambda m: render_message(
            F.coalesce(m["M"]["from"]["S"], m["from"]), F.coalesce(m["M"]["text"]["S"], m["text"]), role_words
        ),
    )


def render_text(c: Column, role_words: Mapping[str, str]) -> Column:
    """Render a conversation stored as text: a JSON list or object, plain or typed, else as it is."""


    def render(s: Column) -> Column:
        is_list = s.startswith("[") & s.endswith("]")
        is_map = s.startswith("{") & s.endswith("}")
        listed = F.when(is_list, F.from_json(s, f"array<{_JSON_MESSAGE}>"))
        wrapped = F.when(is_map, F.from_json(s, f"struct<L:array<{_JSON_MESSAGE}>>")["L"])
        single = F.when(is_map, F.from_json(F.concat(F.lit("["), s, F.lit("]")), f"array<{_JSON_MESSAGE}>"))
        lines = _json_lines(F.coalesce(listed, wrapped, single), role_words)
        return F.when(is_blank(s), F.lit("")).otherwise(F.coalesce(F.array_join(lines, MESSAGE_SEPARATOR), s))

    return let(strip(c), render)


def split_transcript(c: Column) -> Column:
    """A rendered transcript back into messages. Pipes inside a text split it too."""
    text = F.coalesce(c, F.lit(""))
    for separator in (DIALOGUE_SEPARATOR, MESSAGE_SEPARATOR, "||"):
        text = F.replace(text, F.lit(separator), F.lit("|"))
    parts = F.split(F.translate(text, "\n\t", "  "), r"\|")
    return F.filter(F.transform(parts, strip), lambda m: m != "")


def texts_by_prefix(messages: Column, prefixes: Sequence[str], skip_invisible: bool = False) -> Column:
    """The texts of the split messages that begin with a prefix, in any case."""
    start = r"^[\s\x{200b}\x{feff}]*" if skip_invisible else r"^"
    pattern = start + "(?i:" + "|".join(prefixes) + ")"
    mine = F.filter(messages, lambda m: m.rlike(pattern))
    return F.filter(F.transform(mine, lambda m: strip(F.regexp_replace(m, pattern, ""))), lambda t: t != "")


def user_texts(messages: Column) -> Column:
    return texts_by_prefix(messages, USER_PREFIXES, skip_invisible=True)


def bot_texts(messages: Column) -> Column:
    return texts_by_prefix(messages, BOT_PREFIXES)


def join_texts(texts: Column) -> Column:
    return strip(F.regexp_replace(F.array_join(texts, " "), " {2,}", " "))


def infer_question(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The label of the first rule the reply matches; NULL for none or a reply below 10 characters."""


    def first_match(text: Column) -> Column:
        chain = F.when(text.isNull() | (F.length(strip(text)) < 10), F.lit(None).cast("string"))
        for pattern, label in rules:
            chain = chain.when(text.rlike("(?U)" + pattern), F.lit(label))
        return chain

    return let(F.lower(c), first_match)


# A character no text holds (private use); it is no letter, digit or blank.
_FILLER = "\ue000"


def rule_number(text: Column, patterns: Sequence[str]) -> Column:
    """The number from 1 of the first pattern that is found in the text, 0 for none: one expression for any number of patterns.

    The text gets a filler in front. The alternatives are tried in order; each looks for its pattern behind the filler and
    then takes as many filler characters as its number, so the match's length names the rule. A pattern may begin
    with `^`; other signs for the text's beginning are not known in it.
    """
    if not patterns:
        return F.lit(0)
    n = len(patterns)

    def alternative(i: int, pattern: str) -> str:
        found = f"(?<={_FILLER})(?:{pattern[1:]})" if pattern.startswith("^") else f"(?s:.*?)(?:{pattern})"
        return f"(?={_FILLER}{{{n}}}{found}){_FILLER}{{{i}}}"

    together = "|".join(alternative(i, p) for i, p in enumerate(patterns, 1))
    padded = F.concat(F.lit(_FILLER * n), F.replace(text, F.lit(_FILLER), F.lit("")))
    return F.length(F.regexp_extract(padded, f"(?U)\\A(?:{together})", 0))


def infer_question_of_many(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """As `infer_question`, for rules that come as a table: the plan does not grow with their number."""
    labels = F.array(*[F.lit(label) for _, label in rules]) if rules else F.array(F.lit(None).cast("string"))

    def first_match(text: Column) -> Column:
        found = let(rule_number(text, [p for p, _ in rules]), lambda n: F.when(n > 0, F.get(labels, n - 1)))
        return F.when(F.length(strip(text)) >= 10, found)

    return let(F.lower(c), first_match)


def _questions_of_dialogue(dialogue: Column) -> Column:
    segments = F.transform(F.split(dialogue, r" \| "), strip)
    asked = F.filter(segments, lambda s: F.lower(s).startswith("user:"))
    return F.transform(asked, lambda s: strip(F.substring(s, 6, 2_147_483_647)))


def questions_text(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The user's questions in a rendered transcript, each once, in order, joined by ` | `."""
    none = F.array().cast("array<string>")

    def found(s: Column) -> Column:
        return (
            F.when(is_blank(s), none)
            .when(
                s.contains(DIALOGUE_SEPARATOR),
                F.flatten(F.transform(F.split(s, r" \|\| "), lambda d: _questions_of_dialogue(strip(d)))),
            )
            .when(s.contains(MESSAGE_SEPARATOR), _questions_of_dialogue(s))
            .when(s.rlike("^(?i:user:)"), F.array(strip(F.substring(s, 6, 2_147_483_647))))
            .when(s.rlike("^(?i:bot:)"), F.array_compact(F.array(infer_question(s, rules))))
            .otherwise(
                F.transform(F.regexp_extract_all(s, F.lit(r"(?i)user:\s*([^|]+?)(?:\s*\|\s*bot:|$)"), F.lit(1)), strip)
            )
        )

    return F.array_join(F.array_distinct(F.filter(let(strip(c), found), lambda q: q != "")), MESSAGE_SEPARATOR)


def count_turns_text(c: Column) -> Column:
    """The larger of the raw counts of `bot` and `user` in the text, at least 1."""
    return let(F.coalesce(c, F.lit("")), lambda t: F.greatest(count_of(t, "bot"), count_of(t, "user"), F.lit(1)))


def count_questions_text(c: Column) -> Column:
    return let(F.lower(F.coalesce(c, F.lit(""))), lambda t: count_of(t, "user:"))
