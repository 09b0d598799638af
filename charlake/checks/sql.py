"""The same derived tables as SQL, to put before a checking query."""

from __future__ import annotations

from charlake.checks.fixture import CFG, CREATED, FEEDBACK_VALUES, K, KIND, PROFILE, TURNS_PER_CELL

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def blank(x: str) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN ('', 'nan', 'none', 'null'))"


def clean(x: str) -> str:
    return f"CASE WHEN {blank(x)} THEN '' ELSE {strip(x)} END"


def single_line(x: str, chars: int | None = None) -> str:
    flat = rf"trim(regexp_replace(coalesce({x}, ''), '[\p{{C}}\p{{Z}}]+', ' ', 'g'))"
    return flat if chars is None else f"CASE WHEN length({flat}) > {chars} THEN left({flat}, {chars}) || '...' ELSE {flat} END"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def tokens(x: str) -> str:
    """The token estimate, operations in the same order."""
    n = f"length({x})"

    def share(rest: str) -> str:
        return f"(({n} - length({rest})) / {n})"

    spaces = share(f"replace({x}, ' ', '')")
    punctuation = share(rf"""regexp_replace({x}, '[.,;:!?¡¿()\[\]{{}}"''\-]', '', 'g')""")
    special = share(rf"regexp_replace({x}, '[\p{{Nd}}²³¹⁰⁴-⁹₀-₉@#$%&*+=/<>]', '', 'g')")
    factor = (
        f"(1.0::DOUBLE + {spaces} * 0.2::DOUBLE + {punctuation} * 0.15::DOUBLE + {special} * 0.1::DOUBLE)"
    )
    return (
        f"CASE WHEN {x} IS NULL OR {n} = 0 THEN 0 "
        f"ELSE greatest(1, CAST(floor({n} / 3.8::DOUBLE * {factor}) AS INTEGER)) END"
    )


EV = f"ev AS (SELECT event_id, user_id, ts, event_type, value, {K} AS k FROM events)"

SEG = (
    f"seg AS (SELECT conv_id, CAST((pos - 1) // {TURNS_PER_CELL} AS INTEGER) AS segmento, pos, turn, role, text FROM ("
    "SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations))"
)

# Messages with canonical role and one-line text.
MSG = (
    "msg AS (SELECT conv_id, segmento, pos, turn, role, text, "
    f"CASE WHEN lower({strip('role')}) IN ('user', 'usuario') THEN 'user' "
    f"WHEN lower({strip('role')}) IN ('bot', 'assistant') THEN 'bot' ELSE lower({strip('role')}) END AS who, "
    rf"trim(regexp_replace({strip('text')}, '\n\n|\n', ' ', 'g')) AS txt FROM seg)"
)

# One row per conversation item: transcript, questions, counts.
TALK = (
    "talk AS (SELECT conv_id, segmento, "
    "string_agg(who || ': ' || txt, ' | ' ORDER BY pos) AS transcript, "
    "CAST(count(*) FILTER (WHERE who = 'user') AS INTEGER) AS n_user, "
    "CAST(count(*) FILTER (WHERE who = 'bot') AS INTEGER) AS n_bot "
    "FROM msg GROUP BY conv_id, segmento)"
)

ASKED = (
    "asked AS (SELECT conv_id, segmento, string_agg(txt, ' | ' ORDER BY pos) AS preguntas, "
    "CAST(count(*) AS INTEGER) AS n FROM ("
    "SELECT conv_id, segmento, txt, pos FROM ("
    "SELECT *, row_number() OVER (PARTITION BY conv_id, segmento, txt ORDER BY pos) AS nth "
    "FROM msg WHERE who = 'user' AND txt <> '') WHERE nth = 1) GROUP BY conv_id, segmento)"
)

# The last user message and its reply of each conversation item, as they are.
EXCHANGE = (
    "last_user AS (SELECT conv_id, segmento, max(pos) AS t, arg_max(text, pos) AS u FROM seg "
    "WHERE lower(role) = 'user' GROUP BY ALL), "
    "replied AS (SELECT s.conv_id, s.segmento, "
    "arg_min(s.text, s.pos) FILTER (WHERE s.pos > l.t) AS nxt, arg_max(s.text, s.pos) AS lst "
    "FROM seg s LEFT JOIN last_user l ON l.conv_id = s.conv_id AND l.segmento = s.segmento "
    "WHERE lower(s.role) IN ('bot', 'assistant', 'system') GROUP BY ALL), "
    "exchange AS (SELECT b.conv_id, b.segmento, coalesce(l.u, '') AS pregunta, coalesce(r.nxt, r.lst, '') AS respuesta "
    "FROM (SELECT DISTINCT conv_id, segmento FROM seg) b "
    "LEFT JOIN last_user l ON l.conv_id = b.conv_id AND l.segmento = b.segmento "
    "LEFT JOIN replied r ON r.conv_id = b.conv_id AND r.segmento = b.segmento)"
)

# The same for whole conversations, whatever their length.
TURN = (
    "turn AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos, "
    f"CASE WHEN lower({strip('role')}) IN ('user', 'usuario') THEN 'user' "
    f"WHEN lower({strip('role')}) IN ('bot', 'assistant') THEN 'bot' ELSE lower({strip('role')}) END AS who, "
    rf"trim(regexp_replace({strip('text')}, '\n\n|\n', ' ', 'g')) AS txt FROM conversations)"
)

QUESTION = (
    "question AS (SELECT conv_id, txt, min(pos) AS pos FROM turn WHERE who = 'user' AND txt <> '' GROUP BY conv_id, txt), "
    "per_conv AS (SELECT c.conv_id, count(q.txt) AS n FROM (SELECT DISTINCT conv_id FROM turn) c LEFT JOIN question q ON q.conv_id = c.conv_id GROUP BY c.conv_id)"
)

LAST = (
    "asked_last AS (SELECT conv_id, max(pos) AS t, arg_max(text, pos) AS u FROM turn WHERE lower(role) = 'user' GROUP BY conv_id), "
    "answered AS (SELECT s.conv_id, arg_min(s.text, s.pos) FILTER (WHERE s.pos > l.t) AS nxt, arg_max(s.text, s.pos) AS lst "
    "FROM turn s LEFT JOIN asked_last l ON l.conv_id = s.conv_id WHERE lower(s.role) IN ('bot', 'assistant', 'system') GROUP BY s.conv_id), "
    "whole AS (SELECT b.conv_id, coalesce(l.u, '') AS pregunta, coalesce(r.nxt, r.lst, '') AS respuesta FROM (SELECT DISTINCT conv_id FROM turn) b "
    "LEFT JOIN asked_last l ON l.conv_id = b.conv_id LEFT JOIN answered r ON r.conv_id = b.conv_id)"
)

_PROFILE = ", ".join(f"{sql} AS {name}" for name, sql in PROFILE.items())
_FEEDBACK = ", ".join(
    f"CASE WHEN kind = 'FEEDBACK' THEN ({sql}) END AS fb_{name}" for name, sql in FEEDBACK_VALUES.items()
)
_CONV_TS = "ts + to_days(CAST(conv_id % 29 AS INTEGER)) + to_microseconds(segmento)"

ITEMS = (
    f"keyed AS (SELECT *, {KIND} AS kind FROM ev), "
    f"items AS (SELECT CAST(user_id AS VARCHAR) AS usuario_id, kind || '#' || {iso('ts')} AS sk, kind, ts AS item_ts, "
    f"{CREATED} AS created_at, {_PROFILE}, {_FEEDBACK}, CAST(NULL AS BIGINT) AS conv_id, CAST(NULL AS INTEGER) AS segmento FROM keyed "
    f"UNION ALL SELECT CAST(user_id AS VARCHAR), 'CONVERSATION#' || {iso(_CONV_TS)}, 'CONVERSATION', {_CONV_TS}, "
    f"CASE WHEN k >= 5 THEN {_CONV_TS} END, {_PROFILE}, NULL, NULL, NULL, conv_id, segmento "
    "FROM (SELECT DISTINCT conv_id, segmento FROM seg) s LEFT JOIN ev ON ev.event_id = s.conv_id)"
)


_BEGAN = "ts + to_days(CAST(conv_id % 29 AS INTEGER))"

# The same with one item per conversation, whatever its length.
WHOLE_ITEMS = (
    f"keyed AS (SELECT *, {KIND} AS kind FROM ev), "
    f"items AS (SELECT CAST(user_id AS VARCHAR) AS usuario_id, kind || '#' || {iso('ts')} AS sk, kind, ts AS item_ts, "
    f"{CREATED} AS created_at, {_PROFILE}, {_FEEDBACK}, CAST(NULL AS BIGINT) AS conv_id FROM keyed "
    f"UNION ALL SELECT CAST(user_id AS VARCHAR), 'CONVERSATION#' || {iso(_BEGAN)}, 'CONVERSATION', {_BEGAN}, "
    f"CASE WHEN k >= 5 THEN {_BEGAN} END, {_PROFILE}, NULL, NULL, NULL, conv_id "
    "FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN ev ON ev.event_id = s.conv_id)"
)


def count(x: str, word: str) -> str:
    return f"((length({x}) - length(replace({x}, '{word}', ''))) // {len(word)})"


# Turns by role of whole conversations, and how often words stand in their text.
TALLY = (
    "tally AS (SELECT conv_id, count(*) FILTER (WHERE who = 'user') AS n_user, count(*) FILTER (WHERE who = 'bot') AS n_bot, "
    + ", ".join(f"sum({count(line, word)}) AS {name}" for name, line, word in (
        ("dice_bot", "who || ': ' || txt", "bot"), ("dice_usuario", "who || ': ' || txt", "user"), ("dice_preguntas", "lower(who || ': ' || txt)", "user:"),
    ))
    + " FROM turn GROUP BY conv_id)"
)

# Of each cell of text the questions that were asked first there.
ASKED_FIRST = (
    "asked AS (SELECT conv_id, segmento, string_agg(txt, ' | ' ORDER BY pos) AS preguntas FROM ("
    "SELECT conv_id, segmento, txt, pos, row_number() OVER (PARTITION BY conv_id, txt ORDER BY pos) AS nth "
    "FROM msg WHERE who = 'user' AND txt <> '') WHERE nth = 1 GROUP BY conv_id, segmento)"
)


def matches(x: str, words: tuple[str, ...]) -> str:
    return f"coalesce(regexp_matches({x}, '(?i)({'|'.join(words)})'), false)"


_CITY = f"CASE WHEN contains(c0, '(') AND contains(c0, ')') THEN {strip('split_part(c0, chr(40), 1)')} ELSE c0 END"
_OTHERS = ("gerencia", "oficinas_asesoras", "subgerencia", "nivel_directivo")

# Items with cleaned profile that pass the user table's filters; feedback passes by itself.
KEPT = (
    "cleaned AS (SELECT usuario_id, sk, kind, item_ts, kind = 'FEEDBACK' AS es_feedback, CAST(created_at AS DATE) AS fecha, "
    "fb_type, fb_comment, fb_option, conv_id, "
    f"CASE WHEN {blank('nombre')} THEN '{CFG.anonymous_label}' ELSE {strip('nombre')} END AS nombre, "
    f"{clean('ciudad')} AS c0, {', '.join(f'{clean(f)} AS {f}' for f in _OTHERS)} "
    "FROM items WHERE kind <> 'REGISTER' AND usuario_id IS NOT NULL), "
    f"placed AS (SELECT * EXCLUDE (c0), {_CITY} AS c1 FROM cleaned), "
    "kept AS (SELECT * EXCLUDE (c1), "
    f"CASE WHEN concat(c1, {', '.join(_OTHERS)}) = '' THEN '{CFG.default_city}' ELSE c1 END AS ciudad "
    "FROM placed WHERE es_feedback OR ("
    f"NOT {matches('c1', CFG.excluded_city_words)} AND NOT {matches('nombre', CFG.excluded_name_words)} "
    f"AND (fecha IS NULL OR fecha BETWEEN DATE '{CFG.first_day}' AND DATE '{CFG.last_day}')))"
)


def with_(*tables: str, select: str) -> str:
    return f"WITH {', '.join(tables)} {select}"
