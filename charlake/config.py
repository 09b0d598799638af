"""Fixed values and the settings a caller may change."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

# --- Fixed values -----------------------------------------------------------
# They decide the results, so they are stated here as they are.

USER_TABLE_COLUMNS = (
    "usuario_id", "nombre", "gerencia", "ciudad", "oficinas_asesoras", "subgerencia", "nivel_directivo",
    "fecha_primera_conversacion", "numero_conversaciones", "conversacion_completa", "feedback_total",
    "numero_feedback", "pregunta_conversacion", "numero_preguntas", "feedback", "respuesta_feedback",
)

FEEDBACK_TABLE_COLUMNS = (
    "usuario_id", "nombre", "fecha", "mensaje_usuario", "mensaje_bot", "feedback", "comentario",
    "opcion_respuesta", "ciudad", "gerencia", "oficinas_asesoras", "subgerencia", "nivel_directivo",
)

PROFILE_FIELDS = ("nombre", "ciudad", "gerencia", "oficinas_asesoras", "subgerencia", "nivel_directivo")

# Words that mean "no value" in the source texts.
BLANK_WORDS = ("", "nan", "none", "null")

# Characters a text is trimmed of: everything Unicode calls white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

MESSAGE_SEPARATOR = " | "
DIALOGUE_SEPARATOR = " || "

USER_PREFIXES = ("user:", "usuario:", "usr:", "u:")
BOT_PREFIXES = ("bot:", "assistant:", "asistente:", "b:")

# Token estimate: characters per token, and what spaces, punctuation and special characters add.
CHARS_PER_TOKEN = 3.8
SPACE_WEIGHT = 0.2
PUNCTUATION_WEIGHT = 0.15
SPECIAL_WEIGHT = 0.1
PUNCTUATION_CLASS = r"""[.,;:!?¡¿()\[\]{}"'\-]"""
SPECIAL_CLASS = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉@#$%&*+=/<>]"

# Rules that guess the question from a reply that has no question: first match wins. `{office}` is a setting.
QUESTION_RULES = (
    (r"el trámite de ([\w\s]+?) (?:es|se realiza|consiste)", "¿Cómo hago el trámite de ?"),
    (r"el certificado ([\w\s]+?) (?:es|incluye|contiene)", "¿Qué es el certificado ?"),
    (r"el chip", "¿Qué es el CHIP?"),
    (r"(?:cuesta|valor|costo)", "¿Cuál es el costo del trámite?"),
    (r"(?:documentos? necesarios?|requisitos?)", "¿Qué documentos necesito?"),
    (r"(?:tiempo de respuesta|duración|días hábiles)", "¿Cuánto tiempo tarda el trámite?"),
    (r"(?:ubicad|direcci[oó]n|sede)", "¿Dónde queda ubicado {office}?"),
    (r"horario.*atenci[oó]n", "¿Cuál es el horario de atención?"),
)

# Cities left out of the user table. Company and person names are the caller's to add.
EXCLUDED_CITY_WORDS = (
    "mexico", "medell", "cali", "barranquilla", "cartagena", "potosí", "valle", "antioquia",
)

USER_TABLE_TYPES = {
    "usuario_id": "string", "nombre": "string", "gerencia": "string", "ciudad": "string",
    "oficinas_asesoras": "string", "subgerencia": "string", "nivel_directivo": "string",
    "fecha_primera_conversacion": "date", "numero_conversaciones": "integer",
    "conversacion_completa": "string", "feedback_total": "string", "numero_feedback": "integer",
    "pregunta_conversacion": "string", "numero_preguntas": "number",
    "feedback": "feedback", "respuesta_feedback": "answer", "parte": "number",
}

# Question rules that may come as a table.
MAX_RULES = 10_000

FEEDBACK_CLASSES = ("like", "dislike", "mixed")

# --- Settings ---------------------------------------------------------------


@dataclass(frozen=True)
class ChatConfig:
    """What a deployment decides. The defaults give the standard results."""

    role_words: Mapping[str, str] = field(
        default_factory=lambda: {"user": "user", "usuario": "user", "bot": "bot", "assistant": "bot"}
    )
    # Roles that count as a reply when a feedback is matched to an exchange.
    reply_roles: tuple[str, ...] = ("bot", "assistant", "system")
    user_roles: tuple[str, ...] = ("user",)
    question_rules: tuple[tuple[str, str], ...] = QUESTION_RULES
    office: str = "la oficina"

    anonymous_label: str = "Usuario Anónimo"
    default_city: str = "Bogotá"
    no_date_label: str = "Sin fecha"

    excluded_city_words: tuple[str, ...] = EXCLUDED_CITY_WORDS
    excluded_name_words: tuple[str, ...] = ()
    excluded_names: tuple[str, ...] = ()

    first_day: date | None = date(2025, 8, 4)
    last_day: date | None = None  # None: the day the query runs

    max_message_chars: int | None = None  # whole messages
    zero_as_null: bool = True

    # A cell of text holds at most this many items, and these bytes and one item more; further ones go on in the user's next row.
    items_per_row: int = 500
    answers_per_row: int = 10_000
    bytes_per_row: int = 1 << 27
    # A user with more rows than this is matched in time slices, not in one task.
    rows_per_window: int = 1_000_000

    def rules(self) -> list[tuple[str, str]]:
        """The question rules with the office's name filled in."""
        return [(pattern, label.replace("{office}", self.office)) for pattern, label in self.question_rules]
