"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust their score.

Base kinds (email, ip, card, phone) are always kept once their pattern and digit rules hold. Further
kinds (iban, ssn, local_phone) are kept from a score of `KEEP` on, and only where they touch no base
span: a passed mod-97 check is enough for an account number, the other two need a word such as "ssn"
or "phone" nearby. Everything is a column expression; nothing is shuffled.

A span is (kind, start, end, value, score): code points, end exclusive. NULL text: no spans, as for an
empty text. NULL doc_id and equal rows are kept as they are; an empty table gives an empty result. A
column of the input named `_pii` is not allowed for `with_pii`, others do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charlake.llm.common import unused
from charlake.llm.registry import query, table

# Pattern for each kind, as the engine's expressions (possessive, so no text makes them slow)
# and as plain expressions for the checking SQL. Both find the same spans.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z][A-Z][0-9][0-9](?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local_phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
}
PLAIN = PATTERNS | {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[ -]?[0-9])+",
}
# A text without this has no span of the kind; it is cheaper to look for.
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]{3}-[0-9]{2}-", "local_phone": r"[0-9]{3}[ .-][0-9]{4}",
}
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn", "local_phone")
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3}
NEARBY = {
    "email": "mail|contact|correo|courriel|kontakt",
    "ip": "address|server|host|login",
    "card": "card|credit|visa|karte|carte|tarjeta",
    "phone": "phone|call|mobile|tel|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social security",
    "local_phone": "phone|call|mobile|tel|fax",
}
NEAR_BEFORE, NEAR_AFTER, NEAR_SCORE, KEEP = 40, 20, 0.2, 0.5
PART_TO_255 = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number's letters and digits leave 1 on division by 97, its first four moved to the end."""
    bare = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: str, text: Column, span: Column) -> Column:
    value = span["value"]
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(PART_TO_255)
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.when(F.length(F.regexp_replace(value, " ", "")).between(15, 34), mod97(value)).otherwise(F.lit(False))
    if kind in ("ssn", "local_phone"):  # not a part of a longer number
        before = F.when(span["start"] > 0, F.substring(text, span["start"], F.lit(1))).otherwise(F.lit(""))
        return ~before.rlike("[0-9+.-]") & ~F.substring(text, span["end"] + 1, F.lit(1)).rlike("[0-9-]")
    return F.lit(True)


def _score(kind: str, text: Column, span: Column) -> Column:
    left = F.greatest(span["start"] - NEAR_BEFORE, F.lit(0))
    before = F.substring(text, left + 1, span["start"] - left)
    after = F.substring(text, span["end"] + 1, F.lit(NEAR_AFTER))
    near = F.lower(F.concat(before, F.lit(" "), after)).rlike(NEARBY[kind])
    return F.lit(SCORES[kind]) + F.when(near, NEAR_SCORE).otherwise(0.0)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"
_PLACED = "array<struct<start:bigint,end:bigint,value:string>>"


def spans_of(kind: str, text: Column) -> Column:
    """The confirmed spans of one kind, in order.

    The pattern's matches and the gaps between them alternate, so a running sum of their lengths is
    each match's place. They are bound to a one-element array, which works them out once.
    """
    parts = F.array(F.struct(F.split(text, PATTERNS[kind], -1).alias("gaps"), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0).alias("hits")))

    def place(p: Column) -> Column:
        def step(at: Column, i: Column) -> Column:
            start = at["pos"] + F.length(F.get(p["gaps"], i))
            value = F.get(p["hits"], i)
            end = start + F.length(value)
            span = F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))
            return F.struct(end.alias("pos"), F.concat(at["out"], span).alias("out"))

        none = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(_PLACED).alias("out"))
        order = F.when(F.size(p["hits"]) > 0, F.sequence(F.lit(0), F.size(p["hits"]) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(order, none, step, lambda at: at["out"])

    placed = F.filter(F.get(F.transform(parts, place), F.lit(0)), lambda s: _confirmed(kind, text, s))
    spans = F.transform(
        placed,
        lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _score(kind, text, s).alias("score")),
    ).cast(_SPANS)
    hinted = text.contains(HINTS[kind]) if kind == "email" else text.rlike(HINTS[kind])
    return F.when(hinted, spans).otherwise(F.array().cast(_SPANS))


def with_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `_pii`: base spans, then further ones, each by kind and start."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*[spans_of(k, body) for k in BASE])
    more = F.concat(*[spans_of(k, body) for k in MORE])
    (further,) = unused(docs, "_more")
    free = F.filter(
        F.col(further),
        lambda m: (m["score"] >= KEEP) & ~F.exists(F.col("_pii"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
    )
    found = docs.withColumns({"_pii": base, further: F.filter(more, lambda s: s["score"] >= KEEP)})
    return found.withColumn("_pii", F.when(F.size(further) == 0, F.col("_pii")).otherwise(F.concat("_pii", free))).drop(further)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each span's characters replaced by <kind>; of overlapping spans the first stands."""
    order = F.array_sort(F.transform("_pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("out"))

    def step(at: Column, s: Column) -> Column:
        kept = F.concat(at["out"], F.substring(F.col(text), at["pos"] + 1, s["start"] - at["pos"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.when(s["start"] < at["pos"], at).otherwise(F.struct(s["end"].alias("pos"), kept.alias("out")))

    def end(at: Column) -> Column:
        return F.concat(at["out"], F.substring(F.col(text), at["pos"] + 1, F.length(text)))

    return with_pii(docs, text).withColumn(text, F.aggregate(order, start, step, end)).drop("_pii")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql() -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    hits = " UNION ALL ".join(
        f"SELECT doc_id, text, {lit(k)} AS kind, {i} AS k, unnest(range(len(regexp_extract_all(text, {lit(PLAIN[k])})))) AS i, "
        f"unnest(regexp_extract_all(text, {lit(PLAIN[k])})) AS value, unnest(string_split_regex(text, {lit(PLAIN[k])})[:-2]) AS gap "
        f"FROM d WHERE regexp_matches(text, {lit(PLAIN[k])})" for i, k in enumerate(BASE + MORE)
    )
    near = "CASE kind " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in NEARBY.items()) + " END"
    score = "CASE kind " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in SCORES.items()) + " END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS ({hits}),
p AS (
  SELECT *, (sum(length(gap)) OVER w + coalesce(sum(length(value)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s
  FROM h WINDOW w AS (PARTITION BY doc_id, k ORDER BY i)
),
q AS (SELECT *, s + length(value) AS e, {digits} AS digits, replace(value, ' ', '') AS bare FROM p),
c AS (
  SELECT * FROM q WHERE CASE kind
    WHEN 'ip' THEN regexp_matches(value, {lit(PART_TO_255)})
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)), lambda j:
      CASE WHEN j % 2 = 0 THEN digits[length(digits) - j]::INT WHEN digits[length(digits) - j]::INT > 4 THEN digits[length(digits) - j]::INT * 2 - 9 ELSE digits[length(digits) - j]::INT * 2 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(bare) BETWEEN 15 AND 34 AND list_reduce(list_transform(range(1, length(bare) + 1), lambda j: ascii((bare[5:] || bare[:4])[j])),
      lambda r, a: CASE WHEN a >= 65 THEN r * 100 + a - 55 ELSE r * 10 + a - 48 END % 97, 0) = 1
    WHEN 'email' THEN true
    ELSE NOT regexp_matches(CASE WHEN s > 0 THEN text[s] ELSE '' END, '[0-9+.-]') AND NOT regexp_matches(text[e + 1], '[0-9-]') END
),
r AS (
  SELECT *, {score} + CASE WHEN regexp_matches(lower(substring(text, greatest(s - {NEAR_BEFORE}, 0) + 1, s - greatest(s - {NEAR_BEFORE}, 0)) || ' ' || substring(text, e + 1, {NEAR_AFTER})), {near}) THEN {NEAR_SCORE} ELSE 0 END AS score
  FROM c
),
a AS (
  SELECT *, kind || ':' || s || ':' || e AS span FROM r WHERE k < 4 OR (score >= {KEEP} AND NOT EXISTS (
    SELECT 1 FROM r b WHERE b.doc_id = r.doc_id AND b.k < 4 AND b.s < r.e AND r.s < b.e))
),
g AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
    string_agg(span, ',' ORDER BY k, s) FILTER (k < 4) AS base, string_agg(span, ',' ORDER BY k, s) AS spans, count(*) FILTER (k > 3) AS n_more,
    round(max(score), 3) AS top_score
  FROM a GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_more, 0) AS n_more, coalesce(top_score, 0.0)::DOUBLE AS top_score
FROM d LEFT JOIN g USING (doc_id)
"""


@query("op1_pii", _sql())
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def pii_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, spans found per base kind, a digest of the base spans, all spans, further spans and the highest score."""
    found = with_pii(docs.select("doc_id", text), text).select("doc_id", "_pii")
    base = F.filter("_pii", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("_pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("_pii")).alias("spans"),
        (F.size("_pii") - F.size(base)).cast("long").alias("n_more"),
        F.round(F.coalesce(F.array_max(F.transform("_pii", lambda s: s["score"])), F.lit(0.0)), 3).alias("top_score"),
    )
