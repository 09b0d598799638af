"""Question rules kept as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from charlake.config import MAX_RULES
from charlake.functions.transcripts import infer_question_of_many


def rules_of(table: DataFrame) -> list[tuple[str, str]]:
    """(pattern, question) by `prioridad`, then pattern. A table of rules is read by the driver, so its length is checked."""
    rows = table.where(F.col("patron").isNotNull()).select("prioridad", "patron", "pregunta").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} question rules")
    return [(r["patron"], r["pregunta"]) for r in sorted(rows, key=lambda r: (r["prioridad"] is None, r["prioridad"] or 0, r["patron"]))]


def with_inferred_question(replies: DataFrame, text: str, rules: DataFrame, name: str = "pregunta") -> DataFrame:
    """Replies with the question of the first rule by priority that their text matches, NULL for none."""
    inferred: Column = infer_question_of_many(F.col(text), rules_of(rules))
    return replies.withColumn(name, inferred)
