"""Counts over curated tables, each in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from charlake.functions.text import is_blank


def _filled(name: str) -> Column:
    return F.count_if(~is_blank(F.col(name)))


def run_totals(users: DataFrame, anonymous_label: str) -> DataFrame:
    """Users, conversations and coverage, from `user_values` or from the user table, where a user's rows repeat the values."""
    if "con_preguntas" not in users.columns:
        users = users.groupBy("usuario_id").agg(
            F.max("nombre").alias("nombre"), F.max("numero_conversaciones").alias("numero_conversaciones"), F.max("feedback").alias("feedback"),
            F.bool_or(~is_blank(F.col("pregunta_conversacion"))).alias("con_preguntas"),
        )
    return users.agg(
        F.count(F.lit(1)).alias("usuarios_procesados"),
        F.coalesce(F.sum("numero_conversaciones"), F.lit(0)).cast("bigint").alias("total_conversaciones"),
        _filled("feedback").alias("usuarios_con_feedback"),
        F.count_if("con_preguntas").alias("usuarios_con_preguntas"),
        F.count_if(F.col("nombre") != anonymous_label).alias("nombres_reales"),
    )


def match_stats(seen: DataFrame) -> DataFrame:
    """Feedback by `matched`: true, false, or NULL for feedback that could not be matched at all."""
    return seen.agg(
        F.count(F.lit(1)).alias("feedback"), F.count_if("matched").alias("con_conversacion"),
        F.count_if(~F.col("matched")).alias("sin_conversacion"), F.count_if(F.col("matched").isNull()).alias("descartados"),
    )


def question_coverage(per_conversation: DataFrame) -> DataFrame:
    """Conversations, those with a question and those with several, from `n`, the questions of each."""
    return per_conversation.agg(
        F.count(F.lit(1)).alias("conversaciones"), F.count_if(F.col("n") > 0).alias("con_pregunta"), F.count_if(F.col("n") > 1).alias("con_varias")
    )


def feedback_totals(feedback: DataFrame) -> DataFrame:
    return feedback.agg(
        F.count(F.lit(1)).alias("total_feedbacks"),
        F.count_if(F.col("feedback") == "like").alias("likes"),
        F.count_if(F.col("feedback") == "dislike").alias("dislikes"),
        F.count_if(F.col("comentario") != "").alias("with_comments"),
        F.count_if(F.col("mensaje_usuario") != "").alias("with_user_messages"),
        F.count_if(F.col("mensaje_bot") != "").alias("with_bot_messages"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: values and NULLs. One aggregation over all columns, then unpivoted."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"c{i}").alias("validos")) for i, c in enumerate(names)]))
    return counts.select("_rows", pairs.alias("p")).select(
        F.col("p.columna").alias("columna"), F.col("p.validos").alias("validos"),
        (F.col("_rows") - F.col("p.validos")).alias("nulos"),
    )


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each further condition, in one pass."""
    kept: Column = F.lit(True)
    counts = [F.count(F.lit(1)).alias("s0")]
    for i, condition in enumerate(steps.values(), 1):
        kept = kept & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(kept).alias(f"s{i}"))
    names = ["inicial", *steps]
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("paso"), F.lit(name).alias("nombre"), F.col(f"s{i}").alias("filas"))
        for i, name in enumerate(names)
    ]))
    return df.agg(*counts).select(rows.alias("r")).select("r.*")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here as a side effect of the job that reads them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("filas")), seen


def sample_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows by a key, for a report."""
    return df.orderBy(order).limit(n)
