"""The curated tables under the names SQL users query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

from charlake.sources.evolution import read_widened, wider

USER_VIEW = "chat_users"
FEEDBACK_VIEW = "chat_feedback"


def register_views(users: DataFrame | None = None, feedback: DataFrame | None = None) -> None:
    if users is not None:
        users.createOrReplaceTempView(USER_VIEW)
    if feedback is not None:
        feedback.createOrReplaceTempView(FEEDBACK_VIEW)


def register_parquet(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A view over a Parquet folder; files of older schemas are merged in, missing columns are NULL, changed types widened."""
    table, _ = read_widened(spark, path)
    table.createOrReplaceTempView(name)
    return table


def sync_table(spark: SparkSession, name: str, path: str) -> dict[str, list[str]]:
    """An external catalogue table over a Parquet folder, brought up to date in place: what was added, changed or deleted.

    New columns are added to the table, and a column of a wider type gets it, which the Parquet reader then gives for older files as
    well. A column that no file has any more stays, with NULLs, and is reported as deleted. One whose files have types without a
    common one is reported as clashing; a new one is left out, a known one keeps the table's type: read those by `register_parquet`.
    """
    _, evolution = read_widened(spark, path)
    found = {f.name: f.dataType for f in evolution.schema if f.name not in evolution.clashes}
    known = {f.name: f.dataType for f in spark.table(name).schema} if spark.catalog.tableExists(name) else {}
    kept = {n: found[n] if n in found and wider(t, found[n]) == found[n] else t for n, t in known.items()}
    changed = [n for n, t in kept.items() if t != known[n]]
    added = [n for n in found if n not in known]
    if not known or changed:
        # Another type needs a new definition; the table is external, so its files stay as they are.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _create(spark, name, path, kept | {n: found[n] for n in added})
    elif added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns({n: found[n] for n in added})})")
    spark.sql(f"REFRESH TABLE {name}")
    return {
        "added": added, "changed": changed, "deleted": [n for n in known if n not in evolution.schema.fieldNames()],
        "clashing": list(evolution.clashes),
    }


def _columns(types: dict[str, DataType]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` {t.simpleString()}" for n, t in types.items())


def _create(spark: SparkSession, name: str, path: str, types: dict[str, DataType]) -> None:
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({_columns(types)}) USING parquet LOCATION '{place}'")
