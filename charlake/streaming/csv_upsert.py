"""Deliveries of the user table to one state per user, however often a user is delivered.

A delivery is a folder of CSV files below the watched folder; of two deliveries the one whose folder's name
sorts later is newer, whenever its files arrive. A newer delivery replaces all rows of the users in it. Each batch appends its
typed rows to a folder of its own, `lote=<batch>`, which a repeated batch overwrites, so a replay changes nothing. Readers
take each user's newest delivery; nothing that was written before is rewritten when a batch comes in.

Rows that cannot be typed go to a quarantine with their reason, and each batch leaves its counts.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from charlake.config import ChatConfig
from charlake.sources.quarantine import checked_schema, counts, csv_options, typed_and_bad, with_reason

DELIVERY, BATCH = "entrega", "lote"
TYPED, BAD, COUNTS = "usuarios", "cuarentena", "conteos"


def delivery() -> Column:
    """The folder a file lies in."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


def start_csv_upsert(
    spark: SparkSession, csv_dir: str, out_dir: str, checkpoint_dir: str, cfg: ChatConfig = ChatConfig(), files_per_batch: int = 1_000
) -> StreamingQuery:
    """Take in all files there are and stop. A later run with the same checkpoint takes only new ones."""
    arrived = (
        spark.readStream.schema(checked_schema())
        .options(**csv_options(), recursiveFileLookup="true", maxFilesPerTrigger=files_per_batch)
        .csv(csv_dir)
    )
    rows = with_reason(arrived.withColumn(DELIVERY, delivery()), cfg)

    def take(batch: DataFrame, number: int) -> None:
        # Both sinks read the parsed rows; a lost executor parses its files again.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        typed, bad = typed_and_bad(kept, cfg)
        for part, name in ((typed, TYPED), (bad, BAD), (counts(kept), COUNTS)):
            part.write.mode("overwrite").parquet(f"{out_dir}/{name}/{BATCH}={number}")
        kept.unpersist()

    return (
        rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    )


def newest(log: DataFrame) -> DataFrame:
    """Each user's rows of their newest delivery; of a part that is in it twice, the row of the latest batch.

    The newest delivery is a partial maximum by user, so a user delivered every day costs a task one row.
    """
    last = log.groupBy("usuario_id").agg(F.max(DELIVERY).alias(DELIVERY))
    rows = log.join(last, ["usuario_id", DELIVERY], "left_semi")
    values = [c for c in rows.columns if c not in (DELIVERY, BATCH)]
    order = [F.desc(BATCH), *[F.col(f"`{c}`") for c in values]]
    first = F.row_number().over(Window.partitionBy("usuario_id", "parte").orderBy(*order))
    return rows.withColumn("_nth", first).where("_nth = 1").drop("_nth")


def read_current(spark: SparkSession, out_dir: str, base: str | None = None) -> DataFrame:
    """The user table as the deliveries so far leave it. `base` is a state written earlier by `write_base`."""
    log = spark.read.parquet(f"{out_dir}/{TYPED}")
    return newest(log if base is None else log.unionByName(spark.read.parquet(base)))


def write_base(spark: SparkSession, out_dir: str, path: str, base: str | None = None) -> None:
    """Write the current state to a new folder, from which later reads may start with an empty log."""
    read_current(spark, out_dir, base).write.parquet(path)


def read_quarantine(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/{BAD}")


def read_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """motivo (empty for typed rows) and filas of all batches."""
    return spark.read.parquet(f"{out_dir}/{COUNTS}").groupBy("motivo").agg(F.sum("filas").alias("filas"))
