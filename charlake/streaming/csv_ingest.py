"""New CSV files of the user table to typed Parquet, each file once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from charlake.config import ChatConfig
from charlake.plans.typed_table import type_user_table
from charlake.schemas import USER_CSV


def start_csv_ingest(
    spark: SparkSession,
    csv_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    cfg: ChatConfig = ChatConfig(),
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Take in all files there are and stop. A later run with the same checkpoint takes only new ones."""
    arrived = (
        spark.readStream.schema(USER_CSV)
        .options(header="true", multiLine="true", quote='"', escape='"', sep=",", maxFilesPerTrigger=files_per_batch)
        .csv(csv_dir)
    )
    return (
        type_user_table(arrived, cfg)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
