"""CSV and Parquet in and out, with checks of what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from charlake.operators.scratch import written
from charlake.operators.skew import in_slices, with_ordinal

CSV = {"header": "true", "quote": '"', "escape": '"', "sep": ","}


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Quoted CSV with a header. A multi-line file is read by one task; write several, or turn it off."""
    return spark.read.schema(schema).options(**CSV, multiLine=str(multi_line).lower()).csv(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """One file per task, split again above `rows_per_file` so that later reads spread out."""
    df.write.mode("overwrite").options(**CSV, maxRecordsPerFile=rows_per_file).csv(path)


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Snappy Parquet, a file per task unless a number of files is asked for."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folders of compatible schemas as one table; a missing column is NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def register(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def _fingerprint(df: DataFrame) -> list[Column]:
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("filas"), F.sum(row_hash).alias("valores")]


def write_verified(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write Parquet, read it back and give one row: rows, columns, and whether they equal what was written.

    The written side is counted and hashed while it is written, so the frame is worked out once.
    """
    seen = Observation()
    write_parquet(df.observe(seen, *_fingerprint(df)), path, files)
    back = df.sparkSession.read.parquet(path)
    same_schema = [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    return back.agg(*_fingerprint(back)).select(
        "filas",
        F.lit(len(back.columns)).alias("columnas"),
        (F.col("filas") == F.lit(seen.get["filas"])).alias("filas_iguales"),
        F.col("valores").eqNullSafe(F.lit(seen.get["valores"])).alias("valores_iguales"),
        F.lit(same_schema).alias("esquema_igual"),
    )


FEEDBACK_FILE = "feedback_analysis.parquet"


def write_feedback(feedback: DataFrame, folder: str, output_format: str = "parquet") -> str:
    """The feedback table under its fixed name. Both accepted formats, `parquet` and `both`, write Parquet."""
    if output_format not in ("parquet", "both"):
        raise ValueError(f"unknown format: {output_format}")
    path = f"{folder.rstrip('/')}/{FEEDBACK_FILE}"
    write_parquet(feedback, path)
    return path


def file_inventory(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Written files and their sizes; contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("archivo"), F.col("path").alias("uri"), F.col("length").alias("bytes"))
    )


def _document() -> Column:
    """An import manifest of a group's files."""
    listed = F.array(F.struct(F.array_sort(F.collect_list("uri")).alias("URIs")))
    settings = F.struct(F.lit("CSV").alias("format"), F.lit("true").alias("containsHeader"))
    return F.to_json(F.struct(listed.alias("fileLocations"), settings.alias("globalUploadSettings"))).alias("manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The import manifest of the CSV files as one JSON document, for folders of few files. An error if there are none."""
    files = file_inventory(spark, path)
    if files.isEmpty():
        raise ValueError(f"no CSV files in {path}")
    return files.agg(F.count(F.lit(1)).alias("archivos"), _document())


def write_manifests(spark: SparkSession, path: str, out_dir: str, files_per_manifest: int = 1_000) -> DataFrame:
    """Import manifests of bounded size, one JSON file each below `out_dir/manifests`, and their index, also written there.

    Files are taken in the order of their URIs, numbered in range slices, so no task sees all of them. The index has
    a row per manifest: numero, archivos, bytes, primero and ultimo (URIs). An error if there are no files.
    The files are asked for their sizes once, and many tasks write the manifests, as each is a file to be made.
    """
    files = written(file_inventory(spark, path).select("uri", "bytes"), "inventory")
    if files.isEmpty():
        raise ValueError(f"no CSV files in {path}")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = with_ordinal(in_slices(files, [], ["uri"], slices), [], ["uri"], "_place")
    rows = ordered.withColumn("numero", F.call_function("div", F.col("_place"), F.lit(files_per_manifest).cast("long")))
    made = written(rows.groupBy("numero").agg(
        F.count(F.lit(1)).alias("archivos"), F.sum("bytes").alias("bytes"), F.min("uri").alias("primero"), F.max("uri").alias("ultimo"), _document(),
    ), "manifests")
    made.select("numero", "manifest").repartition(slices, "numero").write.mode("overwrite").partitionBy("numero").text(f"{out_dir}/manifests")
    made.drop("manifest").write.mode("overwrite").json(f"{out_dir}/index")
    return made.drop("manifest")
