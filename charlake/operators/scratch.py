"""Where intermediate tables go: the shared folder the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Shuffle files go at the end of a query while this is set.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders made for local sessions that name none, by application.
_made: dict[str, str] = {}

# The folders of the tables written here.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def scratch_root(spark: SparkSession) -> str:
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = tempfile.mkdtemp(prefix="charlake-")
    return _made[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written once as Parquet, with the writer's options, and read back, so that every later use sees the same rows.

    The shuffle files of the write go at its end: nothing reads them again, as the rows are in the shared folder.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    back = spark.read.schema(df.schema).parquet(path)
    _folders[back] = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete tables of `written` that no frame still to be worked out reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
