"""The queries of this subpackage and the SQL each must agree with."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
