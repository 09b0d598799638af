"""Parquet folders whose columns changed their types over time, read as one table.

Types form a lattice: a whole number widens to a longer one or to a double, a float to a double, a decimal to one that
holds both, a date to a timestamp, NULL to anything. Two types without such a common one clash; the column is then read as text and
reported. Schemas are merged by Spark's own job over the footers; only where that fails are the files taken in
halves, so files of one schema are never looked at one by one. Groups that need no cast in common are one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType,
    StringType, StructField, StructType, TimestampType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The least type that takes every value of both; None if there is none. A long becomes a double only next to one, and may lose digits."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    for x, y in ((a, b), (b, a)):
        if isinstance(x, _WHOLE) and isinstance(y, _WHOLE) and _WHOLE.index(type(x)) <= _WHOLE.index(type(y)):
            return y
        if isinstance(x, (*_WHOLE, FloatType)) and isinstance(y, DoubleType):
            return y
        if isinstance(x, _WHOLE) and isinstance(y, FloatType):
            return DoubleType()
        if isinstance(x, _WHOLE) and isinstance(y, DecimalType):
            return _decimal(_DIGITS[type(x)], 0, y.precision, y.scale)
        if isinstance(x, DateType) and isinstance(y, TimestampType):
            return y
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return _decimal(a.precision, a.scale, b.precision, b.scale)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inside = wider(a.elementType, b.elementType)
        return None if inside is None else ArrayType(inside)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, inside = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        return None if key is None or inside is None else MapType(key, inside)
    if isinstance(a, StructType) and isinstance(b, StructType):
        both = merged([a, b])
        return None if both.clashes else both.schema
    return None


def _decimal(p1: int, s1: int, p2: int, s2: int) -> DataType | None:
    scale = max(s1, s2)
    precision = max(p1 - s1, p2 - s2) + scale
    return DecimalType(precision, scale) if precision <= 38 else None


@dataclass(frozen=True)
class Evolution:
    """The common schema, and for columns of several types what they were."""

    schema: StructType
    widened: dict[str, tuple[str, ...]] = field(default_factory=dict)
    clashes: dict[str, tuple[str, ...]] = field(default_factory=dict)


def merged(schemas: Sequence[StructType]) -> Evolution:
    """All schemas in one, columns in order of appearance, names in any case; a column that clashes anywhere is text."""
    seen: dict[str, list[DataType]] = {}
    names: dict[str, str] = {}
    for schema in schemas:
        for f in schema:
            names.setdefault(f.name.lower(), f.name)
            types = seen.setdefault(f.name.lower(), [])
            if f.dataType not in types:
                types.append(f.dataType)
    fields, widened, clashes = [], {}, {}
    for key, types in seen.items():
        common: DataType | None = types[0]
        for t in types[1:]:
            common = None if common is None else wider(common, t)
        if len(types) > 1:
            (clashes if common is None else widened)[names[key]] = tuple(sorted(t.simpleString() for t in types))
        fields.append(StructField(names[key], StringType() if common is None else common))
    return Evolution(StructType(fields), widened, clashes)


@dataclass(frozen=True)
class Group:
    files: tuple[str, ...]
    schema: StructType


def _merged_by_spark(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The files under the schema Spark merges, None where types are not equal."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    return None


def _groups(spark: SparkSession, files: Sequence[str]) -> list[Group]:
    """Runs of files whose schemas Spark can merge."""
    df = _merged_by_spark(spark, files)
    if df is not None:
        return [Group(tuple(files), df.schema)]
    half = len(files) // 2
    return _joined([*_groups(spark, files[:half]), *_groups(spark, files[half:])])


def _joined(groups: list[Group]) -> list[Group]:
    """Neighbours of one schema as one group."""
    out: list[Group] = []
    for g in groups:
        if out and out[-1].schema == g.schema:
            out[-1] = Group(out[-1].files + g.files, g.schema)
        else:
            out.append(g)
    return out


def files_below(spark: SparkSession, *paths: str) -> list[str]:
    """Parquet files in order of their paths: names only, no contents and no schema are read."""
    listed = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true").load(list(paths))
    return [r["path"] for r in listed.select("path").orderBy("path").toLocalIterator()]


def read_widened(spark: SparkSession, *paths: str) -> tuple[DataFrame, Evolution]:
    """All rows below the folders under the common schema, missing columns NULL, and what became of the types."""
    df = _merged_by_spark(spark, paths)
    if df is not None:
        return df, Evolution(df.schema)
    groups = _groups(spark, files_below(spark, *paths))
    found = merged([g.schema for g in groups])
    by_schema: dict[str, Group] = {}
    for g in groups:  # groups that lie apart may be of one schema
        key = g.schema.simpleString()
        by_schema[key] = Group(by_schema[key].files + g.files, g.schema) if key in by_schema else g
    parts = [_read(spark, g, found.schema) for g in by_schema.values()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows, found


def _read(spark: SparkSession, group: Group, schema: StructType) -> DataFrame:
    """A group's files under their own schema, cast to the common one."""
    df = spark.read.schema(group.schema).parquet(*group.files)
    own = {f.name.lower(): f.dataType for f in group.schema}

    def value(f: StructField) -> Column:
        if f.name.lower() not in own:
            return F.lit(None).cast(f.dataType)
        c = F.col(f"`{f.name}`")
        nested = isinstance(own[f.name.lower()], (ArrayType, MapType, StructType)) and isinstance(f.dataType, StringType)
        return F.to_json(c) if nested else c.cast(f.dataType)

    return df.select(*[value(f).alias(f.name) for f in schema])
