"""Folders of files whose types changed."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from charlake.catalog.tables import register_parquet, sync_table
from charlake.sources.evolution import merged, read_widened, wider

WIDER = [
    ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("float", "double", "double"), ("int", "double", "double"), ("int", "float", "double"),
    ("date", "timestamp", "timestamp"), ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(5,3)", "decimal(23,3)"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", None),
    ("int", "string", None), ("date", "int", None), ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "array<string>", None),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("map<string,int>", "map<string,double>", "map<string,double>"), ("void", "int", "int"),
]


@pytest.mark.parametrize("a,b,want", WIDER)
def test_lattice(spark, a, b, want):
    a, b = (T._parse_datatype_string(x) for x in (a, b))
    for x, y in ((a, b), (b, a)):
        found = wider(x, y)
        assert (found and found.simpleString()) == want


def test_merged_schemas(spark):
    s = lambda text: T._parse_datatype_string(text)
    found = merged([s("a int, b string"), s("A bigint, c date"), s("a double, b int")])
    assert found.schema.simpleString() == "struct<a:double,b:string,c:date>"
    assert found.widened == {"a": ("bigint", "double", "int")} and found.clashes == {"b": ("int", "string")}


def write(spark, path, rows, schema, files=1):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(str(path))


def test_many_files_of_several_types(spark, tmp_path):
    """Types that go back and forth, columns that come and go, a clash; every row is there once."""
    write(spark, tmp_path / "a", [(i, float(i), "x") for i in range(20)], "k int, v float, t string", 4)
    write(spark, tmp_path / "b", [(10**12 + i, i / 8, 5) for i in range(20)], "k bigint, v double, t int", 4)
    write(spark, tmp_path / "c", [(i, 1) for i in range(100, 120)], "k int, nuevo int", 3)
    write(spark, tmp_path / "d", [(i, 2.5, None) for i in range(200, 205)], "k int, v float, t string", 2)
    df, found = read_widened(spark, *[str(tmp_path / x) for x in "abcd"])
    assert df.schema.simpleString() == "struct<k:bigint,v:double,t:string,nuevo:int>"
    assert set(found.widened) == {"k", "v"} and found.clashes == {"t": ("int", "string")}
    want = {(i, float(i), "x", None) for i in range(20)} | {(10**12 + i, i / 8, "5", None) for i in range(20)} | {(i, None, None, 1) for i in range(100, 120)} | {(i, 2.5, None, None) for i in range(200, 205)}
    got = list(map(tuple, df.collect()))
    assert len(got) == 65 and set(got) == want
    # Pruning and filters still reach the scans.
    plan = df.where("k > 100").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "nuevo" not in plan.split("ReadSchema")[1] and "PushedFilters" in plan


def test_files_spark_merges_by_itself_are_one_scan(spark, tmp_path):
    write(spark, tmp_path / "a", [(1,)], "k int")
    write(spark, tmp_path / "b", [(2, "x")], "k int, t string")
    df, found = read_widened(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert sorted(map(tuple, df.collect())) == [(1, None), (2, "x")] and not found.widened and not found.clashes
    with pytest.raises(PySparkException):
        read_widened(spark, str(tmp_path / "none"))


def test_the_catalogue_follows(spark, tmp_path):
    """A wider column, a new one, one that clashes, one that is gone; the path has a quote."""
    path, name = tmp_path / "it's", "evolving_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write(spark, path, [(1, "x", 1.5)], "k int, t string, gone float")
    assert sync_table(spark, name, str(path)) == {"added": ["k", "t", "gone"], "changed": [], "deleted": [], "clashing": []}
    write(spark, path, [(10**12, "y", True)], "k bigint, t string, nuevo boolean")
    assert sync_table(spark, name, str(path)) == {"added": ["nuevo"], "changed": ["k"], "deleted": [], "clashing": []}
    assert sorted(map(tuple, spark.table(name).select("k", "t", "nuevo").collect())) == [(1, "x", None), (10**12, "y", True)]
    assert sync_table(spark, name, str(path)) == {"added": [], "changed": [], "deleted": [], "clashing": []}
    write(spark, path, [(3, 7)], "k int, t int")
    assert sync_table(spark, name, str(path))["clashing"] == ["t"]
    assert {r.t for r in register_parquet(spark, "evolving_view", str(path)).select("t").collect()} == {"x", "y", "7"}
    assert spark.table("evolving_view").agg(F.max("k")).first()[0] == 10**12
    spark.sql(f"DROP TABLE {name}")
