from pyspark.sql import functions as F

from reviewflow.operators import clean, quality


def _flags(spark, df, **kw):
    return {r["path"]: r["drop"] for r in clean.profile(df, **kw).collect()}


def test_profile_reference_defaults_drop_only_void_and_all_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "a int, b string, c string") \
        .withColumn("v", F.lit(None))
    assert _flags(spark, df) == {"a": False, "b": True, "c": False, "v": True}
    # without the all-null rule an all-null typed column is kept (empty sets)
    assert _flags(spark, df, drop_all_null=False)["b"] is False


def test_sentinels_trimmed_and_null_needs_membership(spark):
    df = spark.createDataFrame([(" ", -1), ("null", -1), ("", None)], "s string, n int")
    assert _flags(spark, df, null_strings=("", "null"), null_numbers=(-1,)) == {"s": True, "n": False}
    assert _flags(spark, df, null_strings=("", "null"), null_numbers=(-1, None))["n"] is True


def test_nested_and_array_leaves(spark):
    df = spark.sql("""SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING)) AS s,
                             array(named_struct('x', 'k', 'y', CAST(NULL AS BIGINT))) AS arr,
                             array(CAST(NULL AS STRING)) AS prim""")
    flags = _flags(spark, df)
    assert flags == {"s.a": False, "s.b": True, "arr.x": False, "arr.y": True, "prim": False}
    kept = clean.drop_null_fields(df)
    assert kept.schema.simpleString() == \
        "struct<s:struct<a:int>,arr:array<struct<x:string>>,prim:array<string>>"
    assert kept.first()["arr"][0]["x"] == "k"


def test_parent_dropped_when_all_children_go(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', CAST(NULL AS STRING)) AS s")
    assert clean.drop_null_fields(df).columns == ["id"]


def test_empty_frame_keeps_columns(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert clean.drop_null_fields(df).columns == ["a", "b"]


def test_quality_rules(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    rows = {r["rule"]: (r["observed"], r["outcome"]) for r in
            quality.evaluate(df, (("ColumnCount", ">", 0), ("Completeness", "t", ">=", 0.8))).collect()}
    assert rows == {"ColumnCount > 0": (1.0, "Passed"), 'Completeness "t" >= 0.8': (0.5, "Failed")}


def test_dotted_name_beside_a_nested_field(spark):
    df = spark.sql("""SELECT 'kept' AS `a.b`, named_struct('b', CAST(NULL AS STRING), 'c', 1) AS a,
                             CAST(NULL AS STRING) AS `x.y`, named_struct('y', 2) AS x""")
    assert _flags(spark, df) == {"`a.b`": False, "a.b": True, "a.c": False, "`x.y`": True, "x.y": False}
    kept = clean.drop_null_fields(df)
    assert kept.schema.simpleString() == "struct<a.b:string,a:struct<c:int>,x:struct<y:int>>"
    assert clean.drop_fields(df, [("a.b",), ("x", "y")]).columns == ["a", "x.y"]


def test_rule_text():
    assert quality.parse_rules('Rules=[ColumnCount > 0]') == quality.DEFAULT_RULES
    assert quality.parse_rules('Rules = [RowCount >= 10, Completeness "a b" > 0.5]') == (
        ("RowCount", ">=", 10), ("Completeness", "a b", ">", 0.5))
    for bad in ("ColumnCount > 0", "Rules = [ColumnCount]"):
        try:
            quality.parse_rules(bad)
        except ValueError:
            continue
        raise AssertionError(bad)
