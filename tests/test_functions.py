"""Column helpers."""

from pyspark.sql import functions as F

from rowcast import functions as RF


def test_js_length_counts_utf16_units(spark):
    df = spark.createDataFrame([("abc",), ("abcd",), ("é",), ("😀",), (None,)], "s string")
    assert [r.n for r in df.select(RF.js_length("s").alias("n")).collect()] == [3, 4, 1, 2, None]


def test_mask_field_threshold_and_nulls(spark):
    df = spark.createDataFrame([([("abc",), ("abcd",), (None,), ("😀😀",)],), (None,)], "img array<struct<t:string>>")
    out = df.select(RF.mask_field("img", "t", 3).alias("m")).collect()
    assert [r.t for r in out[0].m] == ["abc", "****", None, "****"]
    assert out[1].m is None


def test_any_and_all_rows_are_null_safe(spark):
    df = spark.createDataFrame([([("a",), (None,)],), (None,), ([],)], "img array<struct<t:string>>")
    got = df.select(RF.any_row("img", "t", lambda v: v == "a").alias("a"),
                    RF.all_rows("img", "t", lambda v: v.isNotNull()).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(True, False), (False, True), (False, True)]


def test_first_row_is_safe_on_empty(spark):
    df = spark.createDataFrame([([("a",)],), ([],), (None,)], "img array<struct<t:string>>")
    assert [r.f for r in df.select(RF.first_row("img")["t"].alias("f")).collect()] == ["a", None, None]


def test_reshape_rows_keeps_name_order(spark):
    df = spark.createDataFrame([([(1, "x", 2.5)],)], "img array<struct<b:int,c:string,z:double>>")
    out = df.select(RF.reshape_rows("img", ["b", "c", "z"], add={"a": lambda r: r["b"] * 10}, drop=("c",)).alias("r"))
    assert out.schema["r"].dataType.elementType.names == ["a", "b", "z"]
    assert out.collect()[0].r[0].a == 10


def test_helper_registry_and_sql_helpers(spark):
    assert RF.helper("obfuscate")() is not None
    RF.register_helper("upper_all", lambda c: F.upper(c))
    assert "upper_all" in RF.helpers()
    RF.register_sql_helpers(spark)
    r = spark.sql("SELECT obfuscate('secret') AS o, js_length('😀') AS n").collect()[0]
    assert (r.o, r.n) == ("****", 2)


def test_pandas_helper_and_variant_decode(spark):
    import json

    import pandas as pd

    from rowcast.operators.codec import decode_variant

    RF.register_pandas_helper(spark, "shout", lambda s: s.str.upper() + "!", "string")
    assert spark.sql("SELECT shout('hi') AS s").collect()[0].s == "HI!"
    df = spark.createDataFrame([("x",)], "t string")
    assert df.select(RF.helper("shout")(F.col("t")).alias("s")).collect()[0].s == "X!"
    recs = spark.createDataFrame([(json.dumps({"after": [{"text_col": "a", "n": 5}]}),)], "value string")
    ev = decode_variant(recs).select(F.variant_get("event", "$.after[0].n", "int").alias("n"))
    assert ev.collect()[0].n == 5 and pd is not None
