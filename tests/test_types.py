"""The source type table in both layouts, and JSON details."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from rowcast.operators.codec import decode, encode
from rowcast.operators.envelope import build_events, name_positional
from rowcast.operators.mixed import to_mixed_log

IMG = ("bigint_col bigint, binary_col binary, bit_col bigint, bool_col tinyint, date_col date, "
       "datetime_col timestamp_ntz, decimal_col decimal(10,2), double_col double, enum_col string, "
       "float_col float, int_col int, json_col string, mediumint_col int, set_col array<string>, "
       "smallint_col smallint, text_col string, time_col string, timestamp_col timestamp, "
       "tinyint_col tinyint, varchar_col string, year_col int")


def type_log(spark):
    img = (9007199254740993, bytearray(b"\x00\x01"), 5, 1, dt.date(2024, 2, 29),
           dt.datetime(2024, 1, 2, 3, 4, 5, 678901), Decimal("1.50"), 1e21, "2", 1.25, -7, '{"a": [1, 2]}', 8388607,
           ["1", "3"], -32768, "<&> é 😀", "-838:59:59", dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc),
           -128, "v", 2024)
    df = spark.createDataFrame([("db", "t", "insert", [img], "u", 1, 0)],
                               f"schema string, table string, action string, rows array<struct<{IMG}>>, "
                               "gtid_uuid string, gtid_seq bigint, pos bigint")
    return df.withColumn("rows", F.transform("rows", lambda r: r.withField("json_col", F.parse_json(r["json_col"]))))


def test_typed_json_forms(spark):
    rec = encode(build_events(type_log(spark), pipeline="p", timestamp=F.lit(1))).collect()[0]
    after = json.loads(rec.value)["after"][0]
    assert list(after) == sorted(after)
    assert after["bigint_col"] == 9007199254740993
    assert after["binary_col"] == "AAE="
    assert after["date_col"] == "2024-02-29"
    assert after["datetime_col"] == "2024-01-02 03:04:05.678901"
    assert after["timestamp_col"] == "2024-01-02 03:04:05.000000"
    assert after["decimal_col"] == 1.5 and after["double_col"] == 1e21
    assert after["json_col"] == {"a": [1, 2]}
    assert after["set_col"] == ["1", "3"] and after["text_col"] == "<&> é 😀"
    assert after["time_col"] == "-838:59:59" and after["year_col"] == 2024


def test_mixed_layout_encodes_like_typed(spark):
    log = type_log(spark).withColumn("rows", F.transform(
        "rows", lambda r: r.withField("datetime_col", F.date_format(r["datetime_col"], "yyyy-MM-dd HH:mm:ss.SSSSSS"))
                           .withField("timestamp_col", F.date_format(r["timestamp_col"], "yyyy-MM-dd HH:mm:ss.SSSSSS"))))
    typed = json.loads(encode(build_events(log, pipeline="p", timestamp=F.lit(1))).collect()[0].value)
    mixed = json.loads(encode(build_events(to_mixed_log(log), pipeline="p", timestamp=F.lit(1))).collect()[0].value)
    assert mixed == typed


def test_decode_round_trip(spark):
    rec = encode(build_events(type_log(spark), pipeline="p", timestamp=F.lit(1)))
    ev = decode(rec, "struct<int_col:int,text_col:string,decimal_col:decimal(10,2)>").collect()[0]
    assert (ev.after[0].int_col, ev.after[0].text_col, ev.after[0].decimal_col) == (-7, "<&> é 😀", Decimal("1.50"))
    assert ev.kafka.topic == "db.t" and ev.before is None


def test_positional_rows_and_short_rows(spark):
    df = spark.createDataFrame([([["1", "a"], ["2"]], ["id", "name"])], "rows array<array<string>>, cols array<string>")
    out = df.select(name_positional(F.col("rows"), F.col("cols"), "string").alias("m")).collect()[0].m
    assert out == [{"id": "1", "name": "a"}, {"id": "2", "name": None}]


def test_positional_rows_typed(spark):
    from pyspark.sql import types as T

    from rowcast.operators.envelope import name_positional_typed

    it = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("score", T.DoubleType())])
    df = spark.createDataFrame([([["1", "a", "2.5"], ["2"]],)], "rows array<array<string>>")
    out = df.select(name_positional_typed(F.col("rows"), it).alias("r")).collect()[0].r
    assert [tuple(x) for x in out] == [(1, "a", 2.5), (2, None, None)]
