"""Bucketed per-key operators equal the plain window results, also with
one hot key and buckets far smaller than a key."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowcast.operators.ordered import keyed_lag, keyed_last_value, keyed_row_number, keyed_running_sum


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, o bigint, v bigint")


def hot_rows():
    rows = [("hot", i, i % 7 if i % 5 else None) for i in range(0, 600, 3)]
    rows += [(f"k{i % 9}", 1000 + i, i) for i in range(120)]
    return rows


def check_all(spark, rows, width):
    df = frame(spark, rows)
    w = Window.partitionBy("k").orderBy("o")
    want = {(r.k, r.o): (r.lag_v, r.rn, r.rs, r.lv) for r in df.select(
        "k", "o", F.lag("v").over(w).alias("lag_v"), F.row_number().over(w).alias("rn"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("lv")).collect()}
    a = keyed_lag(df, ["k"], ["o"], ["v"], prefix="lag_", width=width)
    a = keyed_row_number(a, ["k"], ["o"], "rn", width=width)
    a = keyed_running_sum(a, ["k"], ["o"], "v", "rs", width=width)
    a = keyed_last_value(a, ["k"], ["o"], "v", "lv", width=width)
    got = {(r.k, r.o): (r.lag_v, r.rn, r.rs, r.lv) for r in a.collect()}
    assert got == want


def test_hot_key_small_buckets(spark):
    check_all(spark, hot_rows(), width=10)


def test_one_bucket(spark):
    check_all(spark, hot_rows(), width=1 << 20)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 200),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40,
                unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 50))
def test_property_equal_to_window(spark, rows, width):
    check_all(spark, rows, width)


def test_lag_of_null_value_is_not_confused_with_first_row(spark):
    df = frame(spark, [("a", 1, None), ("a", 2, 5), ("a", 30, None), ("a", 31, 1)])
    got = {r.o: r.p_v for r in keyed_lag(df, ["k"], ["o"], ["v"], prefix="p_", width=10).collect()}
    assert got == {1: None, 2: None, 30: 5, 31: None}


def test_hot_null_key_is_split_and_correct(spark):
    rows = [(None, i, i % 3) for i in range(0, 200)] + [("a", i, 1) for i in range(5)]
    check_all(spark, rows, width=8)


def test_time_and_date_keys(spark):
    import datetime as dt

    from rowcast.operators.ordered import keyed_row_number

    rows = [(dt.date(2024, 1, 1 + i % 2), dt.datetime(2024, 1, 1, i % 3), i) for i in range(30)] + [(None, None, 99)]
    df = spark.createDataFrame(rows, "d date, t timestamp, o bigint")
    got = {(r.d, r.t, r.o): r.rn for r in keyed_row_number(df, ["d", "t"], ["o"], "rn", width=2).collect()}
    w = Window.partitionBy("d", "t").orderBy("o")
    want = {(r.d, r.t, r.o): r.rn for r in df.select("d", "t", "o", F.row_number().over(w).alias("rn")).collect()}
    assert got == want
