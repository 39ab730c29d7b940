"""Envelope construction (E1-E11) and the data quirks of SURVEY §1.6."""

import json

import pytest
from conftest import row
from pyspark.sql import functions as F

from rowcast.operators.codec import encode
from rowcast.operators.envelope import build_events

U = "u-1"


def events(make_log, entries, **kw):
    kw.setdefault("pipeline", "p")
    kw.setdefault("timestamp", F.lit(7))
    return build_events(make_log(entries), **kw)


def test_insert_delete_update_images(make_log):
    ev = events(make_log, [
        ("s", "t", "insert", [row(1, "a")], ["event_id"], U, 1, 0),
        ("s", "t", "delete", [row(2, "b")], ["event_id"], U, 2, 0),
        ("s", "t", "update", [row(3, "old"), row(3, "new"), row(4, "o2"), row(4, "n2")], ["event_id"], U, 3, 0),
    ]).orderBy("gtid_seq").collect()
    ins, dele, upd = ev
    assert ins.before is None and [r.text_col for r in ins.after] == ["a"]
    assert dele.after is None and [r.text_col for r in dele.before] == ["b"]
    assert [r.text_col for r in upd.before] == ["old", "o2"]
    assert [r.text_col for r in upd.after] == ["new", "n2"]


def test_topic_and_key_rules(make_log):
    ev = events(make_log, [
        ("db", "tbl", "insert", [row(1, "a", user_id=5), row(2, "b", user_id=6)], ["user_id", "event_id"], U, 1, 0),
        ("db", "tbl", "delete", [row(9, "x", user_id=3)], [], U, 2, 0),
    ]).orderBy("gtid_seq").collect()
    assert ev[0].kafka.topic == "db.tbl"
    assert ev[0].kafka.key == "5.1"          # numeric key parts are cast (Q1); row 0 only (Q2)
    assert ev[1].kafka.key == "db.tbl"       # no primary key: key = topic (E9)


def test_update_key_comes_from_before_image(make_log):
    ev = events(make_log, [("s", "t", "update", [row(1, "a"), row(2, "a")], ["event_id"], U, 1, 0)]).collect()
    assert ev[0].kafka.key == "1"            # Q3


def test_pk_list_argument_overrides_column(make_log):
    ev = events(make_log, [("s", "t", "insert", [row(1, "a", user_id=42)], ["event_id"], U, 1, 0)],
                pk=["user_id"]).collect()
    assert ev[0].kafka.key == "42"


def test_null_key_part_fails_by_default(make_log):
    ev = events(make_log, [("s", "t", "insert", [row(1, None)], ["text_col"], U, 1, 0)])
    with pytest.raises(Exception, match="null key value"):
        ev.collect()


def test_error_policies(make_log):
    entries = [
        ("s", "t", "update", [row(1, "a")], [], U, 1, 0),          # odd update rows (Q16)
        ("s", "t", "truncate", [row(2, "a")], [], U, 2, 0),        # unknown action (Q18)
        ("s", "t", "insert", [row(3, None)], ["text_col"], U, 3, 0),  # null key value
        ("s", "t", "insert", [row(4, "ok")], [], U, 4, 0),
    ]
    assert [r.gtid_seq for r in events(make_log, entries, on_error="drop").collect()] == [4]
    marked = {r.gtid_seq: r._error for r in events(make_log, entries, on_error="mark").collect()}
    assert marked == {1: "odd update rows", 2: "invalid action", 3: "null key value", 4: None}
    assert events(make_log, entries, on_error="pass").count() == 4
    with pytest.raises(Exception, match="malformed change event"):
        events(make_log, entries, on_error="fail").collect()


def test_empty_images_without_key_are_fine(make_log):
    ev = events(make_log, [("s", "t", "insert", [], [], U, 1, 0)]).collect()
    assert ev[0].after == [] and ev[0].kafka.key == "s.t"


def test_fields_sorted_by_name(spark):
    log = spark.createDataFrame([("s", "t", "insert", [(2, "z")], U, 1, 0)],
                                "schema string, table string, action string, rows array<struct<zeta:int,alpha:string>>,"
                                " gtid_uuid string, gtid_seq bigint, pos bigint")
    rec = encode(build_events(log, pipeline="p", timestamp=F.lit(1))).collect()[0]
    assert rec.value.index('"alpha"') < rec.value.index('"zeta"')


def test_bytes_to_string_for_string_columns(spark):
    log = spark.createDataFrame([("s", "t", "insert", [(bytearray(b"caf\xc3\xa9"), bytearray(b"\xff\x00"))], U, 1, 0)],
                                "schema string, table string, action string, rows array<struct<name:binary,raw:binary>>,"
                                " gtid_uuid string, gtid_seq bigint, pos bigint")
    ev = build_events(log, pipeline="p", timestamp=F.lit(1), string_columns=["name"])
    rec = encode(ev).collect()[0]
    after = json.loads(rec.value)["after"][0]
    assert after["name"] == "café"          # declared string: decoded (E5)
    assert after["raw"] == "/wA="            # binary stays binary -> base64 (Q13)


def test_meta_defaults_to_processing_time(make_log):
    ev = build_events(make_log([("s", "t", "insert", [row(1, "a")], [], U, 1, 0)]), pipeline="pipe").collect()[0]
    assert ev.meta.pipeline == "pipe" and ev.meta.timestamp > 1_600_000_000_000_000


def test_carried_columns_survive(make_log):
    ev = events(make_log, [("s", "t", "insert", [row(1, "a")], [], U, 11, 5)]).collect()[0]
    assert (ev.gtid_uuid, ev.gtid_seq, ev.pos) == (U, 11, 5)


def test_mixed_layout_map_images(spark):
    log = spark.createDataFrame(
        [("s", "t", "update", [{"id": "1", "v": "a"}, {"id": "1", "v": "b"}], ["id"], U, 1, 0)],
        "schema string, table string, action string, rows array<map<string,string>>, pk_columns array<string>,"
        " gtid_uuid string, gtid_seq bigint, pos bigint")
    ev = build_events(log, pipeline="p", timestamp=F.lit(1)).collect()[0]
    assert ev.kafka.key == "1" and ev.after[0]["v"] == "b" and ev.before[0]["v"] == "a"
