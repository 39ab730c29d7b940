"""GTID sets and position tracking."""

import pytest
from pyspark.sql import functions as F

from rowcast.functions.gtid import format_gtid_set, in_gtid_set, parse_gtid_set, widen_single
from rowcast.operators.position import (assert_not_ahead, check_ahead, latest_state, resume_filter, saved_ranges,
                                        state_from_batch)

U = "fa632d10-864b-11ed-843e-0242c0a86002"
V = "3e11fa47-71ca-11e1-9e33-c80aa9429562"


def parse(spark, text):
    df = spark.createDataFrame([(text,)], "g string")
    return [tuple(r) for r in df.select(F.explode(parse_gtid_set("g")).alias("r")).select("r.*").collect()]


def test_parse_grammar(spark):
    assert parse(spark, f"{U}:1") == [(U, 1, 1)]
    assert parse(spark, f"{U}:1-9") == [(U, 1, 9)]
    assert parse(spark, f"{U}:1-18:20,\n  {V}:3") == [(U, 1, 18), (U, 20, 20), (V, 3, 3)]
    assert parse(spark, f"{U.upper()}:5-6") == [(U, 5, 6)]
    assert parse(spark, "") == []


def test_format_and_widen(spark):
    df = spark.createDataFrame([(f"{V}:3,{U}:20:1-18",), (f"{U}:18",)], "g string")
    out = df.select(format_gtid_set(parse_gtid_set("g")).alias("f"),
                    format_gtid_set(widen_single(parse_gtid_set("g"), 1)).alias("w")).collect()
    assert out[0].f == f"{V}:3,{U}:1-18:20"
    assert out[0].w == f"{V}:1-3,{U}:1-18:20"       # only a uuid's single interval is widened
    assert out[1].w == f"{U}:1-18"


def test_numbers_compare_as_numbers(spark):
    # upstream compares positions as text: "100" >= "18" is false (Q19)
    df = spark.createDataFrame([(9,), (10,), (11,), (99,), (100,), (101,)], "seq bigint")
    ranges = parse_gtid_set(F.lit(f"{U}:10-100"))
    got = [r.seq for r in df.filter(in_gtid_set(F.lit(U), "seq", ranges)).collect()]
    assert got == [10, 11, 99, 100]


@pytest.fixture()
def states(spark):
    return spark.createDataFrame([
        ("p1", f"{U}:5", 100), ("p1", f"{U}:9", 200), ("p1", f"{U}:99", 300),
        ("p2", f"{V}:1-50", 100),
    ], "name string, gtid string, timestamp bigint")


def test_latest_state(states):
    got = {r.name: r.gtid for r in latest_state(states).collect()}
    assert got == {"p1": f"{U}:99", "p2": f"{V}:1-50"}
    rng = {(r.name, r.uuid, r.lo, r.hi) for r in saved_ranges(states).collect()}
    assert rng == {("p1", U, 1, 99), ("p2", V, 1, 50)}


def test_resume_filter_per_pipeline(spark, states):
    ev = spark.createDataFrame([("p1", U, s, 0) for s in (9, 10, 99, 100, 101)]
                               + [("p2", U, 5, 0), ("p3", U, 1, 0)],
                               "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint")
    got = sorted((r.pipeline, r.gtid_seq) for r in resume_filter(ev, states).collect())
    # p2's state is for another uuid (P5): everything replays; p3 has no state (S3)
    assert got == [("p1", 100), ("p1", 101), ("p2", 5), ("p3", 1)]


def test_resume_filter_is_independent_of_the_buckets(spark):
    # many intervals for one uuid (a hot key), overlapping ones, and a second pipeline
    gtid = ":".join(f"{lo}-{lo + 4}" for lo in range(10, 400, 10)) + ":395-420"
    states = spark.createDataFrame([("p1", f"{U}:{gtid},{V}:1-3", 1), ("p2", f"{U}:100", 1)],
                                   "name string, gtid string, timestamp bigint")
    ev = spark.createDataFrame([(p, u, s, 0) for p in ("p1", "p2", "p3") for u in (U, V) for s in range(0, 460, 3)],
                               "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint")
    small = {tuple(r) for r in resume_filter(ev, states).collect()}
    large = {tuple(r) for r in resume_filter(ev, states, coarse=16, fine=4).collect()}
    assert small == large
    assert ("p1", U, 12, 0) not in large and ("p1", U, 15, 0) in large and ("p1", U, 420, 0) not in large
    assert ("p2", U, 99, 0) not in large and ("p2", U, 102, 0) in large and ("p1", V, 3, 0) not in large


def test_check_ahead(spark, states):
    ev = spark.createDataFrame([(U, 60, 0)], "gtid_uuid string, gtid_seq bigint, pos bigint")
    got = {r.name: (r.ahead, r.foreign) for r in check_ahead(ev, states).collect()}
    assert got == {"p1": (True, False), "p2": (False, True)}
    with pytest.raises(RuntimeError, match="ahead"):
        assert_not_ahead(ev, states)


def test_state_from_batch(spark):
    ev = spark.createDataFrame([("p1", U, 7), ("p1", U, 12), ("p1", V, 3), ("p2", U, 1)],
                               "pipeline string, gtid_uuid string, gtid_seq bigint")
    got = {r.name: (r.gtid, r.n_events) for r in state_from_batch(ev, "pipeline", timestamp=F.lit(1)).collect()}
    assert got == {"p1": (f"{V}:3,{U}:7:12", 3), "p2": (f"{U}:1", 1)}


def test_compact_state(spark, states, tmp_dir):
    from rowcast.operators.position import compact_state

    compact_state(states, f"{tmp_dir}/state2")
    got = {r.name: r.gtid for r in spark.read.parquet(f"{tmp_dir}/state2").collect()}
    assert got == {"p1": f"{U}:99", "p2": f"{V}:1-50"}


def test_start_from(spark, states):
    from rowcast.operators.position import start_from

    ev = spark.createDataFrame([("p1", U, s, 0) for s in (50, 150)], "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint")
    assert start_from(ev).count() == 2
    assert [r.gtid_seq for r in start_from(ev, states).collect()] == [150]


def test_exact_resume_finishes_a_split_transaction(spark):
    # transaction 10 has three row events; the batch that saved the state stopped after pos 2
    cols = "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint"
    processed = spark.createDataFrame([("p1", U, 9, 1), ("p1", U, 10, 1), ("p1", U, 10, 2)], cols)
    st = state_from_batch(processed, "pipeline", timestamp=F.lit(1))
    assert st.collect()[0].tail[0].asDict() == {"uuid": U, "seq": 10, "pos": 2}
    log = spark.createDataFrame([("p1", U, 9, 1), ("p1", U, 10, 1), ("p1", U, 10, 2), ("p1", U, 10, 3),
                                 ("p1", U, 11, 1)], cols)
    key = lambda df: sorted((r.gtid_seq, r.pos) for r in df.collect())
    assert key(resume_filter(log, st)) == [(11, 1)]                        # upstream: skips all of 10
    assert key(resume_filter(log, st, exact=True)) == [(10, 3), (11, 1)]
    assert key(resume_filter(log, st, exact=True, coarse=8, fine=2)) == [(10, 3), (11, 1)]
    with pytest.raises(ValueError, match="tail"):
        resume_filter(log, st.drop("tail"), exact=True)


COLS = "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint"


def test_state_merges_batches_servers_and_empty_batches(spark):
    first = spark.createDataFrame([("p", U.upper(), 9, 0), ("p", U, 10, 0)], COLS)
    st = state_from_batch(first, timestamp=F.lit(1))
    assert st.collect()[0].gtid == f"{U}:9-10"
    log = spark.createDataFrame([("p", U, s, 0) for s in range(1, 13)], COLS)
    assert sorted(r.gtid_seq for r in resume_filter(log, st).collect()) == [*range(1, 9), 11, 12]
    other = spark.createDataFrame([("p", V, 1, 0), ("p", V, 2, 0), ("p", U, 1, 0), ("p", None, 5, 0), ("p", U, None, 0)], COLS)
    st2 = state_from_batch(other, timestamp=F.lit(2), previous=st)
    assert st2.collect()[0].gtid == f"{V}:1-2,{U}:1:9-10"
    st3 = state_from_batch(other.limit(0), timestamp=F.lit(3), previous=st2)
    assert st3.collect()[0].gtid == st2.collect()[0].gtid
    # a single interval of our own is exact, not widened
    one = state_from_batch(spark.createDataFrame([("p", U, 7, 0)], COLS), timestamp=F.lit(1))
    assert sorted(r.gtid_seq for r in resume_filter(log, one).collect()) == [s for s in range(1, 13) if s != 7]


def test_uuid_case_does_not_matter(spark):
    states = spark.createDataFrame([("p", f"{U}:1-6", 1)], "name string, gtid string, timestamp bigint")
    ev = spark.createDataFrame([("p", U.upper(), s, 0) for s in range(1, 11)], COLS)
    assert resume_filter(ev, states).count() == 4
    assert [(r.ahead, r.foreign) for r in check_ahead(ev, states).collect()] == [(False, False)]


def test_many_intervals(spark):
    import time

    text = f"{U}:" + ":".join(f"{3 * i + 1}-{3 * i + 2}" for i in range(100_000))
    states = spark.createDataFrame([("p", text, 1)], "name string, gtid string, timestamp bigint")
    ev = spark.range(300_000).select(F.lit("p").alias("pipeline"), F.lit(U).alias("gtid_uuid"),
                                     (F.col("id") + 1).alias("gtid_seq"), F.lit(0).cast("bigint").alias("pos"))
    began = time.time()
    assert resume_filter(ev, states).count() == 100_000
    assert time.time() - began < 60


def islands(seqs):
    out = []
    for x in sorted(seqs):
        if out and x <= out[-1][1] + 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return [tuple(x) for x in out]


def numbers(rows, name, uuid):
    return sorted(x for r in rows if (r.name, r.uuid) == (name, uuid) and r.lo is not None for x in range(r.lo, r.hi + 1))


@pytest.mark.parametrize("shift", [3, 15])
def test_state_bitmaps_over_bucket_edges(spark, monkeypatch, shift):
    """Buckets of 8 numbers: many are full and become bits of level 1."""
    import random

    from rowcast.operators import bitmaps
    from rowcast.operators.position import state_bitmaps, state_text
    from rowcast.session import save_shared

    monkeypatch.setattr(bitmaps, "SHIFT", shift)
    monkeypatch.setattr(bitmaps, "WIDTH", 1 << shift)
    rnd = random.Random(3)
    done = {("p", U): {*range(5, 160), *rnd.sample(range(300), 20)}, ("p", V): set(rnd.sample(range(200), 120)), (None, U): {1, 2, 8, 9}}
    rows = [(n, u, x, i) for (n, u), v in done.items() for x in v for i in range(rnd.randrange(1, 3))]
    rnd.shuffle(rows)
    third = len(rows) // 3
    st = None
    for n, part in enumerate((rows[:third], rows[third:2 * third], rows[2 * third:], rows[:10])):
        st = save_shared(state_bitmaps(spark.createDataFrame(part, COLS).coalesce(1), timestamp=F.lit(n), previous=st), "test-state")
        if n == 1:  # a text on the way is as good
            st = save_shared(state_text(st), "test-state")
    kept = st.collect()
    assert len(kept) == len({(r.name, r.uuid, r.level, r.bucket) for r in kept}) and {r.level for r in kept} == ({0, 1, 2} if shift == 3 else {0, 2})
    got = bitmaps.decoded(st).collect()
    for (n, u), v in done.items():
        assert sorted(set(numbers(got, n, u))) == sorted(v)
        last = [(r.seq, r.pos) for r in got if (r.name, r.uuid) == (n, u) and r.seq is not None]
        assert last == [max((x[2], x[3]) for x in rows if x[:2] == (n, u))]
    assert sum(r.n for r in kept) == 10
    # the same state as a text, and the resume from the rows
    text = {r.name: r.gtid for r in state_text(st).collect()}
    assert text[None] == f"{U}:1-2:8-9"
    assert text["p"] == ",".join(f"{u}:" + ":".join(f"{a}-{b}" if a < b else str(a) for a, b in islands(done["p", u])) for u in sorted((U, V)))
    log = spark.createDataFrame([("p", u, x, 0) for u in (U, V) for x in range(310)], COLS)
    left = sorted((r.gtid_uuid, r.gtid_seq) for r in resume_filter(log, st).collect())
    assert left == sorted((u, x) for u in (U, V) for x in range(310) if x not in done["p", u])


def test_bitmaps_of_long_intervals(spark):
    """Upstream's one interval from the start: whole buckets aren't spelled out."""
    from rowcast.operators import bitmaps
    from rowcast.operators.position import as_bitmaps

    top = 3 * 2 ** 30 + 5 * 2 ** 15 + 7
    states = spark.createDataFrame([("p", f"{U}:{top},{V}:10-40000:65536-98303:98305", 1)], "name string, gtid string, timestamp bigint")
    rows = as_bitmaps(states)
    assert rows.count() == 6 + 4  # buckets 0 and the last, four of level 1; buckets 0, 1, 3 and one of level 1
    ev = [("p", U, x, 0) for x in (0, 1, 32767, 32768, 2 ** 30 - 1, 2 ** 30, 3 * 2 ** 30, top, top + 1)]
    ev += [("p", V, x, 0) for x in (9, 10, 40000, 40001, 65535, 65536, 98303, 98304, 98305, 98306)]
    log = spark.createDataFrame(ev, COLS)
    from rowcast.operators.position import state_bitmaps
    st = state_bitmaps(log.limit(0), timestamp=F.lit(2), previous=states)
    left = sorted(r.gtid_seq for r in resume_filter(log, st).collect())
    assert left == sorted([0, top + 1, 9, 40001, 65535, 98304, 98306])
    assert sorted((r.uuid, r.lo, r.hi) for r in saved_ranges(st).where(F.col("uuid") == V).collect()) == [
        (V, 10, 32767), (V, 32768, 40000), (V, 65536, 98303), (V, 98305, 98305)]
    assert {r.uuid: r.saved_seq for r in check_ahead(log, st).collect()} == {U: top, V: 98305}


def test_one_bit_of_a_hot_server(spark):
    """90 % of all events on one server: its rows are spread over its buckets."""
    from rowcast.operators.bitmaps import has_bit, one_bit
    from rowcast.operators.position import state_bitmaps

    at = spark.range(0, 32768, 37).select(F.col("id"), one_bit(F.col("id")).alias("b"))
    assert at.where(~has_bit(F.col("b"), F.col("id")) | has_bit(F.col("b"), F.col("id") + 1) | (F.length("b") != 4096)).count() == 0
    n = 400_000
    ev = spark.range(n).select(F.lit("p").alias("pipeline"), F.when(F.col("id") % 10 < 9, U).otherwise(V).alias("gtid_uuid"),
                               F.col("id").alias("gtid_seq"), F.lit(0).cast("bigint").alias("pos"))
    st = state_bitmaps(ev, timestamp=F.lit(1))
    rows = st.where("level = 0").collect()
    assert len(rows) == 2 * (n // 32768 + 1) and {len(r.bits) for r in rows} == {4096}
    assert resume_filter(ev, st).count() == 0


def test_state_with_too_many_intervals_stays_rows(spark, monkeypatch):
    from rowcast.operators import position

    monkeypatch.setattr(position, "MAX_TEXT", 3)
    ev = spark.createDataFrame([("p", U, s, 0) for s in (1, 3, 5, 7)], COLS)
    assert position.state_bitmaps(ev).where("level = 0").count() == 1
    with pytest.raises(Exception, match="rows"):
        state_from_batch(ev).collect()
    assert state_from_batch(ev.where("gtid_seq < 6")).collect()[0].gtid == f"{U}:1:3:5"
