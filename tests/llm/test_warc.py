"""WARC: exact round trip over many splits, gzip validity and edge cases."""

import gzip
import hashlib
import random

import pytest

from rowcast.llm import warc as W

DDL = "page_id long, url string, html string, digest string, first_id long, value string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "v") for r in rows], DDL)


def hard_rows():
    rnd = random.Random(0)
    rows = []
    for i in range(300):
        n = rnd.choice([0, 1, 99, 100, 500, 5000])
        rows.append((i, f"http://h/{i}", "".join(chr(rnd.choice([65, 0x1F, 0x8B, 8, 0x20AC, 10, 13, 0])) for _ in range(n))))
    return rows + [(1000 + i, "http://copy", rows[5][2] + "c" * 200) for i in range(40)]


@pytest.mark.parametrize("split", ["128m", "3000b", "997b"])
def test_round_trip_over_splits(spark, split):
    rows = hard_rows()
    path = W.write_archives(pages(spark, rows).repartition(3), W.archive_path(spark))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "100b")
    try:
        got = {r.page_id: r for r in W.read_archives(spark, path).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        first.setdefault(h, i)
    for i, u, h in rows:
        r, body = got[i], h.encode()
        assert (r.url, r.payload_bytes, r.payload_digest) == (u, len(body), hashlib.sha256(body).hexdigest())
        if len(body) >= 100 and first[h] != i:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", first[h], None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, body)


def test_files_are_plain_gzip(spark):
    import glob

    path = W.write_archives(pages(spark, hard_rows()[:30]), W.archive_path(spark))
    files = glob.glob(path.removeprefix("file:") + "/part-*")
    assert files and all(gzip.decompress(open(f, "rb").read()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for f in files)


def test_false_magic_inside_a_member():
    bodies = [b"WARC/1.1\r\n" + bytes([k]) * 50 for k in range(4)]
    members = [W.gzip_member(b) for b in bodies]
    # a stored block carries the magic number as it is
    import zlib
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    tricky = b"WARC/1.1\r\n" + W.MAGIC * 3 + b"x" + members[0] + W.MAGIC
    members.insert(2, c.compress(tricky) + c.flush())
    chunks = b"".join(members).split(W.MAGIC)[1:]
    assert [x[1] for x in W.joined(chunks)] == [bodies[0], bodies[1], tricky, bodies[2], bodies[3]]
    # a range that ends within a member, and the next that begins in it
    for cut in range(1, len(chunks)):
        a = list(W.joined(chunks[:cut]))
        begun = a.pop()[1] if a and a[-1][0] == "open" else None
        assert [x[1] for x in a + list(W.joined(chunks[cut:], begun))] == [bodies[0], bodies[1], tricky, bodies[2], bodies[3]]


@pytest.mark.parametrize("split", ["40b", "211b", "1000b", "128m"])
def test_archive_within_a_stored_member(spark, tmp_dir, split):
    import zlib

    def rec(i, payload):
        return W.record(i, f"u{i}", payload, hashlib.sha256(payload).hexdigest(), len(payload), None)
    inner = b"".join(W.gzip_member(rec(900 + i, b"inner" * i)) for i in range(3))
    members, want = [], {}
    for i in range(40):
        payload = (inner + W.MAGIC * (i % 4)) if i % 3 == 0 else b"page %d" % i
        c = zlib.compressobj(0 if i % 3 == 0 else 6, zlib.DEFLATED, 31)
        members.append(c.compress(rec(i, payload)) + c.flush())
        want[i] = payload
    with open(f"{tmp_dir}/a.warc", "wb") as f:
        f.write(b"".join(members) + members[1][:20])  # and a cut member at the end
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        got = [(r.page_id, bytes(r.payload)) for r in W.read_archives(spark, tmp_dir).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == 40 and dict(got) == want


def test_members_end_with_a_zero_byte():
    for body in (b"", b"x", b"y" * (1 << 24), b"z" * ((1 << 24) + 5)):
        assert gzip.decompress(W.closed(W.gzip_member(body)) + b"\x00") == body


def test_edges(spark):
    long = "é" * 2_000_000
    rows = [(1, None, None), (2, "http://a\r\nb%0A", ""), (3, "u", "t" * 99), (4, "u", "t" * 99), (5, "u", long), (6, "u", long),
            (7, "u", "r" * 200), (7, "u", "r" * 200), (None, "n", "s" * 200), (8, "n", "s" * 200)]
    path = W.write_archives(pages(spark, rows), W.archive_path(spark))
    got = W.read_archives(spark, path).collect()
    assert len(got) == 10
    by = {r.page_id: r for r in got}
    assert by[1].url is None and by[1].payload_bytes == 0 and by[2].url == "http://a\r\nb%0A"
    assert by[3].record_type == by[4].record_type == "response" and by[6].refers_to == 5 and by[5].payload_bytes == 4_000_000
    assert by[None].refers_to == 8 and by[8].record_type == "response"
    assert all(r.payload is None for r in W.read_archives(spark, path, payloads=False).collect())
    empty = W.write_archives(pages(spark, rows).limit(0), W.archive_path(spark))
    assert W.read_archives(spark, empty).count() == 0
