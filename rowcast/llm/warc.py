"""WARC archives: a distributed writer and a splittable reader.

Writing: each row becomes one gzip member.  Spark's own text writer puts the
bytes into the store (any file system, with its commit protocol); its one-byte
line end serves as the member's last byte, which is 0 in a member under 16 MB,
and a larger one is followed by an empty member, whose last byte is 0 again.

Reading: tasks scan byte ranges of the files for the gzip magic number (the
text source's split reader with the magic as its separator), so an archive of
any size is read in parallel and a record belongs to the range in which it
starts.  A magic number can also occur inside compressed data; a candidate
counts only when it inflates to its trailer and its WARC headers decode, and
the pieces of a member that was cut at a false magic are joined again.  A range
that ends within such a member says so; a second pass reads the ranges after
those again, from the open member on, and replaces what they gave alone.

Equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the row with
the smallest id is the response, the others revisit it.

Defined cases: a null payload is empty; a null url has no target header; all rows
that tie on the smallest id are responses, so are all of a group whose ids are
null; else a null id counts as the largest; an empty table writes an archive
without records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import deque
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.session import shared_path

from .common import BATCH_ROWS, written

MIN_REVISIT = 100

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

ROW_DDL = "page_id long, url string, html string, digest string, bytes long, first_id long, is_first boolean"
RECORD_DDL = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
              "payload_digest string, refers_to long")


def gzip_member(body: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(body) + c.flush()


def closed(member: bytes) -> bytes:
    """The member as the writer takes it: without a last byte of 0."""
    return member[:-1] if member[-1] == 0 else member + gzip_member(b"")[:-1]


def _clean(url: str) -> str:
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _restore(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id, url, payload: bytes, digest: str, n: int, refers_to) -> bytes:
    """A response, or (refers_to) a revisit without payload."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + (payload if refers_to is None else b"")
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def classified(pages: DataFrame) -> DataFrame:
    """Rows to write, with the payload's digest and length and the response's id
    of each group of equal payloads (ROW_DDL).  Only digests that occur twice
    are looked up, and no payload waits for its group."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), F.sha2(payload, 256).alias("digest"),
                        F.length(payload).cast("long").alias("bytes"))
    keys = rows.where(F.col("bytes") >= MIN_REVISIT).select("digest", "page_id")
    groups = (keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first_id"))
    first = F.col("page_id").eqNullSafe(F.col("first_id"))
    out = rows.join(groups, "digest", "left").withColumn("is_first", F.col("first_id").isNull() | first)
    return out.select("page_id", "url", "html", "digest", "bytes", "first_id", "is_first")


def write_archives(pages: DataFrame, path: str) -> str:
    """Write one record per row below ``path``; returns the path."""
    def run(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([closed(gzip_member(
            (f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\n"
             "Content-Length: 0\r\n\r\n\r\n\r\n").encode()))], pa.binary())], names=["value"])
        for b in batches:
            out = []
            for page, url, html, digest, n, first, is_first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                refers = None if is_first else first
                out.append(closed(gzip_member(record(page, url, (html or "").encode() if refers is None else b"",
                                                     digest, n, refers))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    members = classified(pages).mapInArrow(run, "value binary")
    # the text writer passes the bytes of its string column through as they are
    members.select(F.col("value").cast("string")).write.option("lineSep", "\x00").text(path)
    return path


# -- reading ---------------------------------------------------------------------

def parse_record(data: bytes):
    """RECORD_DDL row of a record, or None if it isn't a page record."""
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION.encode():
        return None
    f = {k.strip().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
    kind = f.get(b"warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = block[:int(f[b"content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    uri = f.get(b"warc-target-uri")

    def page(x):
        return int(x[12:-1]) if x and x[12:-1] else None

    if kind == "response":
        size, digest, refers = len(payload), hashlib.sha256(payload).hexdigest(), None
    else:
        size, digest, refers = int(f[b"x-payload-length"]), f[b"warc-payload-digest"].partition(":")[2], page(f.get(b"warc-refers-to"))
    return (page(f.get(b"warc-record-id")), None if uri is None else _restore(uri), kind,
            payload if kind == "response" else None, size, digest, refers)


#: Bytes of a gzip header after its magic number.
HEADER_REST = 7


class Member:
    """A member as far as its pieces have come."""

    def __init__(self):
        self.begun, self.state, self.out = [], zlib.decompressobj(31), []

    def feed(self, chunk: bytes):
        """'open', 'bad' (no gzip, or no WARC record), or the whole content."""
        if not self.begun and len(chunk) < HEADER_REST:
            return "bad"
        self.begun.append(chunk)
        try:
            self.out.append(self.state.decompress(MAGIC + chunk))
        except zlib.error:
            return "bad"
        if len(self.out) > 1 and len(self.out[0]) < 5:
            self.out = [b"".join(self.out)]
        if not b"WARC/".startswith(self.out[0][:5]):
            return "bad"
        return b"".join(self.out) if self.state.eof else "open"


def joined(chunks, first: list[bytes] | None = None):
    """Members of a run of consecutive pieces: ('record', bytes), and at the end
    ('open', pieces) of a member that goes on after them, if one does.
    ``first`` are the pieces of a member that is open before."""
    again, chunks, member = deque(first or ()), iter(chunks), None
    while True:
        if again:
            chunk = again.popleft()
        elif (chunk := next(chunks, None)) is None:
            break
        member = member or Member()
        got = member.feed(chunk)
        if got == "open":
            continue
        if isinstance(got, bytes):
            yield "record", got
        elif len(member.begun) > 1:  # not a member after all: any later piece may begin one
            again.extendleft(reversed(member.begun[1:]))
        member = None
    if member is not None:
        yield "open", member.begun


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, chunk): the pieces between magic numbers, read by ranges."""
    return (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("chunk")))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The page records of the archives below ``path`` (RECORD_DDL); without
    ``payloads`` their bytes are checked and counted but not kept."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ddl = RECORD_DDL + ", file string, block long, begun binary"
    names = [x.split()[0] for x in RECORD_DDL.split(", ")]

    def kept(data: bytes):
        r = parse_record(data)
        return r if r is None or payloads else (*r[:3], None, *r[4:])

    def run(batches):
        def chunks():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        def rows():
            for (file, block), own in groupby(chunks(), key=lambda x: (x[0], x[1])):
                for kind, data in joined(x[2] for x in own):
                    if kind == "open":
                        yield (None,) * 7 + (file, block, MAGIC.join(data))
                    elif (r := kept(data)) is not None:
                        yield r + (file, block, None)
                yield (None,) * 7 + (file, block, None)  # the range was read

        yield from _batches(rows(), ddl)

    found = written(_raw(spark, path).mapInArrow(run, ddl), "warc-records")
    records = found.where("record_type is not null")
    if found.where("begun is not null").isEmpty():
        return records.select(*names)

    # ranges in file order; one that follows an open member is read again with it
    order = Window.partitionBy("file").orderBy("block")
    ranges = written(found.where("record_type is null").groupBy("file", "block").agg(F.max("begun").alias("begun"))
                     .withColumns({"before": F.lag("begun").over(order), "after": F.lead("block").over(order)}), "warc-ranges")
    again = ranges.withColumn("again", F.col("before").isNotNull())

    def mend(key, t):
        import pyarrow as pa

        rows = sorted(zip(*(t.column(k).to_pylist() for k in ("block", "at", "chunk", "after")), strict=True), key=lambda r: r[:2])
        out = []
        for kind, data in joined((r[2] for r in rows[1:]), rows[0][2].split(MAGIC)):
            if kind == "open":
                out.append((None,) * 7 + (rows[-1][3], key[0].as_py()))
            elif (r := kept(data)) is not None:
                out.append(r + (None, None))
        cols = list(zip(*out, strict=True)) or [[]] * 9
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _arrow(mend_ddl), strict=True)], schema=_arrow(mend_ddl))

    mend_ddl = RECORD_DDL + ", after long, file string"
    while True:
        runs = again.withColumn("run", F.sum(F.when(F.col("again"), 0).otherwise(1)).over(order))
        told = written(runs.where("again").select("file", "block", "run", "after", "before"), "warc-again")
        pieces = (_raw(spark, path).withColumn("at", F.monotonically_increasing_id())
                  .join(told.drop("before"), ["file", "block"]).select("file", "run", "block", "at", "chunk", "after"))
        first = told.groupBy("file", "run").agg(F.min_by("before", "block").alias("chunk"))
        none = F.lit(-1).cast("long")
        heads = first.select("file", "run", none.alias("block"), none.alias("at"), "chunk", none.alias("after"))
        # a group is the ranges after one open member: a split's bytes, seldom more
        mended = written(pieces.unionByName(heads).groupBy("file", "run").applyInArrow(mend, mend_ddl), "warc-mended")
        more = mended.where("record_type is null and after is not null").select("file", F.col("after").alias("block"),
                                                                                F.lit(True).alias("more"))
        if more.isEmpty():
            break
        # the member goes on behind the ranges read again: one range more
        again = written(again.join(more.distinct(), ["file", "block"], "left")
                        .withColumn("again", F.col("again") | F.coalesce("more", F.lit(False))).drop("more"), "warc-ranges")
    alone = records.join(told.select("file", "block"), ["file", "block"], "left_anti")
    return alone.select(*names).unionByName(mended.where("record_type is not null").select(*names))


def _arrow(ddl: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _batches(rows, ddl: str, most: int = 256):
    """Record batches of at most ``most`` rows."""
    import pyarrow as pa

    schema, rows = _arrow(ddl), iter(rows)
    while part := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)],
                                         schema=schema)


def archive_path(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared folder."""
    return shared_path(spark, "warc")
