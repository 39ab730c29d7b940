"""K1: a two-phase fan-out sink for streams.

Tasks write per-topic segments of records into ``<path>/data``, where nothing
reads them; when all tasks are done the driver commits one manifest per batch,
``<path>/manifest/<batch>.json``, by a rename: (topic, segment, records, first and
last position).  Readers follow the manifests, so records of a batch that was
killed between write and commit are never seen, and a replayed batch replaces its
manifest.  A segment has at most ``SEGMENT_BYTES`` of records, and records are dealt
to tasks by (topic, run of positions), so the files of a topic follow its bytes
and not the number of tasks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from rowcast.model import GTID_SEQ, POS
from rowcast.sources.segments import _store

FORMAT = "rowcast_segments"
#: Bytes of keys and values in a segment.
SEGMENT_BYTES = 64 << 20
#: Sequence numbers of a topic that go to one task.
RUN_WIDTH = 1 << 20


@dataclass
class _Written(ds.WriterCommitMessage):
    segments: list


class _Writer(ds.DataSourceStreamWriter):
    def __init__(self, path: str, names: list[str], limit: int):
        self.path, self.names, self.limit = path, names, limit

    def write(self, iterator):
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq

        store, root = _store(self.path)
        store.create_dir(f"{root}/data", recursive=True)
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        done = []

        def close(topic):
            rows = held.pop(topic)
            size.pop(topic)
            name = f"{uuid.uuid4().hex}.parquet"
            table = pa.Table.from_pylist([dict(zip(self.names, r, strict=True)) for r in rows])
            with store.open_output_stream(f"{root}/data/{name}") as f:
                pq.write_table(table, f, compression="zstd")
            at = [r[self.names.index(GTID_SEQ)] for r in rows] if GTID_SEQ in self.names else []
            at = [x for x in at if x is not None]
            done.append({"topic": topic, "segment": name, "records": len(rows), "first": min(at, default=None), "last": max(at, default=None)})

        topic_at, value_at = self.names.index("topic"), self.names.index("value")
        for row in iterator:
            row = tuple(row)
            t = row[topic_at]
            held.setdefault(t, []).append(row)
            size[t] = size.get(t, 0) + len(row[value_at] or "") + 64
            if size[t] >= self.limit or sum(size.values()) >= 4 * self.limit:
                close(max(size, key=size.get))
        for t in list(held):
            close(t)
        return _Written(done)

    def commit(self, messages, batchId):
        store, root = _store(self.path)
        store.create_dir(f"{root}/manifest", recursive=True)
        segments = [s for m in messages if m is not None for s in m.segments]
        draft = f"{root}/manifest/.{batchId}.draft"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(segments).encode())
        store.move(draft, f"{root}/manifest/{batchId}.json")

    def abort(self, messages, batchId):
        """What was written stays unread; :func:`orphans` names it."""


class SegmentSink(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool):
        return _Writer(self.options["path"], schema.names, int(self.options.get("segmentbytes", SEGMENT_BYTES)))


def write_segments(records: DataFrame, path: str, checkpoint: str, available_now: bool = True, segment_bytes: int = SEGMENT_BYTES):
    """Start a streaming query that delivers ``records`` (topic, key, value and
    positions) into segments under ``path``."""
    records.sparkSession.dataSource.register(SegmentSink)
    order = [c for c in (GTID_SEQ, POS) if c in records.columns]
    dealt = records.repartition("topic", F.expr(f"{GTID_SEQ} div {RUN_WIDTH}")) if order else records.repartition("topic")
    w = dealt.writeStream.format(FORMAT).option("path", path).option("segmentBytes", str(segment_bytes)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """All committed segments."""
    from pyarrow import fs

    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(f"{root}/manifest", allow_not_found=True))
    out = []
    for f in sorted(found, key=lambda f: f.base_name):
        if f.base_name.endswith(".json"):
            with store.open_input_stream(f.path) as s:
                out += [{**x, "batch": int(f.base_name[:-5])} for x in json.loads(s.read())]
    return out


def read_segments(spark: SparkSession, path: str, schema: str, topic: str | None = None) -> DataFrame:
    """The committed records (of one topic)."""
    names = [s["segment"] for s in manifests(spark, path) if topic is None or s["topic"] == topic]
    reader = spark.read.schema(schema)
    return reader.parquet(*[f"{path}/data/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def orphans(spark: SparkSession, path: str) -> list[str]:
    """Segments that no manifest names (of killed batches); they can be deleted
    while no query writes."""
    from pyarrow import fs

    store, root = _store(path)
    known = {s["segment"] for s in manifests(spark, path)}
    found = store.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name not in known)
