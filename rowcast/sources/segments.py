"""A change log of files as a Python data source with positions as offsets.

The log is a folder of Parquet segments whose paths ascend in log order (binlog
files copied one by one, or ``log_file=.../`` folders).  Format ``rowcast_log``:

* **batch**: partitions are the segments' row groups, planned from their footers;
  row groups that can't hold a row after the start position, or that a pushed
  filter on a column with statistics excludes, aren't read;
* **stream**: an offset is ``{"file", "pos", "uuid", "seq"}``: the last segment
  planned, and the last position and GTID in it.  A checkpoint resumes from it as
  with any source; a *new* query starts after a position with the option
  ``start`` (an offset as JSON text, for example one that was saved with the
  records), so nothing is read twice and nothing is lost when a checkpoint is gone.

Segments are read where they lie by pyarrow's file systems (file, s3, gs, hdfs),
never on the driver; the driver reads footers, several at a time.  A segment must
be complete when it appears (written elsewhere and renamed, as Spark does).
"""

from __future__ import annotations

import json
import operator
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from rowcast.model import GTID_SEQ, GTID_UUID, POS

FORMAT = "rowcast_log"
#: Footers read at a time.
THREADS = 16


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _listed(path: str) -> list[str]:
    """The segments' paths below the folder, in log order."""
    from pyarrow import fs

    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [f.path[len(root):].lstrip("/") for f in found if f.type == fs.FileType.File and f.size]
    return sorted(n for n in names if n.endswith(".parquet") and not any(p[0] in "._" for p in n.split("/")))


@dataclass
class Group(ds.InputPartition):
    """A row group, and the position in its segment after which rows count."""

    path: str
    file: str
    group: int
    after: int | None
    wanted: tuple = ()

    def __init__(self, path, file, group, after, wanted=()):
        self.path, self.file, self.group, self.after, self.wanted = path, file, group, after, wanted


class Footer:
    """Row groups of a segment with the least and greatest of their columns."""

    def __init__(self, path: str, file: str):
        import pyarrow.parquet as pq

        store, root = _store(path)
        with store.open_input_file(f"{root}/{file}") as f:
            meta = pq.read_metadata(f)
        self.file, self.groups = file, []
        for g in range(meta.num_row_groups):
            row, stats = meta.row_group(g), {}
            for c in range(row.num_columns):
                col = row.column(c)
                s = col.statistics
                if s is not None and s.has_min_max and "." not in col.path_in_schema:
                    stats[col.path_in_schema] = (s.min, s.max)
            self.groups.append((row.num_rows, stats))

    @property
    def last(self) -> int | None:
        """The greatest position, if the statistics say it."""
        tops = [s[POS][1] for n, s in self.groups if n and POS in s]
        return max(tops) if tops and len(tops) == sum(1 for n, _ in self.groups if n) else None


def _footers(path: str, files: Sequence[str]) -> list[Footer]:
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(lambda f: Footer(path, f), files))


_COMPARE = {ds.GreaterThan: (operator.gt, 1), ds.GreaterThanOrEqual: (operator.ge, 1), ds.LessThan: (operator.lt, 0),
            ds.LessThanOrEqual: (operator.le, 0)}


def _may_hold(stats: dict, wanted: Sequence[tuple]) -> bool:
    """False if the statistics rule out that a row satisfies all of ``wanted``
    (column, kind, value)."""
    for column, kind, value in wanted:
        if column not in stats:
            continue
        lo, hi = stats[column]
        try:
            if kind is ds.EqualTo:
                if not lo <= value <= hi:
                    return False
            elif not _COMPARE[kind][0](hi if _COMPARE[kind][1] else lo, value):
                return False
        except TypeError:
            continue
    return True


def _groups(path: str, files: Sequence[str], after: dict | None, wanted: Sequence[tuple] = ()) -> list[Group]:
    out = []
    for f in _footers(path, files):
        since = after["pos"] if after and after.get("file") == f.file else None
        for g, (n, stats) in enumerate(f.groups):
            if not n or (since is not None and POS in stats and stats[POS][1] <= since) or not _may_hold(stats, wanted):
                continue
            out.append(Group(path, f.file, g, since, tuple(wanted)))
    return out


def _read(part: Group, names: list[str]) -> Iterator:
    """A row group's rows as record batches, folder columns included."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    store, root = _store(part.path)
    folders = dict(p.split("=", 1) for p in part.file.split("/")[:-1] if "=" in p)
    with store.open_input_file(f"{root}/{part.file}") as f:
        file = pq.ParquetFile(f)
        own = [n for n in names if n in file.schema_arrow.names]
        more = [POS] if part.after is not None and POS not in own else []
        for b in file.iter_batches(row_groups=[part.group], columns=own + more, batch_size=8192):
            t = pa.Table.from_batches([b])
            if part.after is not None:
                t = t.filter(pc.greater(t.column(POS), part.after))
            for column, kind, value in part.wanted:
                if column in t.column_names:
                    test = pc.equal if kind is ds.EqualTo else getattr(pc, {
                        ds.GreaterThan: "greater", ds.GreaterThanOrEqual: "greater_equal", ds.LessThan: "less",
                        ds.LessThanOrEqual: "less_equal"}[kind])
                    t = t.filter(test(t.column(column), value))
            cols = [t.column(n) if n in own else pa.chunked_array([pa.array([folders.get(n)] * t.num_rows, pa.string())]) for n in names]
            yield from pa.table(cols, names=names).combine_chunks().to_batches()


def _start(options) -> dict | None:
    text = options.get("start")
    return json.loads(text) if text else None


class _Batch(ds.DataSourceReader):
    def __init__(self, path: str, schema: StructType, start: dict | None):
        self.path, self.names, self.start, self.wanted = path, schema.names, start, []

    def pushFilters(self, filters):
        for f in filters:
            kind = type(f)
            if (kind in _COMPARE or kind is ds.EqualTo) and len(f.attribute) == 1 and type(f.value) in (int, str, float):
                self.wanted.append((f.attribute[0], kind, f.value))
            yield f  # Spark tests them again: folder columns and nulls are its own

    def partitions(self):
        files = _listed(self.path)
        if self.start:
            files = [f for f in files if f >= self.start["file"]]
        return _groups(self.path, files, self.start, self.wanted) or [Group(self.path, "", -1, None)]

    def read(self, partition):
        if partition.group < 0:
            return iter(())
        return _read(partition, self.names)


class _Stream(ds.DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType, start: dict | None, limit: int):
        self.path, self.names, self.start, self.limit = path, schema.names, start, limit
        self.planned: dict | None = None

    def initialOffset(self) -> dict:
        self.planned = self.start or {"file": "", "pos": -1, "uuid": "", "seq": -1}
        return self.planned

    def latestOffset(self) -> dict:
        """The end of the last segment of the next batch.  A query that goes on
        from a checkpoint isn't told here where it stands, so its first batch takes
        all there is; the others take ``segmentsPerTrigger``."""
        files = [f for f in _listed(self.path) if self.planned is None or f > self.planned["file"]]
        if self.planned is not None and self.limit:
            files = files[:self.limit]
        if files:
            foot = Footer(self.path, files[-1])
            top = [s for n, s in foot.groups if n]
            seq = [s[GTID_SEQ][1] for s in top if GTID_SEQ in s]
            uuid = [s[GTID_UUID][1] for s in top if GTID_UUID in s]
            last = foot.last
            self.planned = {"file": files[-1], "pos": -1 if last is None else last, "uuid": uuid[-1] if uuid else "",
                            "seq": max(seq) if seq else -1}
        return self.planned or {"file": "", "pos": -1, "uuid": "", "seq": -1}

    def partitions(self, start: dict, end: dict):
        files = [f for f in _listed(self.path) if start["file"] <= f <= end["file"]]
        # a start within a segment (a saved position) reads what follows in it
        return _groups(self.path, [f for f in files if f > start["file"]], None) + (
            _groups(self.path, [start["file"]], start) if start["file"] in files and start["pos"] >= 0 else [])

    def read(self, partition):
        return _read(partition, self.names)


class ChangeLogSource(ds.DataSource):
    """``spark.read`` / ``spark.readStream`` ``.format("rowcast_log")`` with the
    options ``path``, ``start`` and ``segmentsPerTrigger`` (0: no limit)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        files = _listed(self.options["path"])
        if not files:
            raise ValueError(f"no segments in {self.options['path']}; give a schema")
        store, root = _store(self.options["path"])
        with store.open_input_file(f"{root}/{files[0]}") as f:
            found = from_arrow_schema(pq.read_schema(f))
        for part in files[0].split("/")[:-1]:
            if "=" in part and part.split("=", 1)[0] not in found.names:
                found = found.add(part.split("=", 1)[0], "string")
        return found

    def reader(self, schema: StructType):
        return _Batch(self.options["path"], schema, _start(self.options))

    def streamReader(self, schema: StructType):
        return _Stream(self.options["path"], schema, _start(self.options), int(self.options.get("segmentspertrigger", "0")))


def _options(path: str, start: dict | None, **more) -> dict:
    return {"path": path, **({"start": json.dumps(start)} if start else {}), **{k: str(v) for k, v in more.items()}}


def read_segments(spark: SparkSession, path: str, schema: StructType | str | None = None, start: dict | None = None) -> DataFrame:
    """S1/S4 (batch): a log of segments, from a position on."""
    spark.dataSource.register(ChangeLogSource)
    r = spark.read.format(FORMAT).options(**_options(path, start))
    return (r.schema(schema) if schema is not None else r).load()


def stream_segments(spark: SparkSession, path: str, schema: StructType | str, start: dict | None = None,
                    segments_per_trigger: int = 0) -> DataFrame:
    """S1/S4 (stream): new segments of a log, after a position for a new query."""
    spark.dataSource.register(ChangeLogSource)
    return spark.readStream.format(FORMAT).schema(schema).options(
        **_options(path, start, segmentsPerTrigger=segments_per_trigger)).load()


def reached(progress) -> dict | None:
    """The position of a query's progress (``query.lastProgress``): what a query
    without its checkpoint starts from."""
    if not progress:
        return None
    whole = json.loads(progress.json) if hasattr(progress, "json") else progress
    end = whole["sources"][0]["endOffset"]
    return json.loads(end) if isinstance(end, str) else end
