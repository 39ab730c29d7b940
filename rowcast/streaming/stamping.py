"""S2 on a stream: row events get the last GTID marker before them in the log.

Non-time windows aren't allowed on streams, so the carry from file to file is
state.  Each file's events are stamped on their own, one key per log and file: an
event after a marker of its own file leaves at once, those before the file's first
marker wait.  What a file begins with comes from a small operator, one key per
log, that sees the last marker of each file alone (a row per file and task): it
keeps the end of the gapless beginning of the log (the last file up to which all
are known, and the last marker up to there) and the markers of files that came
early, and tells a file what it begins with once all files before it are known.
Files may arrive in any order; a file is known when it arrives, so each must
arrive in one micro-batch (a log file that is one data file does).  Events of a
file whose predecessors don't come leave after ``late``, as if the missing files
had no marker.

State is bounded by the files that came early; a file's events of one micro-batch
pass one task, and one log's files are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import GTID_SEQ, GTID_UUID
from rowcast.operators.codec import JSON_OPTIONS, TIME_FORMAT
from rowcast.streaming.stateful import ROCKSDB, _duration_ms

_OUT = "_row string, _uuid string, _seq string"
_BEGIN = "file bigint, uuid string, seq string"


def _last_markers(names: list[str]):
    """The last marker of each file among a task's entries, without one a row of nulls."""
    def run(batches):
        import pandas as pd

        last = {}
        for pdf in batches:
            for file, part in pdf.groupby([*names, "file"], sort=False, dropna=False):
                marked = part[part["seq"].notna()]
                now = None if marked.empty else marked.sort_values("at", kind="mergesort").iloc[-1]
                was = last.get(file)
                last[file] = now if was is None or (now is not None and now["at"] >= was["at"]) else was
        rows = [(*key, *((None, None, None) if m is None else (m["at"], m["uuid"], m["seq"]))) for key, m in last.items()]
        yield pd.DataFrame(rows, columns=[*names, "file", "at", "uuid", "seq"])
    return run


def _carrier(names: list[str], first: int, late_ms: int | None):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Carrier(StatefulProcessor):
        """Per log: what each file begins with, once it is known."""

        def init(self, handle):
            self.handle = handle
            self.done = handle.getValueState("done", _BEGIN)
            self.early = handle.getMapState("early", "file bigint", "uuid string, seq string, marked boolean")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            pdf = pd.concat(list(rows), ignore_index=True).sort_values(["file", "at"], kind="mergesort", na_position="first")
            new = pdf.drop_duplicates("file", keep="last")
            files = {int(f): (None, None, False) if s is None or s != s else (u, s, True)
                     for f, u, s in zip(new["file"], new["uuid"], new["seq"], strict=True)}
            yield self._advance(key, files, False)

        def _advance(self, key, files, skip):
            """Go on over known files; with ``skip`` also over missing ones."""
            import pandas as pd

            done = self.done.get() if self.done.exists() else (first - 1, None, None)
            early = {int(k[0]): tuple(v) for k, v in self.early.iterator()}
            for f in files:
                if f <= done[0] or f in early:
                    raise ValueError(f"log file {f} arrived in more than one micro-batch")
            known = early | files
            out, at, mark = [], int(done[0]), (done[1], done[2])
            for f in sorted(known):
                if not skip and f != at + 1:
                    break
                at = f
                out.append((*key, f, *mark))
                uuid, seq, marked = known.pop(f)
                if marked:
                    mark = (uuid, seq)
                if f in early:
                    self.early.removeKey((f,))
            self.done.update((at, *mark))
            for f in files.keys() & known.keys():
                self.early.updateValue((f,), files[f])
            if late_ms and known and not list(self.handle.listTimers()):
                import time

                self.handle.registerTimer(int(time.time() * 1000) + late_ms)
            return pd.DataFrame(out, columns=[*names, "file", "uuid", "seq"], dtype=object)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            yield self._advance(key, {}, True)

        def close(self):
            pass

    return Carrier()


def _stamper():
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Stamper(StatefulProcessor):
        """Per file: its events, and later or at once what it begins with."""

        def init(self, handle):
            self.waiting = handle.getListState("waiting", "row string")

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            pdf = pd.concat(list(rows), ignore_index=True)
            begins = pdf["row"].isna().to_numpy()
            begin = pdf[begins].iloc[0] if begins.any() else None
            pdf = pdf[~begins].sort_values("at", kind="mergesort")
            row, marked = pdf["row"].to_numpy(object), pdf["seq"].notna().to_numpy()
            last = np.maximum.accumulate(np.where(marked, np.arange(len(pdf)), -1))
            own = last >= 0
            out = [pd.DataFrame({"_row": row[own], "_uuid": pdf["uuid"].to_numpy(object)[last[own]],
                                 "_seq": pdf["seq"].to_numpy(object)[last[own]]}, dtype=object)]
            held = row[~own].tolist()
            if begin is not None:
                if not len(pdf) and self.waiting.exists():  # its events came in an earlier micro-batch
                    held = [x[0] for x in self.waiting.get()]
                    self.waiting.clear()
                out.append(pd.DataFrame({"_row": held, "_uuid": [begin["uuid"]] * len(held), "_seq": [begin["seq"]] * len(held)}, dtype=object))
            elif held:
                self.waiting.put([(x,) for x in held])
            yield pd.concat(out, ignore_index=True)

        def close(self):
            pass

    return Stamper()


def stamp_gtid_stream(log: DataFrame, file_no: Column | str = "log_file", pos_col: str = "pos", source: Sequence[str] = (),
                      first_file: int = 1, late: str | None = None) -> DataFrame:
    """:func:`rowcast.sources.changelog.stamp_gtid` for a streaming log.

    ``file_no`` is a file's number (by default the digits its name ends with);
    files are numbered one by one from ``first_file``.  ``source`` names the
    columns that tell several logs apart.  ``late`` ("10 minutes", processing
    time): how long events wait for missing files; without it for ever."""
    name = F.col(file_no) if isinstance(file_no, str) else file_no
    number = F.regexp_extract(name.cast("string"), r"(\d+)$", 1).cast("bigint")
    times = {**JSON_OPTIONS, "timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}
    # names as pandas can have them: a leading underscore gets lost on the way
    keys = [f"s{i}" for i in range(len(source))] or ["s"]
    source_keys = [F.col(c).alias(k) for c, k in zip(source, keys, strict=True)] if source else [F.lit(0).alias("s")]
    place = [*source_keys, number.alias("file"), F.col(pos_col).cast("bigint").alias("at")]
    # (numbers as text: pandas would make them floats beside nulls)
    marker = [F.col(GTID_UUID).alias("uuid"), F.col(GTID_SEQ).cast("bigint").cast("string").alias("seq")]
    log = log.where(number.isNotNull())
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    late_ms = _duration_ms(late) if late else None
    entries = log.select(*place, *marker)
    key_fields = [entries.schema[k] for k in keys]
    begins = entries.mapInPandas(_last_markers(keys), entries.schema).groupBy(*keys).transformWithStateInPandas(
        _carrier(keys, first_file, late_ms), T.StructType(key_fields + list(T._parse_datatype_string(_BEGIN).fields)), "append",
        "ProcessingTime" if late else "None")
    packed = log.select(*place, *marker, F.to_json(F.struct(*log.columns), times).alias("row"))
    both = packed.unionByName(begins, allowMissingColumns=True)
    res = both.groupBy(*keys, "file").transformWithStateInPandas(_stamper(), _OUT, "append", "None")
    whole = res.withColumn("_r", F.from_json("_row", T.StructType(list(log.schema.fields)), times))
    marks = {GTID_UUID: F.col("_uuid"), GTID_SEQ: F.col("_seq").cast(log.schema[GTID_SEQ].dataType)}
    return whole.select(*[marks[c].alias(c) if c in marks else F.col("_r")[c].alias(c) for c in log.columns])
