"""Rule-local state across events.

Upstream keeps one script runtime per rule, so script globals live as long
as the pipeline.  Here state is kept **per key** (a stated deviation: a
single global state would force every event through one task).

* In a rule chain: a :class:`StatefulRule` may stand among the rules of a
  ``PipelineSpec``.  Its guard, verdict and edits work like those of any other
  rule (:func:`apply_state_rule`); events that it doesn't match pass by.  On a
  stream the chain up to the last stateful rule runs on the stream itself with
  ``transformWithState``: keys are dealt into groups, of which each is one call in
  a micro-batch, and a group's state is a map state with an entry per key, so only
  keys with events are read and only what a call changed is written, with a TTL and
  a start from a batch frame.
* As expressions: a :class:`WindowRule` declares running numbers, sums, maxima and
  previous values, which its verdict and edits read as columns.  It has no
  function, so a hot key is cut by position (batch).
* On any frame: :func:`apply_stateful_rule` adds what the state says after each
  event.
* Batch: running counts and sums per key use the bucketed window operators
  (:func:`running_totals`), which stay balanced when one key is huge.

Order: a call sees a key's events of one micro-batch sorted by ``order``, and
micro-batches follow the order in which files arrive, so a log that is written
in source order reaches the state in source order.  One key's events of one
micro-batch (and those of the other keys of its group) are held at once; the
trigger's file limit bounds them.  In batch a
key's events pass one task in order (the function needs them so) and only the
state is held.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import ACTION_CONT, ACTION_DROP, ENVELOPE_FIELDS, GTID_SEQ, POS, VERDICT_COL
from rowcast.operators.codec import JSON_OPTIONS, TIME_FORMAT
from rowcast.operators.ordered import DEFAULT_BUCKET_WIDTH, keyed_windows
from rowcast.operators.pyrule import call_rule, checked_verdict, encoded, written_back
from rowcast.operators.rules import matches


#: State store that transformWithState needs (set for the session's next queries).
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def running_totals(events: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = (GTID_SEQ, POS),
                   count_name: str = "seen", sum_name: str = "running_total",
                   width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Batch: per key, events seen so far and the running sum of ``value``."""
    return keyed_windows(events, keys, order, number=count_name, sums={sum_name: value}, width=width)


@dataclass
class StatefulRule:
    """``fn(event: dict, state: dict) -> verdict``; ``state`` is mutable and
    persists per key across micro-batches (JSON-serialisable values).  ``keys``
    are columns or fields such as ``kafka.key``."""

    name: str
    keys: Sequence[str]
    fn: Callable[[dict, dict], int]
    output: Sequence[tuple[str, str]] = field(default_factory=list)  # extra (name, ddl type) from the state
    match_schema: str = ""
    match_table: str = ""
    #: Streams: a name that isn't written for so long ("24 hours") is forgotten
    #: (processing time; the session's micro-batches without data are turned off,
    #: as they would never end an ``availableNow`` run), or with ``event_time``, a
    #: timestamp column, the whole state of a key without events for so long once
    #: the watermark has passed.
    ttl: str | None = None
    event_time: str | None = None
    watermark: str = "0 seconds"
    #: Streams: a batch frame with the key columns (named as ``keys``, or their
    #: last part) and a column per name of the state, for keys that begin with one.
    initial: DataFrame | None = None

    def __post_init__(self):
        if self.event_time and not self.ttl:
            raise ValueError(f"stateful rule {self.name!r}: event_time needs a ttl")

    def guard(self):
        return matches("schema", self.match_schema) & matches("table", self.match_table)


@dataclass
class WindowRule:
    """A stateful rule that is all expressions: per key, in order, the columns
    ``number`` (1, 2, ...), ``sums``, ``maxes`` and ``lags`` (previous values; all
    ``{new column: SQL over the event}``) are computed over the events the guard
    matches, then ``verdict`` and ``set`` work as in a :class:`Rule` and may read
    them.  They stay as columns (null where the rule doesn't match).  Batch only."""

    name: str
    keys: Sequence[str]
    number: str | None = None
    sums: Mapping[str, str] = field(default_factory=dict)
    maxes: Mapping[str, str] = field(default_factory=dict)
    lags: Mapping[str, str] = field(default_factory=dict)
    verdict: object = None
    set: Mapping = field(default_factory=dict)
    match_schema: str = ""
    match_table: str = ""

    def guard(self):
        return matches("schema", self.match_schema) & matches("table", self.match_table)


def apply_window_rule(df: DataFrame, rule: WindowRule, on_null_verdict: str = "fail",
                      order: Sequence[str] = (GTID_SEQ, POS), width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """One window rule over events that carry ``_verdict``; nothing is removed."""
    from rowcast.operators.rules import Rule, apply_rule

    if df.isStreaming:
        raise TypeError(f"window rule {rule.name!r}: batch only; use a StatefulRule on a stream")
    columns = [c for c in df.columns if c != VERDICT_COL]
    active = rule.guard() & (F.col(VERDICT_COL) != ACTION_DROP)
    inputs = {f"_w{i}": F.expr(x) for i, x in enumerate([*rule.sums.values(), *rule.maxes.values(), *rule.lags.values()])}
    keys = {f"_k{i}": F.col(k) for i, k in enumerate(rule.keys)}
    names = iter(inputs)
    per = {kind: {n: next(names) for n in getattr(rule, kind)} for kind in ("sums", "maxes", "lags")}
    hit = keyed_windows(df.filter(active).withColumns(keys | inputs), list(keys), list(order), number=rule.number, width=width, **per)
    made = [c for c in (rule.number, *rule.sums, *rule.maxes, *rule.lags) if c]
    hit = apply_rule(hit.select(*columns, *made, VERDICT_COL), Rule(rule.name, verdict=rule.verdict, set=rule.set), on_null_verdict,
                     short_circuit=False)
    by = df.filter(~active).select(
        *columns, *[F.lit(None).cast(hit.schema[c].dataType).alias(c) for c in made],
        F.when(F.col(VERDICT_COL) == ACTION_DROP, ACTION_DROP).otherwise(ACTION_CONT).alias(VERDICT_COL))
    return hit.select(by.columns).unionByName(by)


#: Keys are dealt into so many groups, of which each is one call of the processor
#: in a micro-batch that has events for it.
KEY_GROUPS = 4096


def _frame(rows: list[tuple], names: Sequence[str]):
    """Rows as a frame; numbers beside nulls stay as they are."""
    import pandas as pd

    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pd.DataFrame({n: pd.Series(c, dtype=object if not c or None in c else None) for n, c in zip(names, columns, strict=True)})


def _processor(rule: StatefulRule, names: list[str], at: list[str], rows_of):
    """The rule as a StatefulProcessor; ``rows_of(rows, events, state)`` calls it
    with one key's."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    ttl_ms = _duration_ms(rule.ttl) if rule.ttl else None
    by_event = rule.event_time is not None

    class Processor(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.state = handle.getMapState("state", "key string", "value string", None if by_event else ttl_ms)
            self.idle = handle.getMapState("idle", "key string", "until bigint") if by_event else None

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            pdf = pd.concat(list(rows), ignore_index=True).sort_values(["key", *at], kind="mergesort")
            keys, row, evt = pdf["key"].tolist(), pdf["row"].tolist(), pdf["evt"].tolist()
            cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
            out = []
            for i, j in zip(cuts, cuts[1:], strict=False):
                was = self.state.getValue((keys[i],))
                was = None if was is None else was[0]
                now = json.loads(was) if was else {}
                out += rows_of(row[i:j], evt[i:j], now)
                text = json.dumps(now) if now else None
                if text is None:
                    if was is not None:
                        self.state.removeKey((keys[i],))
                elif text != was or (ttl_ms and not by_event):  # a write starts the TTL anew
                    self.state.updateValue((keys[i],), (text,))
            if by_event:
                self._note(pdf.groupby("key")["event_ms"].max())
            yield _frame(out, names)

        def _note(self, latest):
            """The time each key is idle from; the group's one timer is the first of them."""
            until = {k: int(ms) + ttl_ms for k, ms in latest.items()}
            for k, t in until.items():
                last = self.idle.getValue((k,))
                if last is None or t > last[0]:
                    self.idle.updateValue((k,), (t,))
            timers = list(self.handle.listTimers())
            first = min([*until.values(), *timers])
            if first not in timers:
                for t in timers:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(first)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now, left = expiredTimerInfo.getExpiryTimeInMs(), []
            now = max(now, timerValues.getCurrentWatermarkInMs())
            for (k,), (t,) in list(self.idle.iterator()):
                if t <= now:
                    self.state.removeKey((k,))
                    self.idle.removeKey((k,))
                else:
                    left.append(t)
            if left:
                self.handle.registerTimer(min(left))
            yield _frame([], names)

        def handleInitialState(self, key, initialState, timerValues):
            for k, text in zip(initialState["key"], initialState["state"], strict=True):
                if text != "{}" and self.state.getValue((k,)) is None:
                    self.state.updateValue((k,), (text,))

        def close(self):
            pass

    return Processor()


def apply_stateful_rule(events: DataFrame, rule: StatefulRule, order: Sequence[str] = (GTID_SEQ, POS),
                        state_ttl: str | None = None, event_time: str | None = None,
                        watermark: str = "0 seconds", on_null_verdict: str = "fail") -> DataFrame:
    """Streaming (or batch) per-key state with ``applyInPandasWithState``.

    Input columns are passed to ``fn`` as a dict per event (images as lists of
    dicts).  Output: the input's scalar columns listed in ``keys`` and
    ``order``, the verdict, and the ``rule.output`` fields read from the state
    after each event.  As at the end of a chain, only events with verdict 0 are
    kept; a null verdict follows ``on_null_verdict``.

    ``state_ttl`` with ``event_time`` (a timestamp column): a key's state is
    removed once the watermark (``event_time`` minus ``watermark``) passes the
    key's last event time plus the TTL, so the state store holds the active
    keys only instead of every key ever seen.  Event time, not processing
    time, so that ``availableNow`` runs still finish and results do not
    depend on when batches run.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    if state_ttl and not event_time:
        raise ValueError("state_ttl needs an event_time column")
    ttl_ms = _duration_ms(state_ttl) if state_ttl else None
    if ttl_ms:
        events = events.withWatermark(event_time, watermark)
    keys, order = list(rule.keys), list(order)
    payload_cols = [c for c in events.columns if c not in keys and c not in order]
    # the watermarked column itself must reach the stateful operator
    ev_ms = ([F.col(event_time), F.unix_millis(F.col(event_time).cast("timestamp")).alias("_event_ms")]
             if ttl_ms else [])
    packed = events.select(*keys, *order, F.to_json(F.struct(*payload_cols), JSON_OPTIONS).alias("_evt"), *ev_ms)
    out_fields = ([packed.schema[c] for c in keys + order] + [T.StructField("_verdict", T.IntegerType())]
                  + [T.StructField(n, T._parse_datatype_string(t)) for n, t in rule.output])
    out_schema = T.StructType(out_fields)
    state_schema = T.StructType([T.StructField("state_json", T.StringType())])
    fn, extra = rule.fn, [n for n, _ in rule.output]

    def run(key, pdfs, state):
        import pandas as pd

        if state.hasTimedOut:           # idle longer than the TTL: forget the key
            state.remove()
            return
        st = json.loads(state.get[0]) if state.exists else {}
        # one key's events of one micro-batch (bounded by the trigger), in source order
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(order, kind="mergesort")
        verdicts, extras = [], {n: [] for n in extra}
        for evt in pdf["_evt"]:
            e = json.loads(evt)
            verdicts.append(checked_verdict(fn(e, st), on_null_verdict, rule.name))
            for n in extra:
                extras[n].append(st.get(n))
        out = pdf[keys + order].copy()
        out["_verdict"] = verdicts
        for n in extra:
            out[n] = extras[n]
        state.update((json.dumps(st),))
        if ttl_ms:
            state.setTimeoutTimestamp(int(pdf["_event_ms"].max()) + ttl_ms)
        yield out

    timeout = GroupStateTimeout.EventTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    res = packed.groupBy(*keys).applyInPandasWithState(run, out_schema, state_schema, "append", timeout)
    return res.filter(F.col("_verdict") == ACTION_CONT)


def apply_state_rule(df: DataFrame, rule: StatefulRule, on_null_verdict: str = "fail",
                     order: Sequence[str] = (GTID_SEQ, POS)) -> DataFrame:
    """One stateful rule over events that carry ``_verdict``; nothing is removed.

    Dropped events and those the guard doesn't match pass by; matched ones reach
    the function as the payload's dict, in ``order`` per key, and come back with
    its edits, its verdict and the ``rule.output`` fields as columns.  The whole
    row travels as JSON text beside the payload and unchanged fields are read
    back from it with the frame's schema.
    """
    columns = [c for c in df.columns if c != VERDICT_COL]
    if df.isStreaming and rule.event_time:
        df = df.withWatermark(rule.event_time, rule.watermark)
    active = rule.guard() & (F.col(VERDICT_COL) != ACTION_DROP)
    by = df.filter(~active).select(
        *columns, F.when(F.col(VERDICT_COL) == ACTION_DROP, ACTION_DROP).otherwise(ACTION_CONT).alias(VERDICT_COL),
        *[F.lit(None).cast(t).alias(n) for n, t in rule.output])
    hit = df.filter(active)
    times = {**JSON_OPTIONS, "timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}
    # (names as pandas can have them: a leading underscore gets lost on the way to a StatefulProcessor)
    keys, at = [f"k{i}" for i in range(len(rule.keys))], [f"o{i}" for i in range(len(order))]
    packed = hit.select(*[F.col(k).alias(n) for k, n in zip(rule.keys, keys, strict=True)],
                        *[F.col(o).alias(n) for o, n in zip(order, at, strict=True)],
                        F.to_json(F.struct(*columns), times).alias("row"), encoded(hit).alias("evt"),
                        *([F.col(rule.event_time).alias("event_time"), F.unix_millis(F.col(rule.event_time)).alias("event_ms")]
                          if df.isStreaming and rule.event_time else []))
    out_schema = T.StructType([T.StructField("_row", T.StringType())]
                              + [T.StructField(f"_out_{f}", T.StringType()) for f in ENVELOPE_FIELDS]
                              + [T.StructField(VERDICT_COL, T.IntegerType())]
                              + [T.StructField(n, T._parse_datatype_string(t)) for n, t in rule.output])

    fn, rule_name, told = rule.fn, rule.name, [n for n, _ in rule.output]  # the rule itself may hold a frame

    def rows_of(rows, events, st):
        out = []
        for row, text in zip(rows, events, strict=True):
            verdict, changed = call_rule(lambda e: fn(e, st), text, on_null_verdict, rule_name)
            out.append((row, *[changed.get(f) for f in ENVELOPE_FIELDS], verdict, *[st.get(n) for n in told]))
        return out

    def run_sorted(pdfs):
        """Batch: a key's rows come one after the other; only its state is held."""
        last, st = None, {}
        for pdf in pdfs:
            codes = list(pdf[keys].itertuples(index=False, name=None))
            row, evt = pdf["row"].tolist(), pdf["evt"].tolist()
            cuts = [i for i in range(len(codes)) if not i or codes[i] != codes[i - 1]] + [len(codes)]
            out = []
            for i, j in zip(cuts, cuts[1:], strict=False):
                if codes[i] != last:
                    last, st = codes[i], {}
                out += rows_of(row[i:j], evt[i:j], st)
            yield _frame(out, out_schema.names)

    if df.isStreaming:
        df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        key = F.to_json(F.struct(*keys), JSON_OPTIONS).alias("key")

        def dealt(frame):
            return frame.withColumn("g", F.pmod(F.xxhash64("key"), F.lit(KEY_GROUPS)).cast("int")).groupBy("g")

        start = None
        if rule.initial is not None:
            last = {k: k.rsplit(".", 1)[-1] for k in rule.keys}
            names = [c for c in rule.initial.columns if c not in rule.keys and c not in last.values()]
            start = rule.initial.select(
                *[F.col(k if k in rule.initial.columns else last[k]).cast(packed.schema[n].dataType).alias(n)
                  for k, n in zip(rule.keys, keys, strict=True)], (F.to_json(F.struct(*names)) if names else F.lit("{}")).alias("state"))
            start = dealt(start.select(key, "state"))
        mode = "EventTime" if rule.event_time else "ProcessingTime" if rule.ttl else "None"
        if mode == "ProcessingTime":
            df.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        res = dealt(packed.withColumn("key", key).drop(*keys)).transformWithStateInPandas(
            _processor(rule, out_schema.names, at, rows_of), out_schema, "append", mode, initialState=start)
    else:
        res = packed.repartition(*keys).sortWithinPartitions(*keys, *at).mapInPandas(run_sorted, out_schema)
    whole = res.withColumn("_r", F.from_json("_row", T.StructType([df.schema[c] for c in columns]), times))
    flat = whole.select(*[F.col("_r")[c].alias(c) for c in columns],
                        *[c for c in out_schema.names if c != "_row"])
    back, _ = written_back({f: df.schema[f].dataType for f in ENVELOPE_FIELDS})
    done = flat.select(*[back[c].alias(c) if c in back else F.col(c) for c in columns], VERDICT_COL, *[n for n, _ in rule.output])
    return done.unionByName(by)


def _duration_ms(text: str) -> int:
    """``"90 seconds"``, ``"15 minutes"``, ``"24 hours"``, ``"7 days"`` -> milliseconds."""
    n, unit = text.strip().split(None, 1)
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    u = unit.strip().lower().rstrip("s")
    if u not in scale:
        raise ValueError(f"unknown duration unit in {text!r}")
    return int(float(n) * scale[u])
