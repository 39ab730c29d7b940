"""Position tracking: save, load, resume, sanity checks.

A state holds everything processed so far; a save merges its batch with the state
before, so batches may come in any order, an empty batch keeps the position and a
change of server keeps the old server's.  There are two forms, and every reader
here takes both:

* **bitmap rows** (:func:`state_bitmaps`, :mod:`rowcast.operators.bitmaps`): of any
  size, merged by a bitwise or, tested by an equi-join and one bit.  Streams save
  these, as deltas (:mod:`rowcast.streaming.statelog`).
* **texts**: rows ``(name, gtid, timestamp, tail)`` with the pipeline's name, a
  GTID-set text, the save time in microseconds and, per uuid, the last row event
  processed (:func:`state_from_batch`, for up to ``MAX_TEXT`` intervals).  A state
  table of texts is append-only; the latest row per name wins.

A text without ``tail`` is upstream's: one ``uuid:N`` there means that all up to N
is done.  With ``tail`` the intervals are exact.

Resuming from texts joins events to the saved intervals on ``(pipeline, uuid,
bucket of the sequence number)``, so one source server never means one join key.
Whole coarse buckets are equi-joined; what is left of an interval at its ends is
compared within fine buckets.  Both sides are tables in the shared folder, so
Spark knows their size and broadcasts them only when they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.functions.gtid import parse_gtid_set, widen_single
from rowcast.model import GTID_SEQ, GTID_UUID, POS
from rowcast.operators import bitmaps
from rowcast.session import save_shared

COARSE, FINE = 1 << 20, 1 << 10

#: Intervals of one pipeline up to which its state is written as a text (about 80 MB).
MAX_TEXT = 1 << 22


def _now(timestamp: Column | None) -> Column:
    return timestamp if timestamp is not None else F.unix_micros(F.current_timestamp())


def as_bitmaps(states: DataFrame) -> DataFrame:
    """The latest state per pipeline as bitmap rows, whichever form it has."""
    if "bits" in states.columns:
        return _latest_rows(states)
    low, high = bitmaps.bitmaps_of(saved_ranges(states))
    none = F.lit(None).cast(bitmaps.TAIL)
    rows = [low.select("name", "uuid", F.lit(0).alias("level"), "bucket", "bits", none.alias("tail")),
            high.select("name", "uuid", F.lit(1).alias("level"), "bucket", "bits", none.alias("tail"))]
    if "tail" in states.columns:
        tail = F.struct(F.col("_ts").alias("seq"), F.col("_tp").alias("pos"))
        rows.append(_tails(states).select(F.col("_tn").alias("name"), F.col("_tu").alias("uuid"), F.lit(2).alias("level"),
                                          F.lit(0).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits"), tail.alias("tail")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("name", "uuid", "level", "bucket", "bits", "tail.seq", "tail.pos", F.lit(0).cast("bigint").alias("n"))


def state_bitmaps(processed: DataFrame, pipeline: str | Column = "pipeline", timestamp: Column | None = None,
                  previous: DataFrame | None = None) -> DataFrame:
    """P1 as bitmap rows: everything of ``previous`` (a state of either form) and
    what this batch processed, dropped events included."""
    p = F.col(pipeline) if isinstance(pipeline, str) else pipeline
    return bitmaps.added(processed, p, _now(timestamp), None if previous is None else as_bitmaps(previous))


def state_text(rows: DataFrame) -> DataFrame:
    """The rows of :func:`state_bitmaps` as one row ``(name, gtid, timestamp, tail,
    n_events)`` per pipeline, its intervals in one text.  A pipeline with more than
    ``MAX_TEXT`` intervals is an error: its state stays rows."""
    return bitmaps.texts(rows, MAX_TEXT)


def state_from_batch(processed: DataFrame, pipeline: str | Column = "pipeline", timestamp: Column | None = None,
                     previous: DataFrame | None = None) -> DataFrame:
    """One state row per pipeline: ``previous`` (a state table) and what
    this batch processed, dropped events included.

    Events become bitmap rows in one partial aggregate; only these meet to make a
    pipeline's one text.  ``tail`` keeps, per uuid, the last ``(seq, pos)``
    processed, so that ``resume_filter(exact=True)`` can finish a transaction that
    a batch boundary split.  ``n_events`` counts this batch's events.  Events
    without a position are left out.
    """
    return state_text(state_bitmaps(processed, pipeline, timestamp, previous))


def latest_state(states: DataFrame) -> DataFrame:
    """The newest state row per pipeline; ties go to the later micro-batch
    (``batch`` column when present), then to the gtid text.  A ``tail``
    column, when present, comes along."""
    order = [F.col("timestamp")] + ([F.col("batch")] if "batch" in states.columns else []) + [F.col("gtid")]
    keep = ["gtid", "timestamp"] + (["tail"] if "tail" in states.columns else [])
    return (states.groupBy("name")
            .agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("s"))
            .select("name", *[f"s.{c}" for c in keep]))


def saved_ranges(states: DataFrame, start: int = 1) -> DataFrame:
    """Latest state per pipeline as rows ``(name, uuid, lo, hi)``; upstream's
    single saved ``uuid:N`` (no ``tail``) is widened to ``uuid:start-N``.  Bitmap
    rows are decoded; their intervals end at the rows' edges."""
    if "bits" in states.columns:
        return bitmaps.decoded(_latest_rows(states)).where("lo is not null").select("name", "uuid", "lo", "hi")
    latest = latest_state(states)
    parsed = parse_gtid_set("gtid")
    own = F.when(F.col("tail").isNotNull(), parsed).otherwise(widen_single(parsed, start)) if "tail" in latest.columns \
        else widen_single(parsed, start)
    return latest.select("name", F.explode(own).alias("r")).select("name", "r.uuid", "r.lo", "r.hi")


def _latest_rows(states: DataFrame) -> DataFrame:
    """The rows of the newest save per pipeline; of saves with one timestamp, all."""
    last = states.groupBy("name").agg(F.max("timestamp").alias("_lt")).withColumnRenamed("name", "_ln")
    return states.join(last, states["name"].eqNullSafe(last["_ln"]) & (states["timestamp"] == last["_lt"]), "left_semi")


def _tails(states: DataFrame) -> DataFrame:
    """Latest state's last processed (seq, pos) per (pipeline, uuid)."""
    if "bits" in states.columns:
        last = _latest_rows(states).where("seq is not null").groupBy("name", "uuid").agg(F.max(F.struct("seq", "pos")).alias("t"))
        return last.select(F.col("name").alias("_tn"), F.col("uuid").alias("_tu"), F.col("t.seq").alias("_ts"), F.col("t.pos").alias("_tp"))
    return (latest_state(states).select("name", F.explode("tail").alias("t"))
            .select(F.col("name").alias("_tn"), F.lower("t.uuid").alias("_tu"), F.col("t.seq").alias("_ts"),
                    F.col("t.pos").alias("_tp")))


def _bucketed(ranges: DataFrame, coarse: int, fine: int) -> tuple[DataFrame, DataFrame]:
    """(whole coarse buckets, pieces in fine buckets) of the intervals."""
    r = ranges.withColumns({"c0": F.expr(f"(lo + {coarse - 1}) div {coarse}"), "c1": F.expr(f"(hi + 1) div {coarse} - 1")})
    whole = r.where("c0 <= c1").select(F.col("name").alias("_n"), F.col("uuid").alias("_u"),
                                       F.explode(F.sequence("c0", "c1")).alias("_c")).distinct()
    piece = F.when(F.col("c0") > F.col("c1"), F.array(F.struct(F.col("lo").alias("x"), F.col("hi").alias("y")))).otherwise(F.array(
        F.struct(F.col("lo").alias("x"), (F.col("c0") * coarse - 1).alias("y")),
        F.struct(((F.col("c1") + 1) * coarse).alias("x"), F.col("hi").alias("y"))))
    parts = r.select("name", "uuid", F.explode(piece).alias("p")).where("p.x <= p.y").select("name", "uuid", "p.x", "p.y")
    fines = parts.select(F.col("name").alias("_n"), F.col("uuid").alias("_u"),
                         F.explode(F.sequence(F.expr(f"x div {fine}"), F.expr(f"y div {fine}"))).alias("_f"), "x", "y")
    return save_shared(whole, "resume-whole"), save_shared(fines.toDF("_n", "_u", "_f", "_x", "_y"), "resume-pieces")


def resume_filter(events: DataFrame, states: DataFrame, pipeline: str | Column = "pipeline", start: int = 1,
                  exact: bool = False, coarse: int = COARSE, fine: int = FINE) -> DataFrame:
    """Drop the events already inside the saved position of their pipeline.

    Two left-anti joins on ``(pipeline, uuid, bucket)``; an event meets one bitmap
    (bitmap rows) or at most the pieces of one fine bucket (texts).
    ``exact=True`` (states saved here, not upstream's): events of the last saved transaction
    that lie after the last saved position (``seq == tail_seq AND pos >
    tail_pos``) are kept, so a transaction split by a batch boundary is
    finished, not skipped.

    Events of a uuid that the state does not know (P5) all pass, as do events
    without a position.  On a stream these are stream-static anti joins (a new
    query resuming from a state table).
    """
    p = F.col(pipeline) if isinstance(pipeline, str) else pipeline
    ev = events.withColumns({"_pipe": p, "_uu": F.lower(GTID_UUID)})
    after = F.lit(False)
    if exact:
        if "tail" not in states.columns and "bits" not in states.columns:
            raise ValueError("exact resume needs state rows with a 'tail' column (see state_from_batch)")
        tails = save_shared(_tails(states).where("_tp is not null"), "resume-tails")
        ev = ev.join(tails, (ev["_pipe"] == tails["_tn"]) & (ev["_uu"] == tails["_tu"]) & (ev[GTID_SEQ] == tails["_ts"]), "left")
        after = F.coalesce(F.col(POS) > F.col("_tp"), F.lit(False))
    if "bits" in states.columns:
        return bitmaps.not_in(ev, _latest_rows(states), "_pipe", "_uu", GTID_SEQ, after).select(*events.columns)
    whole, pieces = _bucketed(saved_ranges(states, start), coarse, fine)
    ev = ev.withColumns({"_after": after, "_cb": F.expr(f"`{GTID_SEQ}` div {coarse}"), "_fb": F.expr(f"`{GTID_SEQ}` div {fine}")})
    ev = ev.join(whole, (ev["_pipe"] == whole["_n"]) & (ev["_uu"] == whole["_u"]) & (ev["_cb"] == whole["_c"]) & ~ev["_after"],
                 "left_anti")
    ev = ev.join(pieces, (ev["_pipe"] == pieces["_n"]) & (ev["_uu"] == pieces["_u"]) & (ev["_fb"] == pieces["_f"])
                 & ev[GTID_SEQ].between(pieces["_x"], pieces["_y"]) & ~ev["_after"], "left_anti")
    return ev.select(*events.columns)


def start_from(log: DataFrame, states: DataFrame | None = None, pipeline: str | Column = "pipeline",
               **kw) -> DataFrame:
    """The events a run must process.

    Without saved state the whole log (start from the beginning, no
    snapshot); with state, everything after each pipeline's saved position
    (:func:`resume_filter`).  Streams resume from their checkpoint instead.
    """
    return log if states is None else resume_filter(log, states, pipeline, **kw)


def source_heads(events: DataFrame) -> DataFrame:
    """Highest sequence number per source uuid (partial aggregate)."""
    return events.groupBy(F.lower(GTID_UUID).alias("uuid")).agg(F.max(GTID_SEQ).alias("head_seq"))


def check_ahead(events: DataFrame, states: DataFrame, start: int = 1) -> DataFrame:
    """Per pipeline and uuid, saved position vs the source head.

    ``ahead`` is true when the saved position is past everything the source
    has (the source was restored or replaced); ``foreign`` when the source has
    never seen the saved uuid (P5).
    """
    saved = saved_ranges(states, start).groupBy("name", "uuid").agg(F.max("hi").alias("saved_seq"))
    heads = source_heads(events)
    j = saved.join(heads, on="uuid", how="left")
    return j.select("name", "uuid", "saved_seq", "head_seq",
                    F.coalesce(F.col("saved_seq") > F.col("head_seq"), F.lit(False)).alias("ahead"),
                    F.col("head_seq").isNull().alias("foreign"))


def assert_not_ahead(events: DataFrame, states: DataFrame) -> None:
    """Raise when any saved position is ahead of its source; names the first 20
    and counts the rest (:func:`check_ahead` has them all)."""
    bad = check_ahead(events, states).filter("ahead")
    n = bad.count()
    if n:
        shown = ", ".join(f"{r['name']}:{r['uuid']} saved={r['saved_seq']} head={r['head_seq']}" for r in bad.limit(20).collect())
        raise RuntimeError(f"saved position ahead of the source: {shown}" + (f" and {n - 20} more" if n > 20 else ""))


def write_state(state_rows: DataFrame, path: str, fmt: str = "parquet", batch_id: int | None = None) -> None:
    """Save state rows.  With ``batch_id`` the rows go to ``<path>/batch=<n>``,
    overwritten if the batch is replayed, so a retry never adds a row."""
    rows = state_rows.select("name", "gtid", "timestamp", *(["tail"] if "tail" in state_rows.columns else []))
    if batch_id is None:
        rows.write.mode("append").format(fmt).save(path)
    else:
        rows.write.mode("overwrite").format(fmt).save(f"{path}/batch={int(batch_id)}")


def compact_state(states: DataFrame, path: str) -> None:
    """Write the latest row per pipeline of a table of texts to a new folder.

    Readers only need the newest row per pipeline.  Switch them to the new folder
    (never overwrite the folder being read).
    """
    latest_state(states).write.mode("errorifexists").parquet(path)
