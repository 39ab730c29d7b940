"""Delivery-side operators: dedupe, per-key order, latency, enrichment
(P7, P8, P10, M8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.model import GTID_SEQ, GTID_UUID, POS
from rowcast.operators.ordered import DEFAULT_BUCKET_WIDTH, keyed_row_number, keyed_windows

#: A source position: unique per pipeline, as several may read one log.
POSITION_KEYS = ("pipeline", GTID_UUID, GTID_SEQ, POS)


def _position(records: DataFrame, keys: Sequence[str] | None) -> list[str]:
    return list(keys) if keys is not None else [c for c in POSITION_KEYS if c in records.columns]


def dedupe(records: DataFrame, keys: Sequence[str] | None = None, copies: str | None = None) -> DataFrame:
    """One record per pipeline and source position (at-least-once replays
    removed).

    An aggregate with a map-side partial step, so many copies of one position
    collapse inside each task before the shuffle.  Of differing copies (a
    replay carries a new processing time) the smallest is kept, so a retried
    task picks the same one.  Records without a full position can't be told
    apart and all pass.  ``copies`` adds how many copies were seen.
    """
    keys = _position(records, keys)
    rest = [c for c in records.columns if c not in keys]
    placed = F.lit(True)
    for k in keys:
        placed = placed & F.col(k).isNotNull()
    aggs = [F.min(F.struct(*[F.col(c) for c in rest])).alias("_keep")]
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
    out = records.filter(placed).groupBy(*keys).agg(*aggs)
    more = [copies] if copies else []
    out = out.select(*keys, *[F.col("_keep")[c].alias(c) for c in rest], *more)
    loose = records.filter(~placed).select(*keys, *rest, *([F.lit(1).cast("bigint").alias(copies)] if copies else []))
    return out.unionByName(loose)


def dedupe_stream(records: DataFrame, event_time: str, delay: str, keys: Sequence[str] | None = None) -> DataFrame:
    """P7 on a stream: state kept only within the watermark delay."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(_position(records, keys))


def sequence_in_key(records: DataFrame, keys: Sequence[str] = ("topic", "key"),
                    order: Sequence[str] = (GTID_SEQ, POS), name: str = "seq_in_key",
                    width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Number records 1, 2, ... per key in source order (balanced for hot keys)."""
    return keyed_row_number(records, keys, order, name, width)


def order_for_delivery(records: DataFrame, keys: Sequence[str] = ("topic", "key"),
                       order: Sequence[str] = (GTID_SEQ, POS), partitions: int | None = None) -> DataFrame:
    """P8 for file sinks: range-partition by (key, position) and sort inside.

    Each output file holds a contiguous run of keys in source order; a hot key
    spans several consecutive files instead of one huge task.  (A Kafka sink
    keeps per-key order by the broker's key partitioning.)
    """
    cols = [*keys, *order]
    r = records.repartitionByRange(partitions, *cols) if partitions else records.repartitionByRange(*cols)
    return r.sortWithinPartitions(*cols)


def total_order(records: DataFrame, order: Sequence[str] = (GTID_UUID, GTID_SEQ, POS)) -> DataFrame:
    """P8, batch only: one total order by source position (a global sort:
    range-partitioned and sorted, so it stays balanced).  Streams refuse a
    sort; they keep per-key order instead."""
    return records.orderBy(*order)


def latency_by_topic(records: DataFrame, sink_time_us: Column, topic: str = "topic",
                     event_time_us: Column | None = None) -> DataFrame:
    """P10: delivery delay per topic in microseconds: count, sum, minimum,
    maximum, integer mean and the 99th percentile as a value that occurs
    (nearest rank; Spark's percentile sketch is exact up to its accuracy)."""
    et = event_time_us if event_time_us is not None else F.get_json_object("value", "$.meta.timestamp").cast("bigint")
    lat = (sink_time_us - et).cast("bigint")
    return (records.select(F.col(topic).alias("topic"), lat.alias("_lat"))
            .groupBy("topic")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_lat").alias("sum_latency_us"),
                 F.min("_lat").alias("min_latency_us"), F.max("_lat").alias("max_latency_us"),
                 F.expr("sum(_lat) div count(1)").alias("avg_latency_us"),
                 F.percentile_approx("_lat", 0.99, 1_000_000).alias("p99_latency_us")))


def enrich_rows(events: DataFrame, image: str, dim: DataFrame, on: tuple[str, str], fields: Sequence[str]) -> DataFrame:
    """M8: add dimension columns to every row of an image list (a left join:
    a row whose key the dimension holds twice comes out twice).

    Rows are exploded with their position (the event's other columns ride
    along), joined to ``dim`` (``on = (image_field, dim_column)``) and put back
    in order per event.  Spark broadcasts ``dim`` where its size allows and
    splits skewed keys otherwise.  An event is identified by its pipeline, its
    position and a row id, so equal positions never merge; a group holds the
    rows of one event.  Null images stay null; new fields are placed in name
    order.
    """
    img_field, dim_col = on
    events = events.withColumn("_eid", F.monotonically_increasing_id())
    key = ["_eid", *[c for c in (GTID_UUID, GTID_SEQ, POS) if c in events.columns]]
    itype = events.schema[image].dataType.elementType
    names = sorted(set(itype.names) | set(fields))
    other = [c for c in events.columns if c not in key and c != image]
    d = dim.select(F.col(dim_col).alias("_dk"), *[F.col(f) for f in fields])
    rows = events.select(*key, *other, F.col(image).isNull().alias("_img_null"), F.posexplode_outer(image).alias("_pos", "_r"))
    joined = rows.join(d, rows["_r"][img_field] == d["_dk"], "left")
    rebuilt = F.struct(*[(F.col(f) if f in fields else F.col("_r")[f]).alias(f) for f in names])
    agg = joined.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in other], F.first("_img_null").alias("_img_null"),
        F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(),
                                           F.struct(F.col("_pos"), rebuilt.alias("_row"))))).alias("_rows"))
    new_img = F.when(F.col("_img_null"), F.lit(None)).otherwise(F.transform("_rows", lambda x: x["_row"]))
    return agg.select(*[(new_img.alias(c) if c == image else F.col(c)) for c in events.columns if c != "_eid"])


def enrich_event(events: DataFrame, dim: DataFrame, on: tuple[Column, str], fields: Sequence[str]) -> DataFrame:
    """M8 at event level: left-join a dimension on an event expression
    (e.g. ``first_row('after')['user_id']``) and add its columns; an event whose
    key the dimension holds twice comes out twice."""
    expr, dim_col = on
    d = dim.select(F.col(dim_col).alias("_dk"), *[F.col(f) for f in fields])
    ev = events.withColumn("_ek", expr)
    return ev.join(d, ev["_ek"] == d["_dk"], "left").drop("_ek", "_dk")


#: Size parameter of the latency sketches: ranks are off by at most about
#: ``RANK_ERROR`` of all records (with 99 % confidence), whatever their number.
SKETCH_K = 400
RANK_ERROR = 0.01


def latency_sketches(records: DataFrame, delay_us: Column, by: Sequence[str] = ("topic",), k: int = SKETCH_K) -> DataFrame:
    """P10, mergeable: one quantile sketch (KLL, a few kilobytes) of the delay per
    group; a partial aggregate, so a topic of any size is a sketch per task.  Saved
    per micro-batch or run, the rows of any range merge (:func:`merged_sketches`)."""
    return records.groupBy(*by).agg(F.count(delay_us).alias("n"), F.min(delay_us.cast("bigint")).alias("min_latency_us"),
                                    F.max(delay_us.cast("bigint")).alias("max_latency_us"),
                                    F.kll_sketch_agg_bigint(delay_us.cast("bigint"), k).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ("topic",), quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """The sketches of any number of saves as one per group, with ``p<q>_latency_us``."""
    one = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.min("min_latency_us").alias("min_latency_us"),
                                    F.max("max_latency_us").alias("max_latency_us"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return one.select("*", *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"p{q * 100:g}_latency_us") for q in quantiles])


def enrich_as_of(events: DataFrame, versions: DataFrame, on: tuple[Column, str], at: tuple[str, str], fields: Sequence[str],
                 width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """M8 at a point in time: the dimension is itself a change log, and an event
    takes the version that is valid at its position.

    ``versions`` has a row per change: the key column, a position and the
    ``fields`` (all null where the key was deleted).  ``on`` is the event's key
    expression and that key column, ``at`` the position columns of both sides (one
    integer order).  An event takes the last version at or before its position; an
    event without key, position or earlier version gets nulls.

    Both sides are one frame whose running last version per key is computed per
    bucket of positions (:mod:`rowcast.operators.ordered`), so a hot key is spread
    over its buckets and nothing is joined by range."""
    key, version_key = on
    event_at, version_at = at
    fields = list(fields)
    kind = versions.schema[version_key].dataType
    left = events.select(F.struct(*events.columns).alias("_e"), key.cast(kind).alias("_k"), F.col(event_at).cast("bigint").alias("_p"),
                         F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_i"))
    value = F.struct(*fields)
    right = versions.select(F.col(version_key).alias("_k"), F.col(version_at).cast("bigint").alias("_p"), F.lit(0).alias("_side"),
                            F.monotonically_increasing_id().alias("_i"), value.alias("_v"))
    both = left.unionByName(right, allowMissingColumns=True)
    seen = keyed_windows(both.where("_k is not null and _p is not null"), ["_k"], ["_p", "_side", "_i"], lasts={"_now": "_v"}, width=width)
    loose = left.where("_k is null or _p is null").select("_e", F.lit(None).cast(seen.schema["_now"].dataType).alias("_now"))
    out = seen.where("_side = 1").select("_e", "_now").unionByName(loose)
    return out.select("_e.*", *[F.col("_now")[f].alias(f) for f in fields])
