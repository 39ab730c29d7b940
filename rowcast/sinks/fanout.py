"""Per-event topic fan-out sinks (K1).

Records are ``(pipeline, topic, key, value, <position>)``.  File and table
sinks partition by topic; the Kafka sink routes by the ``topic`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowcast.operators.delivery import order_for_delivery


def write_topics(records: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                 ordered: bool = True, partitions: int | None = None) -> None:
    """Batch fan-out: one folder per topic; within it files follow per-key order.
    A run writes to a folder of its own; running again with ``mode="overwrite"``
    replaces it, so records are never written twice.

    Read it back with an explicit schema (``topic`` as string), or partition
    type inference may read a numeric-looking topic name as a number.
    """
    out = order_for_delivery(records, partitions=partitions) if ordered else records
    out.write.mode(mode).partitionBy("topic").format(fmt).save(path)


def write_kafka(records: DataFrame, servers: str, **options) -> None:
    """Batch write to Kafka; each record goes to its own ``topic`` under ``key``.

    Needs the Kafka connector on the class path.  At-least-once: a retried
    task may write a record twice (remove with ``dedupe`` downstream).
    """
    (records.selectExpr("topic", "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
     .write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save())


def stream_kafka(records: DataFrame, servers: str, checkpoint: str, **options):
    """Streaming write to Kafka with a checkpoint (positions resume from it)."""
    return (records.selectExpr("topic", "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
            .writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("checkpointLocation", checkpoint).options(**options).start())


def order_for_kafka(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per-key order for Kafka: a key's records must come from one producer in
    order, so they are hash-partitioned by (topic, key) and sorted by
    position.  On a stream this runs per micro-batch, so one key's share of a
    task is bounded by the trigger size (``maxFilesPerTrigger`` /
    ``maxOffsetsPerTrigger``)."""
    r = records.repartition(partitions, "topic", "key") if partitions else records.repartition("topic", "key")
    return r.sortWithinPartitions("topic", "key", "gtid_seq", "pos")


def kafka_writer(servers: str, **options):
    """A micro-batch writer for ``start_pipeline(writer=...)``: per-key order,
    then the Kafka sink (needs the connector on the class path)."""
    def write(records: DataFrame, batch_id: int) -> None:
        write_kafka(order_for_kafka(records), servers, **options)
    return write
