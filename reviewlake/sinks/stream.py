"""Publish events as keyed JSON messages (message bus, or files for a file stream)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.schemas import REVIEW_SCHEMA
from reviewlake.sinks.tables import _fs

# a batch's folder; the letter keeps its id a string where it is read as a partition value
_BATCH = "batch=b-"


def event_records(events: DataFrame, topic: str = "reviews", partitions: int = 8,
                  key_col: str = "app_id") -> DataFrame:
    """Events -> records (key, value, topic, partition, offset, timestamp).

    key = app id as a string, value = the 9-field event as JSON (non-ASCII kept
    as is). Partition = ``pmod(hash(key), partitions)`` so one app's events
    stay in order on one partition; offset = event id (monotone per partition).
    """
    fields = [f.name for f in REVIEW_SCHEMA.fields]
    return events.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col(key_col).cast("string")), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def published_batches(spark: SparkSession, target: str) -> list[str]:
    """Ids of the batches committed on a file topic."""
    fs, p, _ = _fs(spark, target)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.removeprefix(_BATCH) for n in names if n.startswith(_BATCH))


def publish_events(events: DataFrame, target: str, fmt: str = "json", topic: str = "reviews",
                   options: dict[str, str] | None = None, batch_id: str | None = None) -> bool:
    """Append events to a topic; whether anything was written.

    A file topic takes a batch once: its records are written below a hidden
    folder and appear in a folder of its name by one rename, whole or
    not at all. A batch id that is already there is left alone and False comes
    back, so a job that is run again adds nothing, and a stream that reads the
    topic never sees half a batch. Without ``batch_id`` each call is a batch of
    its own. (The rename must be atomic, as on HDFS and POSIX folders.)
    ``streaming.stream_source`` picks batches up incrementally.

    ``fmt="kafka"``: ``target`` is the bootstrap server list and the batch
    Kafka sink writes (key, value) with producer retries from ``options``: at
    least once, since a batch sink has no transactions. That path needs the
    connector and has not been run on this image.
    """
    records = event_records(events, topic)
    if fmt == "kafka":
        w = (records.select("key", "value").write.format("kafka")
             .option("kafka.bootstrap.servers", target).option("topic", topic)
             .option("kafka.retries", "5"))
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
        return True
    spark, target = events.sparkSession, target.rstrip("/")
    batch_id = uuid.uuid4().hex if batch_id is None else str(batch_id)
    if batch_id in published_batches(spark, target):
        return False
    draft = f"{target}/_draft-{uuid.uuid4().hex}"
    records.write.mode("errorifexists").format(fmt).save(draft)
    fs, final, jvm = _fs(spark, f"{target}/{_BATCH}{batch_id}")
    source = jvm.org.apache.hadoop.fs.Path(draft)
    # a rename onto a folder that appeared meanwhile would move the draft into it
    moved = not fs.exists(final) and fs.rename(source, final)
    if not moved:
        fs.delete(source, True)
        if not fs.exists(final):
            raise OSError(f"could not commit {final}")
    return moved
