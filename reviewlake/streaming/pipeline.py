"""Streaming jobs.

The bronze stream is stateless (a projection), appended exactly once per
source record thanks to the checkpoint's offset/commit logs and the file
sink's manifest: rerunning with nothing new writes nothing. ``availableNow``
drains what is there in ``max_per_trigger``-bounded micro-batches and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlake.operators.clean import bronze_project, tag_events
from reviewlake.schemas import RECORD_SCHEMA


def stream_source(spark: SparkSession, path_or_servers: str, fmt: str = "json",
                  topic: str = "reviews", max_per_trigger: int = 50000,
                  max_files_per_trigger: int | None = None, schema=RECORD_SCHEMA,
                  options: dict[str, str] | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming records from a topic.

    ``fmt="kafka"``: subscribe from the earliest offset, at most
    ``max_per_trigger`` records per micro-batch. That path needs the Kafka
    connector and has not been run on this image. Otherwise a file stream of
    record files (as ``sinks.publish_events`` writes them) with an explicit
    schema; ``max_bytes_per_trigger`` or ``max_files_per_trigger`` (one of
    them) bounds a micro-batch by what it reads, one file at least.
    """
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", path_or_servers)
             .option("subscribe", topic)
             .option("startingOffsets", "earliest")
             .option("maxOffsetsPerTrigger", str(max_per_trigger)))
    else:
        r = spark.readStream.format(fmt).schema(schema)
        if max_bytes_per_trigger and max_files_per_trigger:
            raise ValueError("bound a micro-batch by bytes or by files, not both")
        if max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        return r.load()
    # a topic's batch folders would add a partition column
    return r.load(path_or_servers).select(*[f.name for f in schema.fields])


def stream_to_bronze(records: DataFrame, bronze_path: str, checkpoint: str,
                     fmt: str = "parquet", wait: bool = True) -> StreamingQuery:
    """Append the projected stream to bronze, drain what is available, stop."""
    q = (bronze_project(records).writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(bronze_path))
    if wait:
        q.awaitTermination()
    return q


def _refuse_mixed(spark, checkpoint: str, *targets: str) -> None:
    """A new checkpoint starts at batch 0: it must not write over another one's batches."""
    from reviewlake.sinks.tables import _fs

    def exists(path: str) -> bool:
        fs, p, _ = _fs(spark, path)
        return fs.exists(p)
    there = [t for t in targets if exists(t)]
    if there and not exists(checkpoint):
        raise FileExistsError(f"{there[0]} holds batches of another checkpoint than {checkpoint}")


def silver_stream(bronze: DataFrame, silver_path: str, rejects_path: str, checkpoint: str,
                  fmt: str = "parquet", wait: bool = True, counts_path: str | None = None) -> StreamingQuery:
    """Incremental bronze -> silver: each micro-batch is parsed once and split.

    ``foreachBatch`` persists the tagged batch and writes valid rows to
    ``silver_path/batch=<id>`` and the rest (with reasons) to
    ``rejects_path/batch=<id>``, each with overwrite: a batch replayed after a
    failure rewrites its own folder instead of appending twice. Readers load
    the root (``batch`` becomes a partition column). Batches are numbered per
    checkpoint, so a new checkpoint over folders that exist is refused.

    With ``counts_path`` each batch also leaves its valid rows' (class, text
    length) histogram there: length reports of the whole silver table add these
    up (``read_length_counts``, ``profile.length_stats_of``) and read no text.
    """
    from reviewlake.operators.profile import length_counts
    from reviewlake.schemas import SILVER_COLUMNS

    _refuse_mixed(bronze.sparkSession, checkpoint, silver_path, rejects_path, *([counts_path] if counts_path else []))

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_events(batch).persist()
        try:
            (tagged.where(F.col("reject_reason").isNull()).select(*SILVER_COLUMNS)
             .write.mode("overwrite").format(fmt).save(f"{silver_path}/batch={batch_id}"))
            (tagged.where(F.col("reject_reason").isNotNull())
             .select("raw_json", "event_id", "reject_reason")
             .write.mode("overwrite").format(fmt).save(f"{rejects_path}/batch={batch_id}"))
            if counts_path:
                (length_counts(tagged.where(F.col("reject_reason").isNull()))
                 .write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}"))
        finally:
            tagged.unpersist()

    q = (bronze.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def read_length_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """(sentiment, length, n, batch) of every ingested batch; merge with ``profile.merge_length_counts``."""
    return spark.read.option("basePath", counts_path).parquet(f"{counts_path}/batch=*")


def hourly_trend_stream(silver: DataFrame, ts_col: str = "event_time",
                        lateness: str = "1 hour") -> DataFrame:
    """Rows per hour as a streaming aggregate; an hour is final once the
    watermark (max event time - ``lateness``) passes its end (append mode)."""
    return (silver.withWatermark(ts_col, lateness)
            .groupBy(F.window(ts_col, "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("hour"), "count"))


def write_hourly_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run ``hourly_trend_stream`` to the end of its input, open hours included.

    Each batch writes the hours it changed to ``path/batch=<id>`` (update
    mode); an hour's state goes once the watermark has passed it.
    """
    _refuse_mixed(trend.sparkSession, checkpoint, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (trend.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_hourly_trend(spark, path: str) -> DataFrame:
    """(hour, count): each hour's count as of the last batch that changed it."""
    return (spark.read.option("basePath", path).parquet(f"{path}/batch=*")
            .groupBy("hour").agg(F.max_by("count", "batch").alias("count")))


def dedup_stream(silver: DataFrame, key: str = "event_id", ts_col: str = "event_time",
                 lateness: str = "1 hour") -> DataFrame:
    """Drop repeated event ids arriving within ``lateness`` of each other.

    A key's state goes once the watermark has passed its first event by
    ``lateness``, so the state holds a window of keys, not all of them. Of
    repeats in one micro-batch any one stays: ``key`` should say all that
    matters of an event.
    """
    return silver.withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark([key])


def write_dedup(events: DataFrame, path: str, checkpoint: str, key: str = "event_id", ts_col: str = "event_time",
                lateness: str = "1 hour", wait: bool = True) -> StreamingQuery:
    """Run ``dedup_stream`` over what has arrived, appending first occurrences exactly once.

    Keys seen live in the checkpoint's state: a rerun after a restart goes on
    with them and drops repeats of what earlier runs wrote.
    """
    q = (dedup_stream(events, key, ts_col, lateness).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    if wait:
        q.awaitTermination()
    return q
