"""Structured Streaming jobs.

Stateless operators (casts, parsing, landing columns) run directly on the
streaming DataFrame.  Row-number windows and merges are not allowed on a
stream, so they run per micro-batch inside ``foreachBatch`` against a
Silver table, which records per checkpoint the last batch applied, so a
replayed batch is skipped.  Every job uses the run-once ``availableNow``
trigger and waits for completion.
"""

from __future__ import annotations

import json
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakefold.functions import logtext
from lakefold.functions.logtext import EVENT_START
from lakefold.operators.multiline import events_of_lines
from lakefold.operators.offsets import KEYS, merge_intervals, offset_intervals
from lakefold.sinks.bronze import with_day_parts, with_landing_day
from lakefold.session import plain_path, stage, staging
from lakefold.sources.silver import SilverTable


def kafka_stream(
    spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "earliest"
) -> DataFrame:
    """Kafka topic as a stream (needs the Kafka connector).

    Offsets are tracked by the writer's checkpoint only; ``failOnDataLoss``
    is off so that offsets aged out of the brokers do not stop the job."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
        .load()
    )


def decode_messages(stream: DataFrame) -> DataFrame:
    """``timestamp`` and the value decoded as UTF-8 text."""
    return stream.selectExpr("timestamp", "CAST(value AS STRING) AS value")


def _run_once(writer, path: str | None = None) -> StreamingQuery:
    q = writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def append_job(
    stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet", partition_by: Iterable[str] = ()
) -> StreamingQuery:
    """Append a stream to files, exactly once through the writer's
    checkpoint; a rerun on the same checkpoint adds nothing new."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    return _run_once(writer, sink_path)


def log_append_job(stream: DataFrame, sink_path: str, checkpoint: str) -> StreamingQuery:
    """The retired log stream job (decode, then append)."""
    return append_job(decode_messages(stream), sink_path, checkpoint)


class GrownFileError(RuntimeError):
    """A log file that was read already has grown since."""


def log_file_job(
    spark: SparkSession, path_glob: str, sink_path: str, checkpoint: str, start_pattern: str = EVENT_START
) -> StreamingQuery:
    """S11 + W2: append the events of new log files to ``sink_path``
    (``file_path, file_size, event_no, first_line, n_lines, event``).

    Rule for growing files: a file is read once, so only rotated files
    belong under ``path_glob``.  Every event carries the size its file had
    when it was read; before a run, a file that has another size by now
    raises ``GrownFileError`` instead of losing its new lines.  Each
    micro-batch is assembled by splits; an event never straddles two
    micro-batches, because a file is never divided between them.
    """
    def listing() -> DataFrame:
        return spark.read.format("binaryFile").load(path_glob).select(
            F.col("path").alias("file_path"), F.col("length").alias("size_now"))

    sink = spark._jvm.org.apache.hadoop.fs.Path(sink_path)
    if sink.getFileSystem(spark._jsc.hadoopConfiguration()).exists(sink):
        read_as = spark.read.parquet(sink_path).groupBy("file_path").agg(F.max("file_size").alias("size_read"))
        grown = read_as.join(listing(), "file_path").filter("size_read <> size_now").limit(5).collect()
        if grown:
            raise GrownFileError("only rotated files can be read; these have grown: "
                                 + ", ".join(f"{r.file_path} ({r.size_read} to {r.size_now} bytes)" for r in grown))

    lines = spark.readStream.option("encoding", "UTF-8").text(path_glob).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))

    def land(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("line_id", F.monotonically_increasing_id())
        with staging(spark):
            own = stage(numbered, "log-lines")
            sizes = own.groupBy("file_path").agg(F.max("file_size").alias("file_size"))
            out = events_of_lines(own.drop("file_size"), start_pattern).join(sizes, "file_path")
            # one folder per batch, written anew if the batch is replayed
            (out.withColumn("file_path", plain_path("file_path")).withColumn("batch", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(sink_path))

    return _run_once(lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint))


def parse_log_stream(messages: DataFrame, message_col: str = "value", ts_col: str = "timestamp") -> DataFrame:
    """T5: clean and parse shipped log messages (F12-F15), with the
    ``year/month/day`` landing columns of K5."""
    cleaned = messages.withColumn("message", logtext.clean_message(F.col(message_col)))
    parsed = cleaned.withColumns(logtext.parse_columns("message"))
    return with_day_parts(parsed, ts_col)


def landing_stream_job(
    stream: DataFrame,
    sink_path: str,
    checkpoint: str,
    time_zone: str = "Asia/Seoul",
    max_records_per_file: int | None = None,
) -> StreamingQuery:
    """T4: continuous Bronze landing into ``ingest_date`` folders (the
    landing day of the processing time).  ``max_records_per_file`` mimics
    the connector's flush size when given."""
    landed = with_landing_day(stream, None, time_zone)
    writer = (
        landed.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return _run_once(writer, sink_path)


def apply_once(
    stream: DataFrame, table: SilverTable, checkpoint: str, apply: Callable[[DataFrame, tuple[str, int]], None]
) -> StreamingQuery:
    """Call ``apply(batch, (writer, batch id))`` for every micro-batch that
    ``table`` has not applied yet.  A writer is a checkpoint (Spark's id of
    the query, kept in the checkpoint): batch ids of different streams, or
    of a stream started afresh, do not stand in each other's way."""
    spark = stream.sparkSession
    id_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")

    def writer_id() -> str:
        fs = id_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stream_in = fs.open(id_path)
        try:
            return json.loads(bytes(stream_in.readAllBytes()).decode())["id"]
        finally:
            stream_in.close()

    def each(batch: DataFrame, batch_id: int) -> None:
        writer = writer_id()
        last = table.applied(writer)
        if last is None or batch_id > last:
            apply(batch, (writer, batch_id))

    return _run_once(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))


def drain_job(stream: DataFrame, table: SilverTable, checkpoint: str) -> StreamingQuery:
    """Drain a topic once (``topic, partition, offset, value``) and
    keep the intervals of the offsets that arrived in ``table``; see
    ``offsets.drain_report``.  A batch that is replayed changes nothing."""

    def apply(batch: DataFrame, applied: tuple[str, int]) -> None:
        with staging(batch.sparkSession):
            new = stage(offset_intervals(batch.select(*KEYS, "offset")), "offsets")
            known = table.read().unionByName(new) if table.exists() else new
            table.write(merge_intervals(known), applied)

    return apply_once(stream, table, checkpoint, apply)


def append_unique_job(
    stream: DataFrame, key: str, ts: str, delay: str, sink_path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Append messages that a producer may send again, each once.

    A copy is known by its ``key`` (``ingest.with_stable_key``) as long as it
    comes within ``delay`` of event time behind the newest message; keys are
    forgotten after that, so the state is bounded by the messages of
    ``delay``.  Messages older than the watermark are dropped."""
    unique = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return append_job(unique, sink_path, checkpoint, fmt)


def merge_stream_job(
    stream: DataFrame,
    table: SilverTable,
    checkpoint: str,
    merge_batch: Callable[[DataFrame, DataFrame], DataFrame],
    initial: Callable[[DataFrame], DataFrame] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Fold every micro-batch into ``table`` with ``merge_batch(target,
    batch)``.

    ``prepare`` turns each raw micro-batch into the frame that is merged; it
    is staged, since the merge reads it more than once.  The first batch of
    a missing table is merged into an empty table of the batch's schema (or
    into ``initial(batch)`` when given).  On a partitioned table only the
    partitions present in the batch are read and rewritten (the partition
    columns must be functions of the merge key).  A batch that this
    checkpoint has already applied (a replay after a failure) is skipped.
    """

    def apply(batch: DataFrame, applied: tuple[str, int]) -> None:
        with staging(batch.sparkSession):
            own = stage(prepare(batch) if prepare else batch, "micro-batch")
            if not table.exists():
                target = initial(own) if initial else own.limit(0)
                table.write(merge_batch(target, own), applied)
            elif table.partition_by:
                touched = table.partition_values(own)
                table.replace(merge_batch(table.read(touched), own), touched, applied)
            else:
                table.write(merge_batch(table.read(), own), applied)

    return apply_once(stream, table, checkpoint, apply)
