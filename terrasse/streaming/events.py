"""Event streams into bronze: file and broker sources, envelope unpacking, append sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from terrasse.functions import schemas as S
from terrasse.operators.rules import event_time
from terrasse.settings import child_names, path_exists
from terrasse.sinks.writers import overwrite_table, read_evolved

BatchSink = Callable[[DataFrame, str], None]

# Source and sink defaults.
FILES_PER_BATCH = 20
FILE_TRIGGER, BROKER_TRIGGER = "10 seconds", "5 seconds"
PARTITION_BY = ("event_type", "event_date")


def file_stream(spark: SparkSession, path: str, schema: str = S.FLAT_EVENT, fmt: str = "json",
                files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Files that arrive under ``path``; streams need a fixed schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def broker_stream(spark: SparkSession, servers: str, topics: Sequence[str], group: str, starting: str = "latest", **options: str) -> DataFrame:
    """Kafka topics as (topic, partition, offset, timestamp, value); needs the Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("kafka.group.id", group)
        .option("failOnDataLoss", "false")
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def unpack_envelopes(messages: DataFrame) -> DataFrame:
    """Broker messages as bronze event rows; works on batches and streams.

    A message that is no envelope keeps its raw value and offsets, with NULL envelope fields.
    """
    # Output columns of a bronze event row.
    opened = messages.withColumn("env", F.from_json(F.col("value").cast("string"), S.CLOUD_EVENT))
    return opened.select(
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("_raw_value"),
        F.col("env.eventId").alias("event_id"), F.col("env.eventType").alias("event_type"),
        F.col("env.occurredAt").alias("event_timestamp"), F.col("env.source").alias("event_source"),
        F.col("env.version").alias("event_version"), F.col("env.payload").alias("payload_json"),
    )


def add_stream_metadata(df: DataFrame, source_path: str) -> DataFrame:
    return df.withColumns({"_processed_at": F.current_timestamp(), "_source_path": F.lit(source_path)})


def add_broker_metadata(df: DataFrame, topics: Sequence[str], group: str) -> DataFrame:
    return df.withColumns({
        # Metadata columns of a bronze event row.
        "_processed_at": F.current_timestamp(),
        "_source_topics": F.lit(",".join(topics)),
        "_consumer_group": F.lit(group),
        "event_date": F.to_date(event_time("event_timestamp", "kafka_timestamp")),
    })


def drop_late_duplicates(df: DataFrame, id_column: str = "event_id", ts: str = "event_timestamp", delay: str = "1 hour") -> DataFrame:
    """First row per event id within the watermark; keeps state for ``delay`` only."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark([id_column])


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                  trigger: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append to a table with a checkpoint; without a trigger all pending input is processed once.

    A restart on the same checkpoint continues where the last run ended and repeats no row.  It may bring further columns:
    `sinks.writers.read_evolved` then reads NULL in the rows of earlier runs.
    """
    if fmt == "parquet":
        refuse_narrowing(df, path)
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def append_batches(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), trigger: str | None = None,
                   sink: BatchSink | None = None) -> StreamingQuery:
    """Append batch by batch, each to ``<path>/batch=<id>/``, so that a batch is there whole and once, whenever a run fails.

    A batch whose folder is complete was written before the checkpoint knew of it: it is skipped.  One that broke off is
    written anew over what it left.  `read_batches` reads complete batches only.  ``sink`` writes a batch to a folder (by
    default as Parquet); it may be called again for the same folder.
    """
    spark, write = df.sparkSession, sink or (lambda rows, folder: overwrite_table(rows, folder, partition_by))

    def one(rows: DataFrame, batch: int) -> None:
        folder = f"{path}/batch={batch}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            write(rows, folder)

    writer = df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all complete batches with their number in ``batch``; columns that came later are NULL in earlier batches."""
    whole = [b for b in child_names(spark, path, "batch=") if path_exists(spark, f"{path}/{b}/_SUCCESS")]
    if not whole:
        raise LookupError(f"no complete batch in {path}")
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*[f"{path}/{b}" for b in whole])


def refuse_narrowing(df: DataFrame, path: str) -> DataFrame:
    """``df``, if it keeps every column that ``path`` stores with its type; a restarted stream may only add columns.

    Parquet readers could not merge the files of a column that changed its type, and a column that is left out is
    more often a mistake than a wish.
    """
    if not path_exists(df.sparkSession, path):
        return df
    try:
        stored = dict(read_evolved(df.sparkSession, path).dtypes)
    except AnalysisException as nothing:
        if nothing.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # an empty folder
            raise
        return df
    now = dict(df.dtypes)
    wrong = sorted(c for c, t in stored.items() if now.get(c) != t)
    if wrong:
        raise ValueError(f"stored columns are missing or of another type: {', '.join(wrong)}")
    return df


def files_to_bronze(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = S.FLAT_EVENT,
                    trigger: str | None = FILE_TRIGGER) -> StreamingQuery:
    return append_stream(add_stream_metadata(file_stream(spark, source, schema), source), target, checkpoint, trigger=trigger)


def broker_to_bronze(spark: SparkSession, servers: str, topics: Sequence[str], group: str, target: str, checkpoint: str,
                     starting: str = "latest", trigger: str | None = BROKER_TRIGGER,
                     partition_by: Sequence[str] = PARTITION_BY) -> StreamingQuery:
    messages = broker_stream(spark, servers, topics, group, starting)
    rows = add_broker_metadata(unpack_envelopes(messages), topics, group)
    return append_stream(rows, target, checkpoint, partition_by, trigger)
