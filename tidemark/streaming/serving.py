"""Streams: model updates and records in, scored records out.

Every output of a micro-batch goes to a folder named by its batch number and is replaced when the batch is run again
after a failure, so results are written once although batches may run twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.descriptors import check_descriptors
from tidemark.operators.asof import assign_models


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, kind: str = "parquet"
) -> DataFrame:
    """Files of a folder or pattern as a stream; `files_per_trigger` sets the pace."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _start(df: DataFrame, checkpoint: str, every: str | None, write, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def collect_versions(
    descriptors: DataFrame, supported: Sequence[str], folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the table of model versions up to date: usable and refused descriptors, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = check_descriptors(batch, supported)
        laid = judged.withColumn("usable", F.col("error").isNull())
        laid.write.mode("overwrite").partitionBy("usable").parquet(f"{folder}/batch_id={batch_id}")

    return _start(descriptors, checkpoint, every, write)


def collected_versions(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The usable versions so far; empty before the first batch."""
    from tidemark.sources.text import existing_paths

    if not existing_paths(spark, [folder], False):
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("error", T.StringType()), T.StructField("usable", T.BooleanType())])
    table = spark.read.schema(full).option("basePath", folder).parquet(f"{folder}/batch_id=*")
    return table.where("usable").select(*schema.names)


def serve(
    records: DataFrame,
    versions: Callable[[SparkSession], DataFrame],
    score: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    *,
    on: str,
    by: Sequence[str] = (),
    seq: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score a stream of records with the versions known when each batch starts.

    `score` gets the records with a `model` struct, null where no version was valid. A version that arrives later than
    records of its time does not change what was written; run the batch operators over the stored records for that.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        current = versions(batch.sparkSession)
        scored = score(assign_models(batch, current, on=on, by=by, seq=seq))
        scored.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(records, checkpoint, every, write)


def served(spark: SparkSession, folder: str) -> DataFrame:
    """What `serve` wrote, without the batch number."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/batch_id=*").drop("batch_id")


def without_duplicates(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that come within `delay` of each other; state older than that is freed."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def bucket_counts(stream: DataFrame, time: str, width: str, delay: str, measures: dict, tags: Sequence[str] = ()) -> DataFrame:
    """Tumbling buckets on a stream; in append mode a bucket comes out once it can no longer change (T5)."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    grouped = timed.groupBy(*tags, F.window(time, width)).agg(*[c.alias(n) for n, c in measures.items()])
    return grouped.select(*tags, F.unix_micros("window.start").alias("bucket"), *measures)


def keep_latest(stream: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write what changed in every batch, buckets still open included; `latest` reads the last state of each key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(stream, checkpoint, every, write, "update")


def latest(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """The last written row of every key."""
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/batch_id=*")
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id").cast("bigint")).alias("_v"))
    return newest.select(*keys, "_v.*")


def append_to(stream: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder; the file sink's own log makes each batch count once."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def fan_out_stream(
    stream: DataFrame, outputs: Sequence[Callable[[DataFrame, int], None]], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """One stream to several outputs, computed once per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for output in outputs:
                output(kept, batch_id)
        finally:
            kept.unpersist()

    return _start(stream, checkpoint, every, write)
