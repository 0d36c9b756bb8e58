"""Streams: an inbox of images scored as files arrive, and running prediction counts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxlake.functions import paths
from boxlake.operators.batching import packed_files, repartition_batch, task_count
from boxlake.operators.pixels import pixels_of_image_source
from boxlake.operators.scoring import history_rows, run_scoring
from boxlake.session import bound_batches, session_with
from boxlake.sources.sinks import append_history

IMAGE_SOURCE = (
    "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
)

# Most tasks of the job in which Spark looks many paths up.
LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def inbox_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New images of a folder as (filename, pixels); each file is seen once per checkpoint."""
    files = (
        spark.readStream.format("image").schema(IMAGE_SOURCE)
        .option("maxFilesPerTrigger", max_files).load(folder)
    )
    name = paths.last_element(paths.plain_path(F.col("image.origin")))
    return packed_files(files).select(name.alias("filename"), pixels_of_image_source(F.col("image")).alias("pixels"))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps in its checkpoint; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"].replace("-", "")


def batch_time(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """When a batch was planned, the same each time it is run."""
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}").where(F.col("value").contains("batchTimestampMs"))
    return F.timestamp_millis(F.lit(json.loads(lines.first()[0])["batchTimestampMs"]))


def score_inbox_stream(
    spark: SparkSession,
    folder: str,
    make_predict_fn: Callable,
    history_path: str,
    checkpoint: str,
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Score what has arrived, append it to the history, stop when the inbox is drained.

    The history folder is named by query and batch number, and the batch keeps the time it was planned at, so a
    batch repeated after a failure replaces itself; the checkpoint keeps scored files from being scored again.

    Spark looks the files of a trigger up in a job with a task for each of them, up to a setting, which is lowered in
    a session of the stream to as many tasks as a shuffle has.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(query_id(spark, checkpoint))
        query, planned = known[0], batch_time(spark, checkpoint, batch_id)
        # a trigger holds few files, which would otherwise share a few tasks
        results = run_scoring(repartition_batch(batch), make_predict_fn, f"stream_{query}_{batch_id:08d}", **options)
        append_history(history_rows(results, planned), history_path, query, batch_id)

    own = session_with(spark, {LISTING_KEY: str(task_count(spark))})
    bound_batches(own)
    return (
        inbox_stream(own, folder, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_counts(history: DataFrame, watermark: str) -> DataFrame:
    """Predictions, plates and failures per hour of a history stream.

    The watermark bounds the state: hours older than it are closed and forgotten, and rows that come later than that
    are not counted, while `history.hourly_predictions` counts them. Choose it above the longest delay of the source.
    """
    ok = F.col("status") == F.lit("success")
    return (
        history.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", "1 hour").alias("span"))
        .agg(
            F.count(F.lit(1)).alias("n_predictions"),
            F.sum("nb_plates").alias("n_plates"),
            F.count_if(~ok).alias("n_error"),
        )
        .select(F.col("span.start").alias("hour"), "n_predictions", "n_plates", "n_error")
    )


def drain_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an updating aggregate over what is there and store every batch of updates."""
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: append_history(batch, path, "counts", batch_id, time=None))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The last update of every hour."""
    updates = spark.read.parquet(path)
    newest = F.max_by(F.struct("n_predictions", "n_plates", "n_error"), "batch_id").alias("last")
    return updates.groupBy("hour").agg(newest).select("hour", "last.*")
