"""Writers: training table, history, artifacts, predictions and epoch logs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import paths
from boxlake.schema import EPOCH_LOG


def export_splits(frame: DataFrame, path: str, files_per_split: int | None = None) -> None:
    """One write for all splits, partitioned by `split_name`, so that readers prune by split.

    `files_per_split` spreads the rows of every split over that many files by image name.
    """
    if files_per_split:
        file_no = F.pmod(F.xxhash64("image_name"), F.lit(files_per_split))
        frame = frame.repartition(files_per_split * 3, "split_name", file_no)
    frame.drop("split_id").write.partitionBy("split_name").mode("overwrite").parquet(path)


# Folder beside the batches of a history: newest and oldest time and rows per batch. Spark skips it when it reads the history.
BATCH_INDEX = "_batches"
# A time above all others: what is known of a batch until it is written whole.
_UNKNOWN = "9999-12-31 00:00:00"
_SPANS = "oldest timestamp_ntz, newest timestamp_ntz, n_rows long"


def append_history(rows: DataFrame, path: str, writer: str, batch_id: str | int, time: str | None = "timestamp") -> None:
    """One folder per writer and batch, replaced when the writer writes the batch again; so a replay adds nothing and
    writers never touch each other's batches.

    The batch index gets the span of the batch in `time` (None: no index), counted by the write itself. The batch is
    entered as unknown before it is written, so a batch left behind by a failure is read rather than missed.
    """
    place = f"writer={writer}/batch_id={batch_id}"
    batch = f"{path.rstrip('/')}/{place}"
    if time is None:
        rows.write.mode("overwrite").parquet(batch)
        return
    entry = f"{path.rstrip('/')}/{BATCH_INDEX}/{place}"
    _write_span(rows.sparkSession, entry, _UNKNOWN, _UNKNOWN, 0)
    seen = Observation()
    stamp = F.col(time).cast("timestamp_ntz")
    rows.observe(
        seen, F.min(stamp).cast("string").alias("oldest"), F.max(stamp).cast("string").alias("newest"), F.count(time).alias("n"),
    ).write.mode("overwrite").parquet(batch)
    span = seen.get
    _write_span(rows.sparkSession, entry, span["oldest"], span["newest"], span["n"])


def _write_span(spark: SparkSession, entry: str, oldest: str | None, newest: str | None, n: int) -> None:
    stamps = [F.lit(v).cast("timestamp_ntz").alias(c) for c, v in (("oldest", oldest), ("newest", newest))]
    spark.range(1, numPartitions=1).select(*stamps, F.lit(n).cast("long").alias("n_rows")).write.mode("overwrite").parquet(entry)


def read_newest_history(spark: SparkSession, path: str, schema: str, limit: int, time: str = "timestamp") -> DataFrame:
    """Rows of a history among which the `limit` newest by `time` surely are; batches without any are not opened.

    Going from the batch with the latest oldest row downwards, `limit` batches at most hold `limit` rows together; none of those
    rows is older than the oldest row passed on the way, so batches that end before it are left out. The join with the
    index prunes the folders of the history at run time. Every batch must have an entry (see `index_history`).
    """
    index = spark.read.schema(_SPANS).parquet(f"{path.rstrip('/')}/{BATCH_INDEX}")
    history = read_history(spark, path, schema)
    latest = index.where("n_rows > 0").orderBy(F.col("oldest").desc()).limit(limit).select("oldest", "n_rows").collect()
    held, bound = 0, None
    for span in latest:
        held += span.n_rows
        if held >= limit:
            bound = span.oldest
            break
    if bound is None:
        return history
    wanted = index.where(F.col("newest") >= F.lit(bound)).select("writer", "batch_id")
    return history.where(F.col(time) >= F.lit(bound)).join(wanted, ["writer", "batch_id"], "left_semi")


def index_history(spark: SparkSession, path: str, schema: str, time: str = "timestamp") -> None:
    """Enter every batch of a history written without an index, in one pass over `time`."""
    stamp = F.col(time).cast("timestamp_ntz")
    spans = read_history(spark, path, schema).groupBy("writer", "batch_id").agg(
        F.min(stamp).alias("oldest"), F.max(stamp).alias("newest"), F.count(time).alias("n_rows")
    )
    spans.repartition("writer", "batch_id").write.partitionBy("writer", "batch_id").mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_INDEX}")


def append_history_csv(rows: DataFrame, path: str, mode: str = "append") -> None:
    """History rows in the CSV layout, as new files with a header each."""
    stamped = rows.withColumn(
        "timestamp", F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    stamped.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches written by `append_history`; none when it has been purged."""
    return spark.read.schema(schema).parquet(path)


def purge_history(spark: SparkSession, path: str, schema: str) -> None:
    """Replace the history by an empty table of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    spark.createDataFrame([], _SPANS).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_INDEX}")


def store_predictions(wide: DataFrame, name: str, path: str, buckets: int, on: str = "image_name") -> DataFrame:
    """Wide predictions as a table bucketed by image: joins by image then leave its dense arrays where they are."""
    wide.write.bucketBy(buckets, on).mode("overwrite").option("path", path).saveAsTable(name)
    return wide.sparkSession.table(name)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark reads it by."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def write_artifact_files(artifacts: DataFrame, base: str) -> int:
    """Each (path, content) row as a file below `base`, a folder all executors reach; returns how many.

    A row without content, or with a path that would leave `base`, stops the write before it starts.

    Spark has no writer for single binary files, so tasks write theirs through Arrow's file systems. A
    file appears under its name only when it is whole, and a task that runs again writes the same
    bytes.
    """
    bad = artifacts.where(~F.coalesce(paths.inside_base(F.col("path")), F.lit(False)) | F.col("content").isNull())
    # counted in one pass: `first` of no rows would look through the partitions a few at a time
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.any_value("path").alias("path")).first()
    if found.n:
        raise ValueError(f"no content, or a path outside the folder: {found.path!r}")
    base = qualified(artifacts.sparkSession, base)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = urlparse(base)
        local = where.scheme in ("", "file")
        store, root = (fs.LocalFileSystem(), where.path) if local else fs.FileSystem.from_uri(base)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                target = f"{root.rstrip('/')}/{path.as_py()}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                partial = f"{target}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(partial) as out:
                    out.write(content.as_buffer())
                store.move(partial, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return artifacts.select("path", "content").mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0] or 0


def write_predictions_csv(detections: DataFrame, path: str, timestamp: str) -> None:
    """One row per image: boxes, classes and scores as JSON lists, one timestamp per batch."""
    boxes = F.transform("boxes", lambda b: F.array(b["x1"], b["y1"], b["x2"], b["y2"]))
    detections.select(
        "image_name",
        F.to_json(boxes).alias("predicted_boxes"),
        F.to_json(F.transform("boxes", lambda b: F.lit(1))).alias("predicted_classes"),
        F.to_json(F.transform("boxes", lambda b: b["score"])).alias("scores"),
        F.lit(timestamp).alias("timestamp"),
    ).write.mode("append").option("header", True).option("escape", '"').csv(path)


def epoch_log_rows(metrics: DataFrame) -> DataFrame:
    """Epoch rows as text: losses with six decimals, the learning rate with eight."""
    def fixed(name: str) -> Column:
        return F.format_string("%.8f" if name == "lr" else "%.6f", F.col(name).cast("double"))

    numbers = [n for n in EPOCH_LOG.names if n not in ("epoch", "timestamp")]
    return metrics.select("epoch", *[fixed(n).alias(n) for n in numbers], "timestamp")


def append_epoch_log(metrics: DataFrame, path: str) -> None:
    epoch_log_rows(metrics).write.mode("append").option("header", True).csv(path)
