"""Prediction history: views, totals, newest rows, uploads, migration of the old layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.functions import paths
from boxlake.functions.text import parse_detections

# Newest rows shown by the service and by the dashboard, rows its totals cover.
SERVICE_LIMIT, DASHBOARD_LIMIT, PAGE_LIMIT, STATS_ROWS = 30, 50, 100, 1000
SERVICE_LIMIT_BOUNDS = (1, 100)

# First bytes of the image kinds a stored payload may hold.
IMAGE_MAGIC = ("FFD8FF", "89504E470D0A1A0A")


def _newest() -> list[Column]:
    return [F.col("timestamp").desc(), F.col("event_id").desc()]


def check_service_limit(limit: int) -> int:
    low, high = SERVICE_LIMIT_BOUNDS
    if not low <= limit <= high:
        raise ValueError(f"limit must be between {low} and {high}, got {limit}")
    return limit


def latest_history(history: DataFrame, limit: int = SERVICE_LIMIT) -> DataFrame:
    """Newest rows first; a top-k, so no full sort."""
    return history.orderBy(*_newest()).limit(limit)


def history_view(history: DataFrame) -> DataFrame:
    """Display columns with defaults; time cut to seconds."""
    return history.select(
        F.date_trunc("second", F.col("timestamp")).alias("datetime"),
        F.coalesce("image_name", F.lit("")).alias("filename"),
        F.coalesce("nb_plates", F.lit(0)).alias("nb_plates"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.coalesce("detections", F.lit("[]")).alias("detections"),
        *[
            F.coalesce(c, F.lit("")).alias(c)
            for c in ("original_image_path", "annotated_image_path") if c in history.columns
        ],
        *[c for c in ("event_id",) if c in history.columns],
    )


def history_stats(history: DataFrame, newest: int | None = None) -> DataFrame:
    """Predictions and plates in total, over all rows or the `newest` ones (the service shows STATS_ROWS)."""
    rows = history if newest is None else history.orderBy(*_newest()).limit(newest)
    return rows.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.sum("nb_plates"), F.lit(0).cast("long")).alias("total_plates"),
    )


def history_by_run(history: DataFrame) -> DataFrame:
    """Predictions and plates per run folder."""
    run = paths.run_from_path(F.col("original_image_path"))
    return history.groupBy(run.alias("run_id")).agg(
        F.count(F.lit(1)).alias("total_images"), F.sum("nb_plates").alias("total_plates")
    )


def batch_totals(results: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Images scored (failures included), plates, successes and failures per request."""
    ok = F.col("status") == F.lit("success")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_images"),
        F.coalesce(F.sum("nb_plates"), F.lit(0).cast("long")).alias("total_plates"),
        F.count_if(ok).alias("n_success"),
        F.count_if(~ok).alias("n_error"),
    )


def explode_detections(rows: DataFrame, column: str = "detections", keep_empty: bool = True) -> DataFrame:
    """One row per detection; `keep_empty` keeps rows without any."""
    rest = [c for c in rows.columns if c != column]
    unfold = F.inline_outer if keep_empty else F.inline
    return rows.select(*rest, unfold(column))


def parsed_history(history: DataFrame) -> DataFrame:
    return history.withColumn("detections", parse_detections(F.col("detections")))


def hourly_predictions(history: DataFrame) -> DataFrame:
    """Predictions, plates and failures per hour and status kind."""
    ok = F.col("status") == F.lit("success")
    return (
        history.groupBy(F.window(F.col("timestamp"), "1 hour").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n_predictions"),
            F.sum("nb_plates").alias("n_plates"),
            F.count_if(~ok).alias("n_error"),
        )
        .select(F.col("hour.start").alias("hour"), "n_predictions", "n_plates", "n_error")
    )


def named_images(uploads: DataFrame) -> DataFrame:
    """Images of an upload under their names without folders; an unnamed file is called after its place `seq`."""
    return uploads.where(F.col("content_type").startswith("image/")).withColumn(
        "filename",
        F.when(
            F.coalesce("filename", F.lit("")) == "", F.concat(F.lit("img_"), F.col("seq").cast("string"), F.lit(".jpg"))
        ).otherwise(paths.base_name(F.col("filename"))),
    )


def upload_filter(uploads: DataFrame) -> DataFrame:
    """Images of an upload: type image/*, name without folders, the last of equal names.

    Needs `filename`, `content_type` and the upload order `seq`. Spark keeps one row per name and task
    before the shuffle. `streaming.uploads` does the same across the triggers of a stream.
    """
    named = named_images(uploads)
    last = W.partitionBy("filename").orderBy(F.col("seq").desc())
    return named.withColumn("rn", F.row_number().over(last)).where(F.col("rn") == 1).drop("rn")


def require_images(uploads: DataFrame) -> DataFrame:
    """The same rows, or an error when there are none."""
    if uploads.isEmpty():
        raise ValueError("no valid images provided")
    return uploads


def payload_bytes(text: Column) -> Column:
    """Image bytes of a base64 payload; null for anything that is no base64 or no image."""
    raw = F.try_to_binary(text, F.lit("base64"))
    start = F.hex(F.substring(raw, 1, 8))
    is_image = F.lit(False)
    for magic in IMAGE_MAGIC:
        is_image = is_image | start.startswith(magic)
    return F.when(is_image, raw)


def migrate_history(legacy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old six-column rows (last field a base64 image) to the seven-column layout.

    Takes rows read with the seven-column schema. A row that already has a seventh field, or a sixth
    that is a stored path, is in the new layout and keeps its paths. Returns the history and an artifact table (path, content) for
    the images taken out of the rows.
    """
    has_seven = F.col("annotated_image_path").isNotNull()
    is_path = F.coalesce(F.col("original_image_path").startswith("images/"), F.lit(False))
    content = F.when(~has_seven & ~is_path, payload_bytes(F.col("original_image_path")))
    stamp = F.date_format(F.try_to_timestamp("timestamp"), "yyyyMMdd_HHmmss")
    folder = F.concat(F.lit("images/runs/migrated"), F.coalesce(F.concat(F.lit("_"), stamp), F.lit("_migrated")))
    # named by content as well: images of one second keep apart, equal ones share a file
    target = F.concat(folder, F.lit("/migrated_"), F.substring(F.sha2("content", 256), 1, 16), F.lit("_ann.jpg"))
    staged = legacy.withColumn("content", content).withColumn("target", target)
    empty = F.lit("")
    history = staged.select(
        "timestamp", "image_name", "nb_plates", "detections", "status",
        F.when(has_seven | is_path, F.coalesce("original_image_path", empty)).otherwise(empty)
        .alias("original_image_path"),
        F.when(has_seven, F.col("annotated_image_path"))
        .when(F.col("content").isNotNull(), F.col("target")).otherwise(empty).alias("annotated_image_path"),
    )
    artifacts = (
        staged.where(F.col("content").isNotNull())
        .groupBy(F.col("target").alias("path"))
        .agg(F.first("content").alias("content"))
    )
    return history, artifacts


def needs_migration(header: Sequence[str]) -> bool:
    """True for the old header; an unknown or a new header is left alone."""
    return "annotated_image_path" not in header and "annotated_image" in header


def resolve_artifacts(history: DataFrame, artifacts: DataFrame, column: str = "original_image_path") -> DataFrame:
    """Stored image bytes beside their history rows; null for no path, a missing file, or a path
    that leaves the base folder. `artifacts` has `path` and `content`."""
    safe = F.coalesce(paths.inside_base(F.col(column)), F.lit(False))
    found = artifacts.select(F.col("path").alias(column), "content")
    # rows without a usable path need no join; as null keys they would all meet in one task
    return history.where(safe).join(found, column, "left").unionByName(
        history.where(~safe), allowMissingColumns=True
    )
