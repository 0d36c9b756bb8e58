"""Preprocessing job: image tree + label files -> training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import paths
from boxlake.operators import annotations as A
from boxlake.operators import pixels as PX
from boxlake.sources import files, sinks


def train_ready(images: DataFrame, lines: DataFrame, on: Sequence[str] = A.KEYS) -> DataFrame:
    """One row per box in letterbox space (one row of nulls per unlabeled image), without pixels."""
    fitted = A.with_letterbox(images).drop("img_width", "img_height", "new_w", "new_h")
    return A.transform_box_rows(A.join_images_boxes(fitted, A.parse_labels(lines), on))


def feature_rows(images: DataFrame, lines: DataFrame, on: Sequence[str] = A.KEYS, **cutoffs: float) -> DataFrame:
    """The documented feature table: one row per box of a labeled image."""
    return A.with_box_features(A.counted_boxes(images, A.parse_labels(lines), on), **cutoffs)


def training_images(pixels: DataFrame) -> DataFrame:
    """Letterboxed PNGs, one row per readable image, with their scale and padding."""
    fitted = pixels.withColumn("letterbox", PX.letterbox_resize(F.col("pixels"), as_png=True)).drop("pixels")
    return A.drop_failed_images(A.unpack_struct(fitted, "letterbox")).withColumnRenamed("image", "images")


def training_boxes(images: DataFrame, lines: DataFrame, on: Sequence[str] = A.KEYS) -> DataFrame:
    """Boxes in letterbox space of stored images, as floats: a row per box, a row of nulls per unlabeled image."""
    placed = images.select("image_name", "split_name", "split_id", "pad_x", "pad_y")
    moved = A.transform_box_rows(A.join_images_boxes(placed, A.build_bboxes(A.parse_labels(lines), on), on))
    return moved.drop("pad_x", "pad_y").withColumns({c: F.col(c).cast("float") for c in ("cx", "cy", "w", "h")})


def preprocess(spark: SparkSession, root: str, out: str) -> None:
    """The whole job: pixels to `out`/images without a shuffle, boxes to `out`/boxes with the same keys."""
    scanned = files.scan_image_pixels(spark, root)
    pixels = scanned.withColumn("pixels", PX.pixels_of_image_source(F.col("image"))).drop("image")
    sinks.export_splits(training_images(pixels), f"{out}/images")
    lines = files.scan_label_lines(spark, root).drop("split_id")
    stored = files.read_training_table(spark, f"{out}/images").withColumn("split_id", paths.split_id(F.col("split_name")))
    sinks.export_splits(training_boxes(stored, lines), f"{out}/boxes")
