"""Annotation operators: label lines -> boxes -> per-image targets.

Box work is done on long rows (one row per box), so that an image with very many boxes is
just many rows that Spark can split. Arrays per image are made only in padded examples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.schema import BOX_FIELDS, IMAGE_SIZE

KEYS = ("split_name", "image_name")


def _fields(parts: Column) -> dict[str, Column]:
    return {name: F.get(parts, F.lit(i)).try_cast("float") for i, name in enumerate(BOX_FIELDS)}


def filter_blank(lines: DataFrame) -> DataFrame:
    """Drop truly empty lines; a line of blanks is left to the parser."""
    return lines.where(F.col("value") != F.lit(""))


def parse_labels(lines: DataFrame) -> DataFrame:
    """`class cx cy w h` lines to float columns; lines with any missing or bad field are dropped."""
    kept = [c for c in lines.columns if c != "value"]
    parts = filter_blank(lines).select(*kept, F.split("value", " ").alias("parts"))
    fields = F.struct(*[c.alias(n) for n, c in _fields(F.col("parts")).items()])
    # The generator keeps the null test from being pushed below the parse, which would then run twice.
    return parts.select(*kept, F.inline(F.array(fields))).dropna()


def reject_reason(value: Column) -> Column:
    """Why a line does not parse; null when it does."""
    parts = F.split(value, " ")
    bad = F.lit(False)
    for column in _fields(parts).values():
        bad = bad | column.isNull()
    return (
        F.when(F.trim(value) == F.lit(""), "blank")
        .when(F.size(parts) < F.lit(len(BOX_FIELDS)), "short")
        .when(bad, "non_numeric")
    )


def label_rejects(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected lines counted by reason (and by further columns)."""
    return (
        lines.select(*by, reject_reason(F.col("value")).alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy(*by, "reason")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def build_bboxes(labels: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    """The stored targets: one row per box with its class, corners and a mask of 1.

    Rows at every size: an image with very many boxes is many rows, and nothing is shuffled. Arrays per image
    are made by `batching.pad_targets`, whose width is an argument.
    """
    return labels.select(*on, *BOX_FIELDS, F.lit(1.0).alias("pos_mask"))


def nulls_to_empty(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null arrays become empty arrays of the same type."""
    types = {f.name: f.dataType for f in frame.schema.fields}
    return frame.withColumns(
        {c: F.coalesce(F.col(c), F.array().cast(types[c])) for c in columns}
    )


def join_images_boxes(images: DataFrame, bboxes: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    """Left join of images and boxes: a row per box, a row of nulls per unlabeled image; orphan labels go.

    Pass images without pixels, which are stored once per image in a table of their own. An inner join and an
    anti join, for Spark can split a crowded key on either side of the inner join, but not on the right of a
    left join. Joining on `image_name` alone is the compatibility form; equal names in two splits then share
    their boxes.
    """
    on = list(on)
    full = images.join(bboxes, on, "inner")
    return full.unionByName(unlabeled_images(images, bboxes, on), allowMissingColumns=True)


def num_boxes(labels: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    return labels.groupBy(*on).agg(F.count(F.lit(1)).alias("num_boxes"))


def counted_boxes(images: DataFrame, labels: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    """One row per box of a labeled image, with the number of boxes of its image."""
    on = list(on)
    return images.join(num_boxes(labels, on), on).join(labels, on)


def unlabeled_images(images: DataFrame, labels: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    return images.join(labels.select(*on).distinct(), list(on), "left_anti")


def orphan_labels(images: DataFrame, labels: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    return labels.join(images.select(*on).distinct(), list(on), "left_anti")


def with_letterbox(images: DataFrame, size: int = IMAGE_SIZE) -> DataFrame:
    """Letterbox scale, size and padding from `img_width` and `img_height`."""
    return images.withColumns(G.letterbox_params(F.col("img_width"), F.col("img_height"), size))


def transform_box_rows(rows: DataFrame) -> DataFrame:
    """Move the boxes of long rows into letterbox space."""
    box = G.Box(*[F.col(c).cast("double") for c in ("cx", "cy", "w", "h")])
    moved = G.transform_box(box, F.col("pad_x"), F.col("pad_y"))
    return rows.withColumns(dict(zip(("cx", "cy", "w", "h"), moved)))


def with_box_features(rows: DataFrame, **cutoffs: float) -> DataFrame:
    """Feature columns of long rows that carry image sizes."""
    box = G.Box(*[F.col(c).cast("double") for c in ("cx", "cy", "w", "h")])
    return rows.withColumns(G.box_features(box, F.col("img_width"), F.col("img_height"), **cutoffs))


def split_filter(frame: DataFrame, split_id: int) -> DataFrame:
    """Rows of one split without the split columns."""
    return frame.where(F.col("split_id") == F.lit(split_id)).drop("split_name", "split_id")


def unpack_struct(frame: DataFrame, column: str, drop: Sequence[str] = ()) -> DataFrame:
    """Replace a struct column by its fields."""
    return frame.select("*", f"{column}.*").drop(column, *drop)


def drop_failed_images(frame: DataFrame, column: str = "image") -> DataFrame:
    return frame.where(F.col(column).isNotNull())


def count_images(images: DataFrame, batch_size: int) -> DataFrame:
    """Images and batches per split; the last batch may be short."""
    return images.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).alias("n_batches"),
    )


def dataset_stats(images: DataFrame, features: DataFrame, by_split: bool = False) -> DataFrame:
    """Images (distinct names), boxes, mean aspect ratio and mean normalised area, from images and feature rows.

    Images and boxes are stacked and summed in one pass, without bringing the boxes of an image together. A name that
    two splits share counts once in each and once in the total.
    """
    none = F.lit(None).cast("double")
    counted = images.select(
        "split_name", F.col("image_name").alias("image"), F.lit(0).alias("box"), none.alias("aspect"), none.alias("area")
    ).unionByName(features.where(F.col("cx").isNotNull()).select(
        "split_name", F.lit(None).cast("string").alias("image"), F.lit(1).alias("box"),
        F.col("aspect_ratio").alias("aspect"), F.col("bbox_area_norm").alias("area"),
    ))
    grouped = counted.rollup("split_name") if by_split else counted.groupBy()
    return grouped.agg(
        F.countDistinct("image").alias("total_images"),
        F.sum("box").alias("total_boxes"),
        F.avg("aspect").alias("avg_aspect_ratio"),
        F.avg("area").alias("avg_bbox_area_norm"),
    )
