"""Evaluation job: predictions and labels -> losses per image, batch and epoch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.operators import batching as B
from boxlake.operators import training_loss as TL


def target_boxes(labels: DataFrame, n: int, on=("image_name",)) -> tuple[DataFrame, DataFrame]:
    """The boxes a padded example of width `n` holds, and per image with more than that the number dropped."""
    held = B.first_objects(labels, on, n).drop("slot")
    counts = labels.groupBy(*on).agg((F.count("*") - n).alias("n_dropped"))
    return held, counts.where(F.col("n_dropped") > 0)


def batch_losses(
    images: DataFrame, wide: DataFrame, labels: DataFrame, key: Column, order: Column, batch_size: int = 16,
    predict: TL.Predict | None = None,
) -> DataFrame:
    """Loss per split and batch of the images that have predictions, over all boxes.

    With `predict`, `wide` holds the images whose predictions it makes. For the losses of padded examples pass the first result of `target_boxes` as labels.
    """
    per_image = TL.image_loss(wide, labels, predict=predict)
    batches = B.make_batches(images, key, order, batch_size=batch_size).select("image_name", "split_name", "batch_id")
    joined = per_image.join(batches, "image_name")
    return TL.batch_loss(joined, ["split_name", "batch_id"])


def epoch_losses(per_batch: DataFrame) -> DataFrame:
    """Mean over the batches of each split."""
    return TL.epoch_metrics(per_batch, ["split_name"])
