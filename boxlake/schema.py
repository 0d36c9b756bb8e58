"""Schemas of the stored and exchanged tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Split folder name -> split number; any other name counts as "test".
SPLIT_IDS = {"train": 0, "valid": 1, "test": 2}
OTHER_SPLIT_ID = 2

# Letterbox edge, objects per padded example, images per batch.
IMAGE_SIZE = 256
MAX_OBJECTS = 20
BATCH_SIZE = 16

BOX_FIELDS = ["class_id", "cx", "cy", "w", "h"]

DETECTION = T.StructType([
    T.StructField("confidence", T.DoubleType()),
    T.StructField("x_min", T.IntegerType()),
    T.StructField("y_min", T.IntegerType()),
    T.StructField("x_max", T.IntegerType()),
    T.StructField("y_max", T.IntegerType()),
])
DETECTIONS = T.ArrayType(DETECTION)

SCORING_INPUT = T.StructType([
    T.StructField("filename", T.StringType(), False),
    T.StructField("image_bytes", T.BinaryType(), False),
])

# `timestamp` stays text at the file border: writers use ISO-8601 with or without fractions.
HISTORY_CSV = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("image_name", T.StringType()),
    T.StructField("nb_plates", T.StringType()),
    T.StructField("detections", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("original_image_path", T.StringType()),
    T.StructField("annotated_image_path", T.StringType()),
])

EPOCH_LOG = T.StructType([
    T.StructField("epoch", T.IntegerType()),
    T.StructField("train_loss", T.DoubleType()),
    T.StructField("train_cls_loss", T.DoubleType()),
    T.StructField("train_reg_loss", T.DoubleType()),
    T.StructField("val_loss", T.DoubleType()),
    T.StructField("val_cls_loss", T.DoubleType()),
    T.StructField("val_reg_loss", T.DoubleType()),
    T.StructField("lr", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

# Decoded pixels: row-major, three bytes per pixel.
PIXELS = T.StructType([
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("rgb", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

LETTERBOX = T.StructType([
    T.StructField("image", T.BinaryType()),
    T.StructField("scale", T.DoubleType()),
    T.StructField("pad_x", T.DoubleType()),
    T.StructField("pad_y", T.DoubleType()),
])
