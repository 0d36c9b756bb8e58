"""Image operators: Arrow batches in, Arrow batches out, one image at a time in memory.

Only pixels pass through Python. Geometry of the same images is computed by the column
expressions of `boxlake.functions.geometry`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import pixels as P
from boxlake.functions.paths import last_element, plain_path
from boxlake.operators.batching import packed_files, repartition_batch, spread_by
from boxlake.schema import IMAGE_SIZE, LETTERBOX, PIXELS
from boxlake.session import bound_batches, scratch_dir, written
from boxlake.sources.sinks import write_artifact_files

# Colour and width of painted boxes, height of the label above a box.
BOX_COLOUR = (0, 255, 0)
BOX_WIDTH = 3
LABEL_RISE = 20
UNREADABLE = "cannot identify image file"
# Images whose results leave a Python worker together: a picture of a few pixels becomes a canvas of 200 KB or a tensor of 800 KB.
IMAGES_A_SLICE = 16

_PIXELS_ARROW = pa.struct([
    ("width", pa.int32()), ("height", pa.int32()), ("rgb", pa.binary()), ("error", pa.string())
])
_LETTERBOX_ARROW = pa.struct([
    ("image", pa.binary()), ("scale", pa.float64()), ("pad_x", pa.float64()), ("pad_y", pa.float64())
])


def _array(item: dict | None) -> np.ndarray | None:
    """Pixels of a decoded struct, or None."""
    if item is None or item["error"] is not None or item["rgb"] is None:
        return None
    return np.frombuffer(item["rgb"], np.uint8).reshape(item["height"], item["width"], 3)


def _pixel_item(pixels: np.ndarray) -> dict:
    height, width = pixels.shape[:2]
    return {"width": width, "height": height, "rgb": np.ascontiguousarray(pixels).tobytes(), "error": None}


def _failed(error: str) -> dict:
    return {"width": None, "height": None, "rgb": None, "error": error}


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of Arrow batches, a few at a time."""
    for batch in batches:
        for first in range(0, len(batch), IMAGES_A_SLICE):
            yield batch.slice(first, IMAGES_A_SLICE)


def _once(udf):
    """Mark a column function so that Spark never runs it a second time below a pushed-down filter."""
    return udf.asNondeterministic()


def decode_rgb(rows: DataFrame, content: str = "content", into: str = "pixels") -> DataFrame:
    """Rows with a column of image bytes plus a struct of width, height, rgb and error; a bad image is a row, not a failed job.

    Spark's `image` source decodes, and reads files only: the rows are written once, their bytes are staged as files in
    the shared folder, each content once under its digest, and the pixels meet the rows again by digest. The names
    of the staged files lie on the driver, as those of any folder Spark reads; files that are already stored are better read
    with `scan_image_pixels` or `scan_inbox_pixels`. Null and unreadable bytes give an error, equal bytes are decoded
    once, a column called `into` is replaced, and an empty table gives no rows. All runs when the function is called.
    """
    spark, name = rows.sparkSession, "__image_file"
    bound_batches(spark)
    held = written(rows.drop(into).withColumn(name, F.sha2(content, 256)), "encoded")
    folder = scratch_dir(spark, "images")
    staged = held.where(F.col(content).isNotNull()).dropDuplicates([name]).select(
        F.concat(F.substring(name, 1, 2), F.lit("/"), name).alias("path"), F.col(content).alias("content")
    )
    failed = F.struct(
        *[F.lit(None).cast(kind).alias(field) for field, kind in (("width", "int"), ("height", "int"), ("rgb", "binary"))],
        F.lit(UNREADABLE).alias("error"),
    )
    # sized by bytes alone, small files and pixels would be packed into too few tasks
    if not write_artifact_files(repartition_batch(staged), folder):
        return held.drop(name).withColumn(into, failed)
    found = spark.read.format("image").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(folder)
    decoded = packed_files(found).select(
        last_element(plain_path(F.col("image.origin"))).alias(name), pixels_of_image_source(F.col("image")).alias(into)
    )
    met = spread_by(held, [name]).join(spread_by(decoded, [name]), name, "left")
    return met.drop(name).withColumn(into, F.coalesce(F.col(into), failed))


def pixels_of_image_source(image: Column) -> Column:
    """The struct of Spark's `image` source (decoded on executors, channels in BGR order) as RGB pixels."""
    @F.arrow_udf(PIXELS)
    def run(width: pa.Array, height: pa.Array, channels: pa.Array, data: pa.Array) -> pa.Array:
        out = []
        for w, h, c, cell in zip(width.to_pylist(), height.to_pylist(), channels.to_pylist(), data):
            if w is None or w <= 0 or h <= 0:
                out.append(_failed(UNREADABLE))
                continue
            cells = np.frombuffer(cell.as_py(), np.uint8).reshape(h, w, c)
            out.append(_pixel_item(P.to_rgb(cells) if c < 3 else cells[:, :, 2::-1]))
        return pa.array(out, _PIXELS_ARROW)

    return _once(run)(image["width"], image["height"], image["nChannels"], image["data"])


def _map_pixels(work: Callable[[np.ndarray], object], returns, arrow_type: pa.DataType) -> Callable[[Column], Column]:
    """A column function from a pixel struct to whatever `work` makes of one image; null on failure.

    Results leave in slices of their own: they may be hundreds of times larger than the pixels they come from.
    """
    def one(cell: pa.Scalar):
        pixels = _array(cell.as_py())
        try:
            return None if pixels is None else work(pixels)
        except ValueError:
            return None

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in _slices(batches):
            yield pa.array([one(c) for c in rows], arrow_type)

    return _once(run)


def letterbox_resize(pixels: Column, size: int = IMAGE_SIZE, as_png: bool = False) -> Column:
    """struct(image, scale, pad_x, pad_y) of a pixel struct; null when it cannot be fitted.

    `image` is raw RGB of size x size, or a PNG file when it is meant to be stored.
    """
    def work(one: np.ndarray) -> dict:
        canvas, scale, pad_x, pad_y = P.letterbox(one, size)
        image = P.encode_png(canvas) if as_png else canvas.tobytes()
        return {"image": image, "scale": scale, "pad_x": pad_x, "pad_y": pad_y}

    return _map_pixels(work, LETTERBOX, _LETTERBOX_ARROW)(pixels)


def stretch_resize(pixels: Column, size: int = IMAGE_SIZE, as_png: bool = False) -> Column:
    """Resize without keeping the aspect ratio."""
    def work(one: np.ndarray) -> bytes:
        out = P.stretch(one, size)
        return P.encode_png(out) if as_png else out.tobytes()

    return _map_pixels(work, "binary", pa.binary())(pixels)


def normalize_tensor(image: Column, size: int = IMAGE_SIZE) -> Column:
    """Raw RGB of size x size to the flat channel-first model input, array<float>."""
    def one(cell: pa.Scalar):
        raw = cell.as_py()
        return None if raw is None else P.normalize(np.frombuffer(raw, np.uint8).reshape(size, size, 3))

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in _slices(batches):
            yield pa.array([one(c) for c in rows], pa.list_(pa.float32()))

    return _once(run)(image)


def encode_png(pixels: Column) -> Column:
    return _map_pixels(P.encode_png, "binary", pa.binary())(pixels)


def paint_boxes(pixels: Column, detections: Column, colour=BOX_COLOUR, width: int = BOX_WIDTH) -> Column:
    """A PNG of the image with its detections outlined."""
    @F.arrow_udf("binary")
    def run(images: pa.Array, boxes: pa.Array) -> pa.Array:
        out = []
        for cell, found in zip(images, boxes):
            one = _array(cell.as_py())
            corners = [(d["x_min"], d["y_min"], d["x_max"], d["y_max"]) for d in found.as_py() or []]
            out.append(None if one is None else P.encode_png(P.paint_boxes(one, corners, colour, width)))
        return pa.array(out, pa.binary())

    return _once(run)(pixels, detections)


def annotate_plan(rows: DataFrame) -> DataFrame:
    """Draw list: one row per detection with its rectangle, label text and label position."""
    rest = [c for c in rows.columns if c != "detections"]
    d = F.col("d")
    return rows.select(*rest, F.posexplode("detections").alias("pos", "d")).select(
        *rest,
        (F.col("pos") + 1).alias("number"),
        d["x_min"].alias("x_min"), d["y_min"].alias("y_min"), d["x_max"].alias("x_max"), d["y_max"].alias("y_max"),
        F.lit("#%02X%02X%02X" % BOX_COLOUR).alias("box_color"),
        F.lit(BOX_WIDTH).alias("box_width"),
        # the exact value decides on the last digit, as in C and Python; `%.2f` of format_string rounds the printed digits
        F.concat(
            F.lit("Plate "), (F.col("pos") + 1).cast("string"), F.lit(": "),
            F.call_function("format_number", d["confidence"], F.lit("0.00")),
        ).alias("label"),
        d["x_min"].alias("label_x"),
        (d["y_min"] - LABEL_RISE).alias("label_y"),
    )


def base64_payload(image: Column, wanted: bool = True) -> Column:
    """The annotated image as base64 text, without line breaks, when asked for."""
    return F.replace(F.base64(image), F.lit("\r\n"), F.lit("")) if wanted else F.lit(None).cast("string")
