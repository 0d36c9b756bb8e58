"""Views derived from the given tables; the inputs of the registered queries.

The SQL texts run unchanged in Spark and in other ANSI engines: table names are placeholders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.pixels import MEAN, STD, encode_png
from boxlake.operators.anchors import N_ANCHORS
from boxlake.operators.annotations import parse_labels
from boxlake.operators.batching import spread_by, with_row_number
from boxlake.session import BATCH_BYTES, bound_batches

IMAGES = """
select concat('img_', cast(o_orderkey as string)) as image_name,
 case when o_orderkey % 10 < 8 then 'train' when o_orderkey % 10 = 8 then 'valid' else 'test' end as split_name,
 cast(case when o_orderkey % 10 < 8 then 0 when o_orderkey % 10 = 8 then 1 else 2 end as int) as split_id,
 cast(320 + (o_custkey % 40) * 16 as int) as img_width, cast(240 + (o_orderkey % 30) * 17 as int) as img_height,
 o_orderkey as image_no
from {orders}
"""

LABEL_LINES = """
select concat('img_', cast(l_orderkey as string)) as image_name,
 case when l_linenumber = 7 and l_partkey % 5 = 0 then ''
      when l_linenumber = 6 and l_partkey % 5 = 0 then '0 0.500 x 0.100 0.050'
      when l_linenumber = 5 and l_partkey % 5 = 0 then '0 0.500 0.500'
      else concat('0 0.', lpad(cast(200 + (l_partkey * 7 + l_linenumber * 13) % 600 as string), 3, '0'),
        ' 0.', lpad(cast(200 + (l_suppkey * 11 + l_linenumber * 29) % 600 as string), 3, '0'),
        ' 0.', lpad(cast(20 + (l_partkey * 3 + l_linenumber) % 330 as string), 3, '0'),
        ' 0.', lpad(cast(10 + (l_suppkey * 5 + l_linenumber * 7) % 190 as string), 3, '0')) end as value
from {lineitem}
"""

# Raw model output: one image per customer, the full anchor grid for each.
PRED_COLUMNS = {
    "logit0": "cast(({k} * 31 + {a} * 17) % 997 as double) / 100 - 4",
    "logit1": "cast(({k} * 13 + {a} * 29) % 991 as double) / 100 - 5",
    "dx": "cast(({a} * 7 + {k}) % 41 as double) / 10 - 2",
    "dy": "cast(({a} * 11 + {k}) % 41 as double) / 10 - 2",
    "dw": "cast(({a} * 3 + {k}) % 61 as double) / 10 - 2",
    "dh": "cast(({a} * 5 + {k}) % 61 as double) / 10 - 3",
}

# The same formulas over arrays.
PRED_ARRAYS = {
    "logit0": lambda k, a: (k * 31 + a * 17) % 997 / 100 - 4,
    "logit1": lambda k, a: (k * 13 + a * 29) % 991 / 100 - 5,
    "dx": lambda k, a: (a * 7 + k) % 41 / 10 - 2,
    "dy": lambda k, a: (a * 11 + k) % 41 / 10 - 2,
    "dw": lambda k, a: (a * 3 + k) % 61 / 10 - 2,
    "dh": lambda k, a: (a * 5 + k) % 61 / 10 - 3,
}

# An anchor table off the grid: one anchor per part, three kinds of sizes, uneven places.
ANCHOR_TABLE = """
select cast(p_partkey as int) as anchor_id, cast(p_partkey * 37 % 997 as double) / 997 as cx, cast(p_partkey * 61 % 991 as double) / 991 as cy,
 0.01 + cast(p_partkey * 17 % 71 as double) / 71 * (case p_partkey % 3 when 0 then 0.5 when 1 then 0.2 else 0.06 end) as w,
 0.01 + cast(p_partkey * 29 % 67 as double) / 67 * (case p_partkey % 3 when 0 then 0.3 when 1 then 0.1 else 0.04 end) as h
from {part}
"""

HISTORY = """
select ts as timestamp, concat('img_', cast(user_id as string), '.jpg') as image_name,
 cast(case when event_type = 'error' then 0 else event_id % 3 end as int) as nb_plates,
 case when event_type = 'error' or event_id % 3 = 0 then '[]'
  when event_id % 3 = 1 then concat('[{{''confidence'': 0.', cast(100 + event_id % 900 as string), ', ''x_min'': ', cast(event_id % 200 as string), ', ''y_min'': 10, ''x_max'': 300, ''y_max'': 60}}]')
  else concat('[{{''confidence'': 0.9, ''x_min'': 1, ''y_min'': 2, ''x_max'': 33, ''y_max'': 14}}, {{''confidence'': 0.', cast(100 + event_id % 700 as string), ', ''x_min'': 5, ''y_min'': 6, ''x_max'': 77, ''y_max'': 28}}]') end as detections,
 case when event_type = 'error' then 'error: cannot identify image file' else 'success' end as status,
 concat('images/runs/', cast(user_id as string), '/', cast(event_id as string), '_orig.jpg') as original_image_path,
 event_id
from {events}
"""

TRAIN_LOG = """
select user_id as run_id, cast(row_number() over (partition by user_id order by ts, event_id) as int) as epoch,
 value as val_loss, ts as logged_at
from {events}
"""

UPLOADS = """
select event_id as seq, case when event_type = 'view' then '' else concat('up/img_', cast(user_id as string), '.jpg') end as filename,
 case when event_type = 'click' then 'text/plain' else 'image/jpeg' end as content_type, value
from {events}
"""

# Old-layout history rows; "purchase" rows already carry the two paths of the new layout.
LEGACY_HISTORY = """
select cast(ts as string) as timestamp, concat('img_', cast(event_id as string), '.jpg') as image_name, '1' as nb_plates,
 '[]' as detections, 'success' as status,
 case event_type when 'click' then concat('/9j/', lpad(cast(event_id % 10000 as string), 4, '0')) when 'view' then 'not base64!' when 'signup' then 'aGVsbG8='
  when 'purchase' then concat('images/2026/', cast(event_id as string), '_orig.jpg') else '' end as original_image_path,
 case when event_type = 'purchase' then concat('images/2026/', cast(event_id as string), '_ann.jpg') end as annotated_image_path
from {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    """One of the texts above over one given table."""
    return spark.sql(text, **{name: table(spark, sf_dir, name)})


def _spread(frame: DataFrame, *keys: str) -> DataFrame:
    """By key over the cores: the rows made from these keys are many times larger than the keys."""
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism, *keys)


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, UPLOADS, "events")


def legacy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, LEGACY_HISTORY, "events")


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One PNG per embedding: its 64 numbers as gray cells of an 8 x 8 picture, enlarged by row.

    Every eleventh file is cut short, so that decoding has failures to report.
    """
    @F.arrow_udf("binary")
    def paint(cells: pa.Array, across: pa.Array, down: pa.Array) -> pa.Array:
        out = []
        for values, x, y in zip(cells.to_pylist(), across.to_pylist(), down.to_pylist()):
            gray = np.clip((np.array(values) + 0.5) * 255.0, 0, 255).astype(np.uint8).reshape(8, 8)
            pixels = np.kron(gray, np.ones((y, x), np.uint8))
            out.append(encode_png(np.repeat(pixels[:, :, None], 3, axis=2)))
        return pa.array(out, pa.binary())

    paint = paint.asNondeterministic()
    rows = _spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
    across, down = (F.col("vec_id") % 5 + 2).cast("int"), (F.col("vec_id") % 3 + 2).cast("int")
    content = paint("embedding", across, down)
    cut = F.when(F.col("vec_id") % 11 == 0, F.substring("content", 1, 60)).otherwise(F.col("content"))
    return rows.select("vec_id", content.alias("content")).select(
        "vec_id", F.concat(F.lit("vec_"), F.col("vec_id").cast("string"), F.lit(".png")).alias("filename"),
        cut.alias("content"),
    )


def marked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One PNG per embedding, as large as in `image_files`, in the colour that `stub_model.make_marked` reads as
    anchor vec_id mod N_ANCHORS; every eleventh file is cut short."""
    @F.arrow_udf("binary")
    def paint(codes: pa.Array, widths: pa.Array, heights: pa.Array) -> pa.Array:
        out = []
        for code, w, h in zip(codes.to_pylist(), widths.to_pylist(), heights.to_pylist()):
            colour = np.array([code // 64 * 10, code % 64 * 4, 0], np.uint8)
            out.append(encode_png(np.broadcast_to(colour, (h, w, 3))))
        return pa.array(out, pa.binary())

    rows = _spread(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")
    sides = [(8 * (F.col("vec_id") % k + 2)).cast("int") for k in (5, 3)]
    content = paint.asNondeterministic()((F.col("vec_id") % N_ANCHORS).cast("int"), *sides)
    cut = F.when(F.col("vec_id") % 11 == 0, F.substring("content", 1, 44)).otherwise(F.col("content"))
    return rows.select("vec_id", content.alias("content")).select(
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string"), F.lit(".png")).alias("filename"), cut.alias("content")
    )


def tensor_bytes(tensor: Column) -> Column:
    """A channel-first model input scaled back to one byte per value."""
    @F.arrow_udf("binary")
    def run(batch: pa.Array) -> pa.Array:
        out = []
        for cell in batch:
            planes = cell.values.to_numpy().astype(np.float64).reshape(3, -1)
            cells = np.rint((planes * np.array(STD)[:, None] + np.array(MEAN)[:, None]) * 255.0)
            out.append(cells.astype(np.uint8).tobytes())
        return pa.array(out, pa.binary())

    return run.asNondeterministic()(tensor)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, IMAGES, "orders")


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    lines = spark.sql(LABEL_LINES, lineitem=_spread(keys, "l_orderkey"))
    # as read from a file: the generator keeps the text from being composed again by every use of it
    return lines.select(F.inline(F.array(F.struct("image_name", "value"))))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_labels(label_lines(spark, sf_dir))


# The label boxes drawn together in three scenes, from rows with a number (a long) in the order of all their columns.
CROWD = """
select concat('scene_', cast(row_no % 3 as string)) as image_name, cast(row_no as int) as anchor_id, cast((row_no * 7919) % 1009 as double) / 1009 as score,
 px - sx as x1, py - sy as y1, px + sx as x2, py + sy as y2 from (
 select *, floor(cx * 40) / 40 + (cx * 40 - floor(cx * 40)) * 0.006 as px, floor(cy * 40) / 40 + (cy * 40 - floor(cy * 40)) * 0.006 as py,
  0.006 + w / 80 as sx, 0.006 + h / 80 as sy from {numbered})
"""


def crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CROWD, numbered=with_row_number(labels(spark, sf_dir), ["image_name", "class_id", "cx", "cy", "w", "h"]))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, HISTORY, "events")


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TRAIN_LOG, "events")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long predictions: one row per image and anchor."""
    rows = prediction_images(spark, sf_dir).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(N_ANCHORS - 1))).alias("anchor_id")
    )
    values = [F.expr(t.format(k="c_custkey", a="anchor_id")).alias(n) for n, t in PRED_COLUMNS.items()]
    return rows.select("image_name", "anchor_id", *values)


def anchor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, ANCHOR_TABLE, "part")


def prediction_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images that have predictions, dealt over the cores by name: (c_custkey, image_name)."""
    name = F.concat(F.lit("img_"), F.col("c_custkey").cast("string")).alias("image_name")
    return spread_by(table(spark, sf_dir, "customer").select("c_custkey", name), ["image_name"])


# The flat arrays of a prediction row.
PRED_LISTS = {"logits": ("logit0", "logit1"), "deltas": ("dx", "dy", "dw", "dh")}


def fill_predictions(images: DataFrame, n_anchors: int = N_ANCHORS, lists: Sequence[str] = tuple(PRED_LISTS)) -> DataFrame:
    """Rows of `prediction_images` with the flat arrays that a model returns for them, made in a Python worker and handed
    over a few images at a time, in place of their keys."""
    rows_a_slice = max(1, BATCH_BYTES // (8 * n_anchors * sum(len(PRED_LISTS[c]) for c in lists)))

    @F.arrow_udf(", ".join(f"{c} array<double>" for c in lists))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a = np.arange(n_anchors)
        for batch in batches:
            for first in range(0, len(batch), rows_a_slice):
                k = batch.slice(first, rows_a_slice).to_numpy(zero_copy_only=False)[:, None]
                columns = []
                for names in (PRED_LISTS[c] for c in lists):
                    cells = np.stack([PRED_ARRAYS[n](k, a) for n in names], axis=2)
                    starts = np.arange(len(k) + 1) * (n_anchors * len(names))
                    columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(cells.ravel())))
                yield pa.StructArray.from_arrays(columns, names=list(lists))

    bound_batches(images.sparkSession)
    made = images.withColumn("made", run.asNondeterministic()(F.col("c_custkey")))
    return made.select(*[c for c in images.columns if c != "c_custkey"], *[f"made.{c}" for c in lists])


def predictions_wide(spark: SparkSession, sf_dir: str, n_anchors: int = N_ANCHORS) -> DataFrame:
    """The same predictions as a model returns them: one row per image."""
    return fill_predictions(prediction_images(spark, sf_dir), n_anchors)
