"""Anchor grid and matching of ground-truth boxes to anchors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.operators.overlap import CORNERS, overlaps

# Grid resolution and anchor edge per level, in level order.
LEVELS = ((32, 0.1), (16, 0.2), (8, 0.4))
N_ANCHORS = sum(res * res for res, _ in LEVELS)

# IoU above which an anchor is positive and below which it is negative.
POSITIVE_IOU = 0.5
NEGATIVE_IOU = 0.3


def _offsets() -> list[int]:
    out, total = [], 0
    for res, _ in LEVELS:
        out.append(total)
        total += res * res
    return out


def make_anchors(spark: SparkSession) -> DataFrame:
    """The grid, row by row per level: anchor_id, lvl, cx, cy, w, h. Always N_ANCHORS rows."""
    levels = F.array(*[
        F.struct(
            F.lit(lvl).alias("lvl"), F.lit(res).alias("res"),
            F.lit(float(size)).alias("edge"), F.lit(offset).alias("first"),
        )
        for lvl, ((res, size), offset) in enumerate(zip(LEVELS, _offsets()))
    ])
    cells = spark.range(1).select(F.inline(levels))
    cells = cells.select("*", F.explode(F.sequence(F.lit(0), F.col("res") - 1)).alias("gy"))
    cells = cells.select("*", F.explode(F.sequence(F.lit(0), F.col("res") - 1)).alias("gx"))
    return cells.select(
        (F.col("first") + F.col("gy") * F.col("res") + F.col("gx")).alias("anchor_id"),
        "lvl",
        ((F.col("gx").cast("double") + F.lit(0.5)) / F.col("res")).alias("cx"),
        ((F.col("gy").cast("double") + F.lit(0.5)) / F.col("res")).alias("cy"),
        F.col("edge").alias("w"),
        F.col("edge").alias("h"),
    )


@lru_cache(maxsize=1)
def anchor_grid() -> np.ndarray:
    """The same grid as an [anchors, 4] array, for work inside tasks."""
    rows = []
    for res, size in LEVELS:
        centre = (np.arange(res) + 0.5) / res
        cy, cx = np.meshgrid(centre, centre, indexing="ij")
        edge = np.full(res * res, float(size))
        rows.append(np.stack([cx.ravel(), cy.ravel(), edge, edge], axis=1))
    return np.concatenate(rows)


def anchor_box(anchor_id) -> G.Box:
    """Centre and size of an anchor from its number alone, without a join."""
    res, edge, first = F.lit(LEVELS[0][0]), F.lit(float(LEVELS[0][1])), F.lit(0)
    for (r, s), offset in list(zip(LEVELS, _offsets()))[1:]:
        inside = anchor_id >= F.lit(offset)
        res = F.when(inside, F.lit(r)).otherwise(res)
        edge = F.when(inside, F.lit(float(s))).otherwise(edge)
        first = F.when(inside, F.lit(offset)).otherwise(first)
    cell = anchor_id - first
    gx, gy = cell % res, F.floor(cell / res)
    return G.Box(
        (gx.cast("double") + F.lit(0.5)) / res, (gy.cast("double") + F.lit(0.5)) / res, edge, edge
    )


def match_anchors(boxes: DataFrame, min_iou: float = NEGATIVE_IOU) -> DataFrame:
    """All (box, anchor) pairs with an IoU of at least `min_iou` (above zero).

    Anchors lie on regular grids, so the cells a box can match follow from its own numbers:
    an IoU of t needs an overlap of at least t times the longer edge along each axis, and a
    shorter edge of at least t times the longer. Each box makes its own few candidates; there
    is no join and no shuffle. The exact IoU test follows.
    """
    if not 0.0 < min_iou <= 1.0:
        raise ValueError("min_iou must be above 0 and at most 1")
    levels = F.array(*[
        F.struct(
            F.lit(lvl).alias("lvl"), F.lit(res).alias("res"),
            F.lit(float(size)).alias("edge"), F.lit(offset).alias("first"),
        )
        for lvl, ((res, size), offset) in enumerate(zip(LEVELS, _offsets()))
    ])
    t = F.lit(float(min_iou))
    # A hair of slack keeps rounding from losing a pair that sits right on the threshold.
    slack = F.lit(1e-9)

    def low(c: str, s: str):
        reach = (F.col(s) + F.col("edge")) / 2 - t * F.greatest(F.col(s), F.col("edge"))
        cell = F.floor((F.col(c) - reach - slack) * F.col("res") - F.lit(0.5))
        return F.greatest(cell, F.lit(0).cast("long")).cast("int")

    def high(c: str, s: str):
        reach = (F.col(s) + F.col("edge")) / 2 - t * F.greatest(F.col(s), F.col("edge"))
        cell = F.ceil((F.col(c) + reach + slack) * F.col("res") - F.lit(0.5))
        return F.least(cell, (F.col("res") - 1).cast("long")).cast("int")

    doubles = [F.col(c).cast("double").alias(c) for c in ("cx", "cy", "w", "h")]
    rest = [c for c in boxes.columns if c not in ("cx", "cy", "w", "h")]
    cells = (
        boxes.select(*rest, *doubles)
        .where((F.col("w") > 0) & (F.col("h") > 0))
        .select("*", F.inline(levels))
        .where(
            (F.least("w", "edge") >= (t - slack) * F.greatest("w", "edge"))
            & (F.least("h", "edge") >= (t - slack) * F.greatest("h", "edge"))
        )
        .select("*", low("cx", "w").alias("x0"), high("cx", "w").alias("x1"),
                low("cy", "h").alias("y0"), high("cy", "h").alias("y1"))
        # sequence() counts down when its bounds are swapped
        .where((F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1")))
    )
    cells = cells.select("*", F.explode(F.sequence("y0", "y1")).alias("gy"))
    cells = cells.select("*", F.explode(F.sequence("x0", "x1")).alias("gx"))
    acx = (F.col("gx").cast("double") + F.lit(0.5)) / F.col("res")
    acy = (F.col("gy").cast("double") + F.lit(0.5)) / F.col("res")
    anchor = G.cxcywh_to_xyxy(G.Box(acx, acy, F.col("edge"), F.col("edge")))
    iou = G.box_iou(anchor, G.cxcywh_to_xyxy(G.Box.of("cx", "cy", "w", "h")))
    return cells.select(
        *rest, "cx", "cy", "w", "h", "lvl",
        (F.col("first") + F.col("gy") * F.col("res") + F.col("gx")).alias("anchor_id"),
        iou.alias("iou"),
    ).where(F.col("iou") >= t)


def match_anchor_table(boxes: DataFrame, anchors: DataFrame, min_iou: float = NEGATIVE_IOU) -> DataFrame:
    """`match_anchors` for an anchor table of the caller (anchor_id, cx, cy, w, h), of any places and sizes.

    Boxes and anchors meet in a tile index, so no box is compared with an anchor that it can't reach. The
    anchor's own box comes as `acx`, `acy`, `aw`, `ah`.
    """
    if not 0.0 < min_iou <= 1.0:
        raise ValueError("min_iou must be above 0 and at most 1")

    def cornered(frame: DataFrame) -> DataFrame:
        doubles = frame.withColumns({c: F.col(c).cast("double") for c in ("cx", "cy", "w", "h")})
        doubles = doubles.where((F.col("w") > 0) & (F.col("h") > 0))
        return doubles.withColumns(dict(zip(CORNERS, G.cxcywh_to_xyxy(G.Box.of("cx", "cy", "w", "h")))))

    pairs = overlaps(cornered(boxes), cornered(anchors.select("anchor_id", "cx", "cy", "w", "h")), min_iou)
    rest = [c for c in boxes.columns if c not in ("cx", "cy", "w", "h")]
    return pairs.select(
        *[F.col("a")[c].alias(c) for c in (*rest, "cx", "cy", "w", "h")], "b.anchor_id",
        *[F.col("b")[c].alias(f"a{c}") for c in ("cx", "cy", "w", "h")], "iou",
    )


def best_gt(pairs: DataFrame, on: Sequence[str] = ("image_name",)) -> DataFrame:
    """Per image and anchor the best IoU and its box; equal IoU goes to the smallest box in box order.

    The box travels inside the maximum, so no second join fetches it. Partial maxima are built
    before the shuffle: an image gives at most N_ANCHORS rows per task however many boxes it has.
    """
    box = F.struct("cx", "cy", "w", "h")
    rank = F.struct(F.col("iou"), -F.col("cx"), -F.col("cy"), -F.col("w"), -F.col("h"))
    return (
        pairs.groupBy(*on, "anchor_id")
        .agg(F.max("iou").alias("best_iou"), F.max_by(box, rank).alias("gt"))
        .select(*on, "anchor_id", "best_iou", "gt.cx", "gt.cy", "gt.w", "gt.h")
    )


def assignment(iou):
    """positive, negative or ignored, by the best IoU of an anchor; no IoU counts as 0."""
    value = F.coalesce(iou, F.lit(0.0))
    return (
        F.when(value > F.lit(POSITIVE_IOU), "positive")
        .when(value < F.lit(NEGATIVE_IOU), "negative")
        .otherwise("ignored")
    )


def anchor_assignment(images: DataFrame, boxes: DataFrame, on: Sequence[str] = ("image_name",)) -> DataFrame:
    """Per image the number of positive, ignored and negative anchors.

    Anchors that no box reaches are negative and never become rows.
    """
    kinds = best_gt(match_anchors(boxes), on).select(*on, assignment(F.col("best_iou")).alias("kind"))
    counts = kinds.groupBy(*on).agg(
        F.count_if(F.col("kind") == "positive").alias("positive"),
        F.count_if(F.col("kind") == "ignored").alias("ignored"),
    )
    zero = F.lit(0).cast("long")
    out = images.select(*on).join(counts, list(on), "left")
    out = out.withColumns({c: F.coalesce(F.col(c), zero) for c in ("positive", "ignored")})
    return out.withColumn("negative", F.lit(N_ANCHORS).cast("long") - F.col("positive") - F.col("ignored"))


def anchor_coverage(boxes: DataFrame) -> DataFrame:
    """Boxes with and without a positive anchor, by size class and by the level of the best anchor.

    A box looks for its own best anchor inside its own row, so there is no shuffle before the count.
    """
    size = G.size_category(F.col("w").cast("double") * F.col("h").cast("double"))
    best = best_anchor_column(boxes.select(size.alias("size_class"), "cx", "cy", "w", "h"))
    matched = F.coalesce(F.col("best.iou") > F.lit(POSITIVE_IOU), F.lit(False))
    return (
        best.groupBy("size_class", F.when(matched, F.col("best.lvl")).otherwise(F.lit(-1)).alias("lvl"))
        .agg(F.count(F.lit(1)).alias("n_boxes"))
    )


def best_anchor_column(boxes: DataFrame) -> DataFrame:
    """Adds `best`: the highest IoU with any anchor and the level it is on (lowest level on ties).

    On a grid of equal squares the overlap along each axis is largest for the nearest centre,
    and IoU grows with the overlap; so one nearest cell per level is enough, no expansion.
    """
    c = {n: F.col(n).cast("double") for n in ("cx", "cy", "w", "h")}
    gt = G.cxcywh_to_xyxy(G.Box(c["cx"], c["cy"], c["w"], c["h"]))
    options = []
    for lvl, (res, edge) in enumerate(LEVELS):
        def centre(v):
            cell = G.clamp(F.floor(v * F.lit(res)).cast("double"), 0.0, float(res - 1))
            return (cell + F.lit(0.5)) / F.lit(res)

        anchor = G.Box(centre(c["cx"]), centre(c["cy"]), F.lit(float(edge)), F.lit(float(edge)))
        options.append(F.struct(
            G.box_iou(G.cxcywh_to_xyxy(anchor), gt).alias("iou"), F.lit(-lvl).alias("order"), F.lit(lvl).alias("lvl")
        ))
    return boxes.withColumn("best", F.greatest(*options))
