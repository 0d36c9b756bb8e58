"""Box geometry as Column expressions; everything here stays inside generated code.

Boxes are (cx, cy, w, h) or (x1, y1, x2, y2), normalised to 0..1 unless said otherwise.
All arithmetic is double.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.schema import IMAGE_SIZE

# Coder weights for (dx, dy, dw, dh) and the bounds of a decoded box.
CODER_WEIGHTS = (10.0, 10.0, 5.0, 5.0)
MAX_SIZE_DELTA = 4.0
MIN_DECODED_SIZE = 0.001
EPSILON = 1e-6


class Box(NamedTuple):
    """Four columns; the meaning (centre/size or corners) is that of the caller."""

    a: Column
    b: Column
    c: Column
    d: Column

    @classmethod
    def of(cls, *names: str) -> "Box":
        return cls(*[F.col(n) for n in names])

    def named(self, *names: str) -> list[Column]:
        return [c.alias(n) for c, n in zip(self, names)]


def _d(value: float) -> Column:
    return F.lit(float(value))


def clamp(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value that is not null. One reference to `value`, so nested use does not multiply work."""
    out = value
    if low is not None:
        out = F.greatest(out, _d(low))
    if high is not None:
        out = F.least(out, _d(high))
    return out


def cxcywh_to_xyxy(box: Box) -> Box:
    cx, cy, w, h = box
    return Box(cx - w / _d(2), cy - h / _d(2), cx + w / _d(2), cy + h / _d(2))


def xyxy_to_cxcywh(box: Box) -> Box:
    x1, y1, x2, y2 = box
    return Box((x1 + x2) / _d(2), (y1 + y2) / _d(2), x2 - x1, y2 - y1)


def clip_boxes(box: Box) -> Box:
    return Box(*[clamp(c, 0.0, 1.0) for c in box])


def box_iou(first: Box, second: Box) -> Column:
    """Intersection over union of two corner boxes; the union is at least 1e-6."""
    ax1, ay1, ax2, ay2 = first
    bx1, by1, bx2, by2 = second
    iw = F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), _d(0))
    ih = F.greatest(F.least(ay2, by2) - F.greatest(ay1, by1), _d(0))
    inter = iw * ih
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter
    return inter / F.greatest(union, _d(EPSILON))


def encode_boxes(gt: Box, anchor: Box) -> Box:
    """Ground truth as weighted offsets from an anchor; sizes are at least 1e-6."""
    wx, wy, ww, wh = CODER_WEIGHTS
    aw, ah = clamp(anchor.c, EPSILON), clamp(anchor.d, EPSILON)
    gw, gh = clamp(gt.c, EPSILON), clamp(gt.d, EPSILON)
    return Box(
        _d(wx) * (gt.a - anchor.a) / aw,
        _d(wy) * (gt.b - anchor.b) / ah,
        _d(ww) * F.ln(gw / aw),
        _d(wh) * F.ln(gh / ah),
    )


def decode_boxes(delta: Box, anchor: Box) -> Box:
    """Offsets back to a (cx, cy, w, h) box. The size delta is bounded before its weight divides it."""
    wx, wy, ww, wh = CODER_WEIGHTS
    dw, dh = clamp(delta.c, high=MAX_SIZE_DELTA), clamp(delta.d, high=MAX_SIZE_DELTA)
    return Box(
        clamp(delta.a / _d(wx) * anchor.c + anchor.a, 0.0, 1.0),
        clamp(delta.b / _d(wy) * anchor.d + anchor.b, 0.0, 1.0),
        clamp(F.exp(dw / _d(ww)) * anchor.c, MIN_DECODED_SIZE, 1.0),
        clamp(F.exp(dh / _d(wh)) * anchor.d, MIN_DECODED_SIZE, 1.0),
    )


def softmax_score(background: Column, foreground: Column) -> Column:
    """Probability of class 1 under a softmax over two logits."""
    return _d(1) / (_d(1) + F.exp(background - foreground))


def letterbox_params(width: Column, height: Column, size: int = IMAGE_SIZE) -> dict[str, Column]:
    """Scale, resized size and padding of an aspect-preserving fit in a size x size canvas.

    All are null when the image cannot be fitted: no size, or a side that would shrink to nothing.
    """
    w, h = width.cast("double"), height.cast("double")
    usable = (w > _d(0)) & (h > _d(0))
    scale = F.when(usable, F.least(_d(size) / w, _d(size) / h))
    new_w, new_h = F.floor(w * scale).cast("int"), F.floor(h * scale).cast("int")
    fits = (new_w >= F.lit(1)) & (new_h >= F.lit(1))
    left = F.floor((F.lit(size) - new_w) / _d(2)).cast("int")
    top = F.floor((F.lit(size) - new_h) / _d(2)).cast("int")
    return {
        "scale": F.when(fits, scale),
        "new_w": F.when(fits, new_w),
        "new_h": F.when(fits, new_h),
        "pad_x": F.when(fits, left / _d(size)),
        "pad_y": F.when(fits, top / _d(size)),
    }


def transform_box(box: Box, pad_x: Column, pad_y: Column) -> Box:
    """Move an image box into letterbox space."""
    rw, rh = _d(1) - _d(2) * pad_x, _d(1) - _d(2) * pad_y
    return Box(box.a * rw + pad_x, box.b * rh + pad_y, box.c * rw, box.d * rh)


def transform_boxes(boxes: Column, scale: Column, pad_x: Column, pad_y: Column) -> Column:
    """`transform_box` over array<array<number>>.

    A null list or a null scale gives an empty list; a null or short inner box is left out.
    """
    usable = F.filter(boxes, lambda b: b.isNotNull() & (F.size(b) >= F.lit(4)))

    def move(b: Column) -> Column:
        inner = Box(*[F.get(b, F.lit(i)).cast("double") for i in range(4)])
        return F.array(*transform_box(inner, pad_x, pad_y))

    empty = F.array().cast("array<array<double>>")
    return F.when(boxes.isNull() | scale.isNull(), empty).otherwise(F.transform(usable, move))


def inverse_letterbox(
    box: Box, pad_x: Column, pad_y: Column, width: Column, height: Column
) -> Box:
    """Corner box in letterbox space back to whole pixels of the original image; null without padding."""
    rw = F.greatest(_d(1) - _d(2) * pad_x, _d(EPSILON))
    rh = F.greatest(_d(1) - _d(2) * pad_y, _d(EPSILON))

    def back(v: Column, pad: Column, region: Column, side: Column) -> Column:
        return F.when(pad.isNotNull(), clamp((v - pad) / region, 0.0, 1.0) * side).cast("int")

    return Box(
        back(box.a, pad_x, rw, width),
        back(box.b, pad_y, rh, height),
        back(box.c, pad_x, rw, width),
        back(box.d, pad_y, rh, height),
    )


def box_features(
    box: Box, width: Column, height: Column, small_below: float = 0.01, medium_below: float = 0.05
) -> dict[str, Column]:
    """Feature columns of one normalised (cx, cy, w, h) box on a width x height image."""
    cx, cy, w, h = box
    x1, y1, x2, y2 = cxcywh_to_xyxy(box)
    area = w * h
    return {
        "x_min": x1 * width,
        "y_min": y1 * height,
        "x_max": x2 * width,
        "y_max": y2 * height,
        "bbox_area": w * width * (h * height),
        "bbox_area_norm": area,
        "aspect_ratio": F.when((h * height) != _d(0), w * width / (h * height)),
        "bbox_size_category": size_category(area, small_below, medium_below),
        "center_x_quadrant": F.when(cx < _d(0.5), "left").otherwise("right"),
        "center_y_quadrant": F.when(cy < _d(0.5), "top").otherwise("bottom"),
    }


def size_category(area: Column, small_below: float = 0.01, medium_below: float = 0.05) -> Column:
    return (
        F.when(area < _d(small_below), "small")
        .when(area < _d(medium_below), "medium")
        .otherwise("large")
    )
