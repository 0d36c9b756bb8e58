import math

import pytest
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions import losses, paths
from boxlake.operators.anchors import anchor_box, anchor_grid


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def lits(*values):
    return G.Box(*[F.lit(float(v)) for v in values])


def test_corner_and_centre_forms(spark):
    row = one(spark, *G.cxcywh_to_xyxy(lits(0.5, 0.4, 0.2, 0.1)))
    assert list(row) == pytest.approx([0.4, 0.35, 0.6, 0.45])
    row = one(spark, *G.xyxy_to_cxcywh(lits(0.4, 0.35, 0.6, 0.45)))
    assert list(row) == pytest.approx([0.5, 0.4, 0.2, 0.1])


@pytest.mark.parametrize("a, b, expected", [
    ((0, 0, 1, 1), (0, 0, 1, 1), 1.0),
    ((0, 0, 1, 1), (0.5, 0, 1.5, 1), 1 / 3),
    ((0, 0, 1, 1), (1, 0, 2, 1), 0.0),
    ((0, 0, 1, 1), (3, 3, 4, 4), 0.0),
    ((0, 0, 0, 0), (0, 0, 0, 0), 0.0),
])
def test_box_iou(spark, a, b, expected):
    assert one(spark, G.box_iou(lits(*a), lits(*b)))[0] == pytest.approx(expected)


@pytest.mark.parametrize("w, h, new, pads", [
    (640, 480, (256, 192), (0.0, 32 / 256)),
    (480, 640, (192, 256), (32 / 256, 0.0)),
    (256, 256, (256, 256), (0.0, 0.0)),
    (300, 217, (256, 185), (0.0, 35 / 256)),
    (100, 100, (256, 256), (0.0, 0.0)),
])
def test_letterbox_params(spark, w, h, new, pads):
    got = G.letterbox_params(F.lit(w), F.lit(h))
    row = one(spark, *[c.alias(n) for n, c in got.items()])
    assert (row.new_w, row.new_h) == new
    assert (row.pad_x, row.pad_y) == pads


def test_letterbox_of_a_strip_or_nothing_is_null(spark):
    for w, h in ((1000, 1), (0, 10), (-1, -1)):
        got = G.letterbox_params(F.lit(w), F.lit(h))
        assert all(v is None for v in one(spark, *[c.alias(n) for n, c in got.items()]))


def test_transform_boxes_skips_bad_boxes(spark):
    boxes = F.array(F.array(*[F.lit(0.5)] * 4), F.array(F.lit(0.1)), F.lit(None).cast("array<double>"))
    out = one(spark, G.transform_boxes(boxes, F.lit(1.0), F.lit(0.25), F.lit(0.0)))[0]
    assert out == [[0.5, 0.5, 0.25, 0.5]]
    none = F.lit(None).cast("array<array<double>>")
    assert one(spark, G.transform_boxes(none, F.lit(1.0), F.lit(0.0), F.lit(0.0)))[0] == []
    assert one(spark, G.transform_boxes(boxes, F.lit(None), F.lit(0.0), F.lit(0.0)))[0] == []


def test_inverse_letterbox_returns_within_a_pixel(spark):
    rows = spark.range(200).select(
        (F.rand(1) * 0.5 + 0.25).alias("cx"), (F.rand(2) * 0.5 + 0.25).alias("cy"),
        (F.rand(3) * 0.2).alias("w"), (F.rand(4) * 0.2).alias("h"),
        (F.floor(F.rand(5) * 900) + 40).cast("int").alias("img_w"), (F.floor(F.rand(6) * 900) + 40).cast("int").alias("img_h"),
    )
    fitted = rows.withColumns(G.letterbox_params(F.col("img_w"), F.col("img_h")))
    moved = G.transform_box(G.Box.of("cx", "cy", "w", "h"), F.col("pad_x"), F.col("pad_y"))
    back = G.inverse_letterbox(
        G.cxcywh_to_xyxy(moved), F.col("pad_x"), F.col("pad_y"), F.col("img_w"), F.col("img_h")
    )
    origin = G.cxcywh_to_xyxy(G.Box.of("cx", "cy", "w", "h"))
    sides = (F.col("img_w"), F.col("img_h")) * 2
    worst = F.greatest(*[F.abs(b - F.floor(o * s)) for b, o, s in zip(back, origin, sides)])
    assert fitted.agg(F.max(worst)).first()[0] <= 1


def test_inverse_letterbox_without_padding_is_null(spark):
    none = F.lit(None).cast("double")
    assert list(one(spark, *G.inverse_letterbox(lits(0, 0, 1, 1), none, none, F.lit(10), F.lit(10)))) == [None] * 4


def test_encode_then_decode(spark):
    gt, anchor = lits(0.52, 0.47, 0.12, 0.08), lits(0.5, 0.5, 0.1, 0.1)
    assert list(one(spark, *G.decode_boxes(G.encode_boxes(gt, anchor), anchor))) == pytest.approx([0.52, 0.47, 0.12, 0.08])


def test_decode_bounds(spark):
    row = one(spark, *G.decode_boxes(lits(100, -100, 50, -50), lits(0.5, 0.5, 0.2, 0.2)))
    assert list(row) == pytest.approx([1.0, 0.0, math.exp(0.8) * 0.2, 0.001])


def test_anchor_numbers_give_the_grid(spark):
    rows = spark.range(len(anchor_grid())).select(*anchor_box(F.col("id").cast("int"))).toPandas().to_numpy()
    assert abs(rows - anchor_grid()).max() < 1e-15


def test_focal_loss_and_overflow(spark):
    p = 1 / (1 + math.exp(-1.0))
    row = one(
        spark, losses.focal_loss(F.lit(0.0), F.lit(1.0), F.lit(1)), losses.focal_loss(F.lit(0.0), F.lit(1.0), F.lit(0)),
        losses.focal_loss(F.lit(0.0), F.lit(2000.0), F.lit(0)), losses.focal_loss(F.lit(0.0), F.lit(1.0), F.lit(7)),
    )
    assert row[0] == pytest.approx(0.25 * (1 - p) ** 2 * -math.log(p))
    assert row[1] == pytest.approx(0.75 * p**2 * -math.log(1 - p))
    assert row[2] == pytest.approx(0.75 * 2000.0)
    assert row[3] == row[0]


@pytest.mark.parametrize("d, beta, expected", [(0.5, 1.0, 0.125), (1.0, 1.0, 0.5), (-3.0, 1.0, 2.5), (0.5, 2.0, 0.0625)])
def test_smooth_l1(spark, d, beta, expected):
    assert one(spark, losses.smooth_l1(F.lit(d), F.lit(0.0), beta))[0] == pytest.approx(expected)


def test_features_at_the_cutoffs(spark):
    got = G.box_features(lits(0.5, 0.4, 0.1, 0.1), F.lit(200), F.lit(100))
    row = one(spark, *[c.alias(n) for n, c in got.items()])
    assert row.bbox_size_category == "medium"  # 0.1 * 0.1 is a hair above 0.01
    assert (row.center_x_quadrant, row.center_y_quadrant) == ("right", "top")
    assert row.aspect_ratio == pytest.approx(2.0)
    assert row.bbox_area == pytest.approx(200.0)


@pytest.mark.parametrize("path, split, name", [
    ("file:/data/test/train/images/a b+c.jpg", "train", "a b+c"),
    ("file:/data/valid/x/images/a.jpg", "", "a"),
    ("file:/d/valid/images/a.b.jpg", "valid", "a.b"),
    ("file:/d/valid/images/a.png", "valid", ""),
])
def test_split_and_name(spark, path, split, name):
    row = one(spark, paths.split_from_path(F.lit(path)), paths.name_from_path(F.lit(path), "jpg"))
    assert list(row) == [split, name]


@pytest.mark.parametrize("name, stem, suffix", [
    ("in/a.b.PNG", "a.b", ".png"), ("plain", "plain", ""), (".hidden", ".hidden", ""), ("x.jpg", "x", ".jpg"),
])
def test_stem_and_suffix(spark, name, stem, suffix):
    assert list(one(spark, paths.stem(F.lit(name)), paths.suffix(F.lit(name)))) == [stem, suffix]


@pytest.mark.parametrize("path, ok", [("images/a.jpg", True), ("../x", False), ("a/../../x", False), ("/etc/x", False), ("", False), ("a..b/c", True)])
def test_inside_base(spark, path, ok):
    assert one(spark, paths.inside_base(F.lit(path)))[0] is ok


def test_artifact_paths(spark):
    from datetime import datetime

    folder = paths.artifact_folder(F.lit(None).cast("string"), F.lit(datetime(2026, 3, 4, 5, 6, 7)), F.lit("abcd1234"))
    row = one(spark, *paths.artifact_paths(F.lit("x\\y"), folder, F.lit(True), F.lit(False)))
    assert row[0] == "images/2026/03/04/20260304_050607_abcd1234/x/y_orig.jpg"
    assert row[1] == ""
