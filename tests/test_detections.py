import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.operators import anchors as N
from boxlake.operators import detections as D

GRID = N.anchor_grid()


def iou(a, b):
    iw = max(min(a[2], b[2]) - max(a[0], b[0]), 0)
    ih = max(min(a[3], b[3]) - max(a[1], b[1]), 0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - iw * ih
    return iw * ih / max(union, 1e-6)


def plain_nms(rows, threshold, limit):
    """rows: (anchor, score, box), any order."""
    kept = []
    for row in sorted(rows, key=lambda r: (-r[1], r[0])):
        if len(kept) == limit:
            break
        if all(iou(row[2], k[2]) <= threshold for k in kept):
            kept.append(row)
    return [k[0] for k in kept]


def random_candidates(sizes, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for name, n in sizes.items():
        centre, half = rng.random((n, 2)), rng.random((n, 2)) * 0.2 + 0.01
        boxes = np.concatenate([centre - half, centre + half], axis=1)
        scores = np.round(rng.random(n), 2)  # many ties
        rows += [(name, i, float(scores[i]), *map(float, boxes[i])) for i in range(n)]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "image_name string, anchor_id int, score double, x1 double, y1 double, x2 double, y2 double")


def expected_of(rows, threshold, limit):
    names = {r[0] for r in rows}
    return {n: plain_nms([(r[1], r[2], r[3:]) for r in rows if r[0] == n], threshold, limit) for n in names}


def anchors_by_image(kept):
    out = {}
    for r in sorted(kept.collect(), key=lambda r: r.det_rank):
        out.setdefault(r.image_name, []).append(r.anchor_id)
    return out


def test_nms_equals_plain_greedy(spark):
    rows = random_candidates({f"i{k}": n for k, n in enumerate([1, 2, 60, 61, 100, 3, 40, 7] * 6)})
    kept = D.nms(frame_of(spark, rows), 0.4, 100)
    assert anchors_by_image(kept) == expected_of(rows, 0.4, 100)


def test_nms_over_several_arrow_batches(spark):
    rows = random_candidates({"big": 700, "small": 5, "mid": 90})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert anchors_by_image(D.nms(frame_of(spark, rows), 0.3, 25)) == expected_of(rows, 0.3, 25)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("limit", [10, 1000])
def test_nms_any_in_rounds(spark, limit):
    rows = random_candidates({"hot": 900, "a": 30, "b": 1, "c": 64}, seed=4)
    kept = D.nms_any(frame_of(spark, rows), 0.4, limit)
    assert anchors_by_image(kept) == expected_of(rows, 0.4, limit)


def test_nms_is_idempotent_and_of_nothing_is_nothing(spark):
    rows = random_candidates({"a": 80})
    once = D.nms(frame_of(spark, rows), 0.4)
    assert anchors_by_image(D.nms(once.drop("det_rank"), 0.4)) == anchors_by_image(once)
    assert D.nms(frame_of(spark, rows).where("score > 2")).count() == 0


def wide(spark, n, seed=2):
    rng = np.random.default_rng(seed)
    rows = [
        (f"i{k}", [float(v) for v in rng.normal(0, 2, 2 * N.N_ANCHORS)], [float(v) for v in rng.normal(0, 3, 4 * N.N_ANCHORS)])
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "image_name string, logits array<float>, deltas array<float>")


def test_predict_equals_the_long_path(spark):
    frame = wide(spark, 5)
    long = D.nms(D.candidates(D.explode_predictions(frame), 0.8), 0.4, 50)
    rows = D.predict(frame, 0.8, 0.4, 50).select("image_name", F.posexplode("boxes").alias("det_rank", "b"))
    flat = rows.select("image_name", "det_rank", "b.*")
    assert anchors_by_image(flat) == anchors_by_image(long)
    joined = flat.alias("p").join(long.alias("q"), ["image_name", "det_rank"])
    worst = F.greatest(*[F.abs(F.col(f"p.{c}") - F.col(f"q.{c}")) for c in ("score", *D.CORNERS)])
    assert joined.agg(F.max(worst)).first()[0] < 1e-12


def test_predict_without_candidates(spark):
    assert [r.boxes for r in D.predict(wide(spark, 2), 1.0).collect()] == [[], []]


def test_threshold_is_strict_and_checked(spark):
    rows = spark.createDataFrame([(0.5,), (0.6,)], "score double")
    assert D.score_filter(rows, 0.5).count() == 1
    with pytest.raises(ValueError):
        D.score_filter(rows, 1.5)


def boxes_frame(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    rows = [
        (f"i{k % 7}", 0.0, float(rng.random()), float(rng.random()), float(rng.random() * 0.6 + 0.01), float(rng.random() * 0.6 + 0.01))
        for k in range(n)
    ]
    return rows, spark.createDataFrame(rows, "image_name string, class_id double, cx double, cy double, w double, h double")


def corners(box):
    cx, cy, w, h = box
    return (cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5])
def test_pruned_matching_equals_all_pairs(spark, threshold):
    rows, frame = boxes_frame(spark, 120)
    # boxes that are anchors themselves, and boxes with an IoU right at the threshold
    rows += [("edge", 0.0, *map(float, GRID[i])) for i in (0, 31, 700, 1023, 1024, 1343)]
    rows += [("edge", 0.0, 0.5, 0.5, 0.2 * t, 0.2) for t in (0.3, 0.5)]
    frame = spark.createDataFrame(rows, frame.schema)
    got = {(r.image_name, r.cx, r.cy, r.w, r.h, r.anchor_id) for r in N.match_anchors(frame, threshold).collect()}
    expected, near = set(), set()
    for name, _, *box in rows:
        for a, anchor in enumerate(GRID):
            value = iou(corners(anchor), corners(box))
            if abs(value - threshold) < 1e-12:
                near.add((name, *box, a))
            elif value > threshold:
                expected.add((name, *box, a))
    assert got - near == expected - near


def test_best_gt_ties_and_assignment(spark):
    rows = [("a", 0.0, *map(float, GRID[40])), ("a", 0.0, *map(float, GRID[40])), ("b", 0.0, 0.9, 0.9, 0.001, 0.001)]
    frame = spark.createDataFrame(rows, "image_name string, class_id double, cx double, cy double, w double, h double")
    best = N.best_gt(N.match_anchors(frame)).where("anchor_id = 40").collect()
    assert len(best) == 1 and best[0].best_iou == pytest.approx(1.0)
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "image_name string")
    counts = {r.image_name: r for r in N.anchor_assignment(images, frame).collect()}
    assert counts["a"].positive >= 1 and counts["b"].positive == 0 and counts["c"].negative == 1344
    assert all(r.positive + r.ignored + r.negative == 1344 for r in counts.values())


def test_assignment_boundaries(spark):
    rows = spark.createDataFrame([(0.5,), (0.3,), (0.5000001,), (0.2999,), (None,)], "iou double")
    assert [r[0] for r in rows.select(N.assignment(F.col("iou"))).collect()] == [
        "ignored", "ignored", "positive", "negative", "negative"]


def test_nearest_cell_is_the_best_anchor(spark):
    rows, frame = boxes_frame(spark, 150, seed=9)
    got = N.best_anchor_column(frame).select("cx", "cy", "best.iou").collect()
    best = {(b[0], b[1]): max(iou(corners(a), corners(b)) for a in GRID) for _, _, *b in rows}
    assert all(r.iou == pytest.approx(best[(r.cx, r.cy)], abs=1e-12) for r in got)


def test_make_anchors(spark):
    rows = N.make_anchors(spark).orderBy("anchor_id").select("cx", "cy", "w", "h").toPandas().to_numpy()
    assert abs(rows - GRID).max() < 1e-15


def test_rows_made_from_dealt_images_are_not_shuffled_again(spark):
    keys = spark.range(40).select("id", F.concat(F.lit("i"), "id").alias("image_name")).repartition(9, "image_name")
    rows = keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("anchor_id"))
    x = F.pmod(F.xxhash64("image_name", "anchor_id"), F.lit(97)) / 100
    made = rows.select("*", F.round(x, 1).alias("score"), x.alias("x1"), (x / 2).alias("y1"), (x + 0.2).alias("x2"), (x / 2 + 0.1).alias("y2"))
    held, dealt = D.nms(made), D.nms(made.repartition(3))
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, dealt.collect()))

    def shuffles(frame):
        return frame._jdf.queryExecution().sparkPlan().toString().count("Exchange ")

    assert shuffles(held) == 1 and shuffles(dealt) > 1
    assert shuffles(D.nms(made.select("*", F.lit("k").alias("kind")), on=["image_name", "kind"])) == 1
    # two partitions are fewer than the cores, and rows of an image lie apart when an anchor deals them
    for other in (keys.repartition(2, "image_name"), keys.repartition(9, "id")):
        few = other.select("image_name", F.lit(1).alias("anchor_id"), *[F.lit(0.5).alias(c) for c in ("score", *D.CORNERS)])
        assert shuffles(D.nms(few)) == shuffles(few) + 1


def test_predictions_leave_in_slices(spark, monkeypatch, tmp_path):
    """One image a slice gives the rows of one slice, and batches to Python are bounded by bytes."""
    from boxlake import fixtures as X
    from boxlake.session import BATCH_BYTES, BATCH_BYTES_KEY

    spark.range(9).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.conf.set(BATCH_BYTES_KEY, "64m")
    try:
        whole = sorted(map(tuple, X.predictions_wide(spark, str(tmp_path), 5).collect()))
        assert int(spark.conf.get(BATCH_BYTES_KEY)) == BATCH_BYTES
        spark.conf.set(BATCH_BYTES_KEY, "1k")
        monkeypatch.setattr(X, "BATCH_BYTES", 1)
        assert sorted(map(tuple, X.predictions_wide(spark, str(tmp_path), 5).collect())) == whole and len(whole) == 9
        assert spark.conf.get(BATCH_BYTES_KEY) == "1k"
    finally:
        spark.conf.unset(BATCH_BYTES_KEY)
    assert [len(v) for v in whole[0][1:]] == [10, 20]
