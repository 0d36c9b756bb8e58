"""The tile index against all pairs, and suppression of crowded images against the greedy loop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.operators import anchors as N
from boxlake.operators import detections as D
from boxlake.operators import overlap, training_loss


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(w, 0.0) * max(h, 0.0)
    return inter / max((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter, 1e-6)


def drawn(n, seed):
    rng = np.random.default_rng(seed)
    size = 2.0 ** rng.uniform(-7, -1, (n, 2))
    size[: n // 4] = 2.0 ** rng.integers(-6, -1, (n // 4, 2))  # sides right on the border of two classes
    low = np.floor(rng.random((n, 2)) * 64) / 64 if n % 2 else rng.random((n, 2)) * 1.2 - 0.1
    rows = [(i, f"g{i % 2}", *map(float, low[i]), *map(float, low[i] + size[i])) for i in range(n)]
    return rows + [(n, "g0", 0.5, 0.5, 0.5, 0.7), (n + 1, "g1", 0.6, 0.2, 0.4, 0.4), (n + 2, None, 0.0, 0.0, 1.0, 1.0)]


def boxes(spark, rows):
    return spark.createDataFrame(rows, "id int, g string, x1 double, y1 double, x2 double, y2 double")


@pytest.mark.parametrize("least, on", [(0.3, []), (0.5, ["g"]), (1.0, []), (0.05, ["g"]), (0.0, [])])
def test_pairs_are_those_of_all_pairs(spark, least, on):
    left, right = drawn(160, 1), drawn(151, 2)
    right += [(1000 + r[0], r[1], *[v + 0.01 * (r[4] - r[2]) for v in r[2:]]) for r in left[:60]]
    got = overlap.overlaps(boxes(spark, left), boxes(spark, right), least, on).select("a.id", "b.id", "iou").collect()
    want = {
        (a[0], b[0]): iou(a[2:], b[2:]) for a in left for b in right
        if iou(a[2:], b[2:]) > 0 and iou(a[2:], b[2:]) >= least and (not on or (a[1] == b[1] and a[1]))
    }
    assert len(got) == len(want) and want
    assert all(math.isclose(want[r[0], r[1]], r[2], abs_tol=1e-12) for r in got)


def test_join_is_by_tile_and_never_of_all_pairs(spark):
    frame = boxes(spark, drawn(50, 3))
    plan = overlap.overlaps(frame, frame, 0.4, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_anchor_table_agrees_with_the_grid(spark):
    rng = np.random.default_rng(4)
    rows = [(f"i{k % 7}", *map(float, rng.random(2)), *map(float, rng.uniform(0.02, 0.7, 2))) for k in range(60)] + [("i0", 0.5, 0.5, 0.0, 0.2)]
    frame = spark.createDataFrame(rows, "image_name string, cx double, cy double, w double, h double")
    columns = ["image_name", "cx", "cy", "w", "h", "anchor_id", "iou"]
    by_grid, by_table = N.match_anchors(frame), N.match_anchor_table(frame, N.make_anchors(spark))
    assert sorted(map(tuple, by_grid.select(columns).collect())) == sorted(map(tuple, by_table.select(columns).collect()))
    logits = [[float(v) for v in rng.normal(0, 2, 2 * N.N_ANCHORS)] for _ in range(8)]
    wide = spark.createDataFrame([(f"i{k}", row, row + row) for k, row in enumerate(logits)], "image_name string, logits array<double>, deltas array<double>")
    by_grid, by_table = training_loss.image_loss(wide, frame), training_loss.image_loss(wide, frame, anchors=N.make_anchors(spark))
    for one, two in zip(by_grid.orderBy("image_name").collect(), by_table.orderBy("image_name").collect()):
        assert one[:4] == two[:4] and np.allclose(one[4:], two[4:])
    hard = [training_loss.hard_negatives(wide, frame, anchors=a).orderBy("image_name", "neg_rank").collect() for a in (None, N.make_anchors(spark))]
    assert hard[0] == hard[1]


def greedy(rows, threshold, limit):
    kept = []
    for row in sorted(rows, key=lambda r: (-r[2], r[1], r[3:])):
        if len(kept) < limit and all(iou(row[3:], k[3:]) <= threshold for k in kept):
            kept.append(row)
    return [k[1] for k in kept]


@pytest.mark.parametrize("threshold, limit", [(0.4, 25), (0.2, 10_000), (0.0, 10_000)])
def test_crowds_are_suppressed_as_by_the_greedy_loop(spark, threshold, limit):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(500):  # dense places, chains of falling scores, equal rows
        x, y = (rng.integers(0, 4, 2) / 4 + rng.random(2) * 0.03) if k % 2 else (k / 500, 0.9)
        w, h = rng.uniform(0.02, 0.12, 2)
        rows.append(("crowd" if k % 10 else "few", k, float(1 - k / 500 if not k % 2 else round(rng.random(), 1)), *map(float, (x, y, min(x + w, 1), min(y + h, 1)))))
    rows += [rows[1]] * 3 + [("flat", 1, 0.5, 0.2, 0.2, 0.2, 0.4), ("flat", 2, 0.4, 0.2, 0.2, 0.2, 0.4)]
    frame = spark.createDataFrame(rows, "image_name string, anchor_id int, score double, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in D.nms_any(frame, threshold, limit).orderBy("image_name", "det_rank").collect():
        got.setdefault(r.image_name, []).append(r.anchor_id)
    for name in ("crowd", "few", "flat"):
        assert got[name] == greedy([r for r in rows if r[0] == name], threshold, limit)
    assert D.nms_any(frame.where(F.lit(False))).count() == 0


def test_crowds_are_settled_from_the_best_boxes_on(spark, monkeypatch):
    """Heads of a few boxes: images end in the first round, in later ones, and behind the last."""
    monkeypatch.setattr(D, "HEAD", 12)
    monkeypatch.setattr(D, "HEAD_ROUNDS", 2)
    rng = np.random.default_rng(8)
    rows = []
    for k in range(160):
        x, y = rng.integers(0, 3, 2) / 4 + rng.random(2) * 0.03
        rows.append(("dense" if k % 2 else "other", k, float(round(rng.random(), 2)), *map(float, (x, y, x + 0.1, y + rng.uniform(0.05, 0.12)))))
    rows += [("few", k, 1.0 - k / 10, 0.1 * k, 0.0, 0.1 * k + 0.15, 0.1) for k in range(5)] + [("dense", 900, 0.5, 0.2, 0.2, 0.2, 0.4)]
    frame = spark.createDataFrame(rows, "image_name string, anchor_id int, score double, x1 double, y1 double, x2 double, y2 double")
    for limit in (4, 1000):
        got = {}
        for r in D.nms_any(frame, 0.4, limit).orderBy("image_name", "det_rank").collect():
            got.setdefault(r.image_name, []).append(r.anchor_id)
        assert got == {name: greedy([r for r in rows if r[0] == name], 0.4, limit) for name in ("dense", "other", "few")}


def test_row_numbers_of_ranges(spark):
    from boxlake.operators.batching import with_row_number

    rows = [(k % 7, f"n{k % 5}") for k in range(60)] + [(None, "n1"), (3, None)]
    frame = spark.createDataFrame(rows, "a int, b string")
    got = sorted((r.row_no, r.a, r.b) for r in with_row_number(frame, ["a", "b"]).collect())
    want = sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
    assert [r[0] for r in got] == list(range(1, 63)) and [r[1:] for r in got] == want


def test_scores_of_a_large_crowd(spark):
    """Row numbers whose multiple is no 32-bit number."""
    from boxlake import fixtures as X

    at = spark.createDataFrame([("i", 0.5, 0.5, 0.1, 0.1, 271_182), ("i", 0.5, 0.5, 0.1, 0.1, 2**31 - 1)], "image_name string, cx double, cy double, w double, h double, row_no long")
    assert [r.score for r in spark.sql(X.CROWD, numbered=at).orderBy("anchor_id").collect()] == [n * 7919 % 1009 / 1009 for n in (271_182, 2**31 - 1)]
