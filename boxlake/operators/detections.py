"""From raw predictions to detections: scores, boxes, non-maximum suppression."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxlake.functions import geometry as G
from boxlake.operators.anchors import N_ANCHORS, anchor_box, anchor_grid
from boxlake.operators import overlap
from boxlake.operators.batching import clustered_by
from boxlake.operators.overlap import CORNERS
from boxlake.session import bound_batches, written

# Default score threshold, overlap threshold and boxes kept per image.
SCORE_THRESHOLD = 0.5
NMS_THRESHOLD = 0.4
MAX_DETECTIONS = 100

DETECTED = "array<struct<anchor_id:int,score:double,x1:double,y1:double,x2:double,y2:double>>"


def check_threshold(name: str, value: float) -> float:
    if not 0.0 <= value <= 1.0:
        raise ValueError(f"{name} must be between 0 and 1, got {value}")
    return float(value)


def explode_predictions(wide: DataFrame) -> DataFrame:
    """Flat model output (`logits`, `deltas`) to one row per image and anchor."""
    rest = [c for c in wide.columns if c not in ("logits", "deltas")]
    ids = F.sequence(F.lit(0), (F.size("logits") / 2 - 1).cast("int"))
    rows = wide.where(F.size("logits") >= 2).select("*", F.explode(ids).alias("anchor_id"))
    a = F.col("anchor_id")
    return rows.select(
        *rest, "anchor_id",
        *[F.get("logits", a * 2 + i).cast("double").alias(f"logit{i}") for i in range(2)],
        *[F.get("deltas", a * 4 + i).cast("double").alias(n) for i, n in enumerate(("dx", "dy", "dw", "dh"))],
    )


def join_preds_anchors(preds: DataFrame, anchors: DataFrame) -> DataFrame:
    """Predictions beside their anchors (`acx`, `acy`, `aw`, `ah`, `lvl`).

    The anchor table has N_ANCHORS rows whatever the data size, hence the broadcast.
    """
    renamed = anchors.select(
        "anchor_id", "lvl", *[F.col(c).alias(f"a{c}") for c in ("cx", "cy", "w", "h")]
    )
    return preds.join(F.broadcast(renamed), "anchor_id")


def score_filter(scored: DataFrame, threshold: float) -> DataFrame:
    """Keep scores strictly above the threshold."""
    return scored.where(F.col("score") > F.lit(check_threshold("score threshold", threshold)))


def decode_rows(rows: DataFrame) -> DataFrame:
    """Adds `score` and the clipped corner box to prediction rows."""
    box = G.decode_boxes(G.Box.of("dx", "dy", "dw", "dh"), anchor_box(F.col("anchor_id")))
    corners = G.clip_boxes(G.cxcywh_to_xyxy(box))
    return rows.withColumns({
        "score": G.softmax_score(F.col("logit0"), F.col("logit1")),
        **dict(zip(CORNERS, corners)),
    })


def candidates(preds: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Scored, filtered and decoded rows; one narrow pass over the predictions."""
    rest = [c for c in preds.columns if c not in ("logit0", "logit1", "dx", "dy", "dw", "dh")]
    return score_filter(decode_rows(preds), threshold).select(*rest, "score", *CORNERS)


# Images whose suppression steps run as one array operation.
IMAGES_PER_STEP = 32


def keep_greedily(cells: np.ndarray, starts: np.ndarray, threshold: float, limit: int) -> list[np.ndarray]:
    """Positions kept per image of ranked corner boxes.

    `cells` is [4, boxes] with the boxes of image i at starts[i]:starts[i + 1]. Every step keeps the
    best box left of each of a few images and drops what overlaps it.
    """
    kept: list[np.ndarray] = []
    counts = np.diff(starts)
    for first in range(0, len(counts), IMAGES_PER_STEP):
        held = counts[first : first + IMAGES_PER_STEP]
        rows, width = np.arange(len(held)), int(held.max(initial=0))
        alive = np.arange(width) < held[:, None]
        boxes = np.zeros((4, len(held), width))
        boxes[:, alive] = cells[:, starts[first] : starts[first + len(held)]]
        x1, y1, x2, y2 = boxes
        area = (x2 - x1) * (y2 - y1)
        chosen = np.full((len(held), limit), -1, np.int32)
        for step in range(limit if width else 0):
            best = alive.argmax(axis=1)
            open_rows = alive[rows, best]
            if not open_rows.any():
                break
            chosen[open_rows, step] = best[open_rows]
            bx1, by1, bx2, by2 = boxes[:, rows, best, None]
            iw = np.minimum(x2, bx2) - np.maximum(x1, bx1)
            ih = np.minimum(y2, by2) - np.maximum(y1, by1)
            inter = np.maximum(iw, 0.0) * np.maximum(ih, 0.0)
            union = area + area[rows, best, None] - inter
            alive &= inter / np.maximum(union, G.EPSILON) <= threshold
            alive[rows, best] = False
        kept.extend(row[row >= 0] for row in chosen)
    return kept


def _stream_nms(on: Sequence[str], threshold: float, limit: int) -> Callable:
    """Arrow batches of rows sorted by image and rank -> their kept rows.

    Between batches only the boxes kept so far of the image at hand are held. Put in front of the
    image's next rows they are kept again, so an image may span any number of batches.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
            changed = np.zeros(max(rows.num_rows - 1, 0), bool)
            for name in on:
                key = rows.column(name)
                changed |= pc.not_equal(key[1:], key[:-1]).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(changed) + 1, [rows.num_rows]])
            cells = np.stack([rows.column(c).to_numpy() for c in CORNERS])
            kept = keep_greedily(cells, starts, threshold, limit)
            done = rows.take(pa.array(np.concatenate([s + k for s, k in zip(starts, kept[:-1])] or [[]]), pa.int64()))
            ranks = np.concatenate([np.arange(len(k)) for k in kept[:-1]] or [[]])
            held = rows.take(pa.array(starts[-2] + kept[-1], pa.int64()))
            yield from done.append_column("det_rank", pa.array(ranks, pa.int32())).to_batches()
        if held is not None:
            yield from held.append_column("det_rank", pa.array(np.arange(held.num_rows), pa.int32())).to_batches()

    return run


def nms(
    boxes: DataFrame,
    threshold: float = NMS_THRESHOLD,
    limit: int = MAX_DETECTIONS,
    on: Sequence[str] = ("image_name",),
) -> DataFrame:
    """Greedy suppression per image: kept rows with `det_rank`, equal scores by anchor.

    Suppression is a loop whose every step hangs on the ones before; as an SQL fold it costs one
    interpreted IoU per pair, so sorted rows stream through numpy. A task holds at most `limit`
    boxes and one batch, whatever the size of an image. Rows that were dealt by image before they were made, from
    a table of images, are not shuffled again. Predictions keyed by (image, anchor) have
    at most N_ANCHORS rows per image; for images of millions of boxes `nms_any` shares the work out.
    """
    on = list(on)
    rows = boxes.select(*on, "anchor_id", "score", *CORNERS)
    ordered = clustered_by(rows, on).sortWithinPartitions(*on, F.col("score").desc(), "anchor_id", *CORNERS)
    schema = T.StructType([*rows.schema.fields, T.StructField("det_rank", T.IntegerType())])
    return ordered.mapInArrow(_stream_nms(on, check_threshold("overlap threshold", threshold), limit), schema)


def nms_any(
    boxes: DataFrame,
    threshold: float = NMS_THRESHOLD,
    limit: int = MAX_DETECTIONS,
    on: Sequence[str] = ("image_name",),
) -> DataFrame:
    """`nms` for groups of any size: kept rows with `det_rank`, in independent-set rounds.

    The fate of a box hangs on better ones only. So for HEAD_ROUNDS rounds the best HEAD boxes of every image are settled by
    themselves; images with `limit` kept boxes are done, of the others go the boxes that the kept ones overlap. What
    is left after that is settled at once. The result is that of the greedy order. No step gathers the rows of an
    image: Spark cuts them to HEAD in every task before they meet. Passes and rounds are cut by written tables.
    """
    on, threshold = list(on), check_threshold("overlap threshold", threshold)
    rank = ("negative", "anchor_id", *CORNERS, "uid")
    cells = [F.col(c).cast("double").alias(c) for c in CORNERS]
    rows = written(boxes.select(*on, "anchor_id", "score", *cells, F.monotonically_increasing_id().alias("uid")), "nms-rows")
    order = F.struct(*rank).alias("place")
    ranked = rows.withColumn("negative", -F.col("score")).select("*", order)
    area = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    # a box without an area overlaps nothing
    sure = [ranked.where(~F.coalesce(area, F.lit(False))).select(*on, "place")]
    rest = written(ranked.where(area).select(*on, "place"), "nms-open")
    place = W.partitionBy(*on).orderBy("place")
    for _ in range(HEAD_ROUNDS):
        head = written(rest.withColumn("rn", F.row_number().over(place)).where(F.col("rn") <= F.lit(HEAD)), "nms-head")
        best = written(_settled(head.drop("rn"), threshold, limit, on), "nms-best")
        sure.append(best)
        rest = _behind(rest, head.where(F.col("rn") == F.lit(HEAD)), reduce(DataFrame.unionByName, sure), limit, on)
        if rest.isEmpty():
            break
        rest = _not_hit(rest, _tiles(rest, threshold, on), best, threshold, on)
    else:
        sure.append(_settled(rest, threshold, limit, on))
    kept = reduce(DataFrame.unionByName, sure).withColumn("rn", F.row_number().over(place)).where(F.col("rn") <= F.lit(limit))
    return kept.select(
        *on, "place.anchor_id", (-F.col("place.negative")).alias("score"), *[F.col(f"place.{c}") for c in CORNERS],
        (F.col("rn") - 1).alias("det_rank"),
    )


# Rounds over the best boxes of an image, and how many these are: as many as Spark cuts a window to in every task.
HEAD_ROUNDS, HEAD = 8, 1000
# Passes that thin crowded places before conflicts are listed.
DENSE_PASSES = 2


def _settled(rows: DataFrame, threshold: float, limit: int, on: list[str]) -> DataFrame:
    """The rows that greedy suppression keeps, if no others are given; some behind `limit` kept ones may be missing.

    A box without a better undecided neighbour (IoU above the threshold) stays and its neighbours go. First, for
    DENSE_PASSES passes, neighbours are judged by tiles: a box that is the best of every tile it is entered in
    stays, and what it overlaps goes; a tile has one such box at most, so a pass is linear in the rows however dense
    they lie. The conflict graph of the rest comes from the tile join and is worked off in rounds of joins by row.
    Rows that rank behind `limit` kept ones are dropped early.
    """
    sure: list[DataFrame] = []
    for _ in range(DENSE_PASSES):
        best, rows = _dense_pass(rows, threshold, on)
        sure.append(best)
        rows = _within_limit(rows, reduce(DataFrame.unionByName, sure), limit, on)
    return reduce(DataFrame.unionByName, [*sure, _independent(rows, threshold, on)])


def _behind(rows: DataFrame, last: DataFrame, kept: DataFrame, limit: int, on: list[str]) -> DataFrame:
    """Rows that rank behind the `last` one of their image, of images with fewer than `limit` kept rows up to there."""
    ends = last.select(F.col("place").alias("last"), *[F.col(c).alias(f"last_{c}") for c in on])

    def same(frame: DataFrame, other: DataFrame) -> Column:
        return reduce(Column.__and__, [frame[c].eqNullSafe(other[f"last_{c}"]) for c in on])

    ahead = kept.join(F.broadcast(ends), same(kept, ends)).where(F.col("place") <= F.col("last"))
    full = ahead.groupBy("last").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= F.lit(limit))
    # places are unique
    open_ends = written(ends.join(full, "last", "left_anti"), "nms-ends")
    behind = rows.join(F.broadcast(open_ends), same(rows, open_ends)).where(F.col("place") > F.col("last"))
    return written(behind.select(*on, "place"), "nms-open")


def _classed(rows: DataFrame, threshold: float, on: list[str]) -> DataFrame:
    return overlap.with_classes(rows.select(*on, "place", *[F.col(f"place.{c}").alias(c) for c in CORNERS]), threshold)


def _dense_pass(rows: DataFrame, threshold: float, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that lead all their tiles, and the others that no leader overlaps."""
    tiles = _tiles(rows, threshold, on)
    firsts = tiles.groupBy(*on, *overlap.TILE).agg(F.min(F.struct(F.col("a.place").alias("place"), "n_tiles")).alias("first"))
    led = firsts.groupBy(*on, "first").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("first.n_tiles"))
    best = written(led.select(*on, "first.place"), "nms-best")
    # a leader overlaps itself
    return best, _not_hit(rows, tiles, best, threshold, on)


_TILED_BOX = ("place", *CORNERS, "kx", "ky")


def _tiles(rows: DataFrame, threshold: float, on: list[str]) -> DataFrame:
    """A row for every tile that a row is entered in, with the row as `a` and the number of its tiles."""
    classed = _classed(rows, threshold, on).withColumn("n_tiles", overlap.tile_count())
    return overlap.in_tiles(classed).select(*on, *overlap.TILE, "wx", "wy", F.struct(*_TILED_BOX).alias("a"), "n_tiles")


def _not_hit(rows: DataFrame, tiles: DataFrame, best: DataFrame, threshold: float, on: list[str]) -> DataFrame:
    """Rows that none of `best` overlaps; `tiles` are those of the rows."""
    leaders = overlap.in_tiles(_classed(best, threshold, on)).select(*on, *overlap.TILE, F.struct(*_TILED_BOX).alias("b"))
    hit = tiles.join(leaders, [*on, *overlap.TILE]).where(
        overlap.meets_here("a", "b") & (overlap.iou_of("a", "b") > F.lit(threshold))
    )
    gone = hit.select(F.col("a.place.uid").alias("uid"))
    return written(rows.join(gone, F.col("place.uid") == F.col("uid"), "left_anti"), "nms-open")


def _within_limit(rows: DataFrame, kept: DataFrame, limit: int, on: list[str]) -> DataFrame:
    """Rows that rank before the `limit`-th kept row of their image."""
    place = W.partitionBy(*on).orderBy("place")
    last = kept.withColumn("rn", F.row_number().over(place)).where(F.col("rn") <= F.lit(limit)).where(F.col("rn") == F.lit(limit))
    return rows.join(last.select(*on, F.col("place").alias("last")), on, "left").where(
        F.col("last").isNull() | (F.col("place") < F.col("last"))
    ).drop("last")


def _independent(rows: DataFrame, threshold: float, on: list[str]) -> DataFrame:
    """The rows that greedy suppression keeps, from their conflict graph."""
    rows = written(rows, "nms-open")
    corners = rows.select(*on, "place", *[F.col(f"place.{c}").alias(c) for c in CORNERS])
    pairs = overlap.overlaps(corners, corners, threshold, on, spread=True).where(
        (F.col("iou") > F.lit(threshold)) & (F.col("a.place") < F.col("b.place"))
    )
    edges = written(pairs.select(F.col("a.place.uid").alias("better"), F.col("b.place.uid").alias("worse")), "nms-edges")
    gone: list[DataFrame] = []
    while not edges.isEmpty():
        stay = edges.select("better").join(edges.select(F.col("worse").alias("better")), "better", "left_anti").distinct()
        out = written(edges.join(stay, "better").select(F.col("worse").alias("uid")).distinct(), "nms-gone")
        gone.append(out)
        edges = written(
            edges.join(out, F.col("worse") == F.col("uid"), "left_anti").join(out, F.col("better") == F.col("uid"), "left_anti"),
            "nms-edges",
        )
    for out in gone:
        rows = rows.join(out, F.col("place.uid") == F.col("uid"), "left_anti")
    return rows


def ranked_boxes(logits: np.ndarray, deltas: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Anchors, scores and corners of the candidates of one image, best first.

    Takes its [anchors, 2] logits and [anchors, 4] deltas.
    """
    score = 1.0 / (1.0 + np.exp(logits[:, 0] - logits[:, 1]))
    passed = np.flatnonzero(score > threshold)
    order = passed[np.lexsort((passed, -score[passed]))]
    anchor, moved = anchor_grid()[order], deltas[order]
    weights = np.array(G.CODER_WEIGHTS)
    centre = np.clip(moved[:, :2] / weights[:2] * anchor[:, 2:] + anchor[:, :2], 0.0, 1.0)
    growth = np.exp(np.minimum(moved[:, 2:], G.MAX_SIZE_DELTA) / weights[2:])
    half = np.clip(growth * anchor[:, 2:], G.MIN_DECODED_SIZE, 1.0) / 2.0
    corners = np.clip(np.concatenate([centre - half, centre + half], axis=1), 0.0, 1.0)
    return order, score[order], corners.T


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of a list column as views of its values."""
    cells = column.values.to_numpy(zero_copy_only=False)
    return np.split(cells, column.offsets.to_numpy()[1:-1]) if len(column) else []


def detect(
    logits: Column, deltas: Column, score_threshold: float, nms_threshold: float, limit: int
) -> Column:
    """Detections of wide predictions as an array column; one Arrow batch at a time, no shuffle."""
    score_threshold = check_threshold("score threshold", score_threshold)
    nms_threshold = check_threshold("overlap threshold", nms_threshold)

    @F.arrow_udf(DETECTED)
    def run(logit_lists: pa.Array, delta_lists: pa.Array) -> pa.Array:
        ranked = [
            ranked_boxes(one.reshape(-1, 2), moved.reshape(-1, 4), score_threshold)
            for one, moved in zip(_lists(logit_lists), _lists(delta_lists))
        ]
        starts = np.cumsum([0] + [len(ids) for ids, _, _ in ranked])
        cells = np.concatenate([np.empty((4, 0)), *[c for _, _, c in ranked]], axis=1)
        kept = keep_greedily(cells, starts, nms_threshold, limit)
        places = np.concatenate([np.empty(0, int), *[start + k for start, k in zip(starts, kept)]])
        ids = np.concatenate([np.empty(0, int), *[i for i, _, _ in ranked]])[places]
        scores = np.concatenate([np.empty(0), *[v for _, v, _ in ranked]])[places]
        fields = [pa.array(ids, pa.int32()), pa.array(scores), *[pa.array(c[places]) for c in cells]]
        rows = pa.StructArray.from_arrays(fields, names=["anchor_id", "score", *CORNERS])
        ends = np.cumsum([0] + [len(k) for k in kept])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    run = run.asNondeterministic()  # never run twice below a pushed-down filter
    return run(logits.cast("array<double>"), deltas.cast("array<double>"))


def predict(
    wide: DataFrame,
    score_threshold: float = SCORE_THRESHOLD,
    nms_threshold: float = NMS_THRESHOLD,
    limit: int = MAX_DETECTIONS,
) -> DataFrame:
    """Detections of model output rows as an array column, in rank order; no shuffle.

    Adds `boxes`: array of (anchor_id, score, x1, y1, x2, y2) in normalised model space.
    """
    bound_batches(wide.sparkSession)
    found = detect(F.col("logits"), F.col("deltas"), score_threshold, nms_threshold, limit)
    return wide.withColumn("boxes", found).drop("logits", "deltas")


def max_detections(kept: DataFrame, limit: int = MAX_DETECTIONS) -> DataFrame:
    """The best `limit` rows of each image of an already suppressed table."""
    return kept.where(F.col("det_rank") < F.lit(limit))
