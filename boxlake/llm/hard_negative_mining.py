"""Hard-negative mining with cover trees over norm-augmented candidates.

Candidates are dealt into blocks. In a block every vector gets one more coordinate that brings it to the length of the
longest one, so that all lie on a sphere and a nearer candidate is one with a larger inner product. Each label of the
block gets a cover tree: a node's children are its own centre and points further than half its covering radius from
each other, every point goes below a child within that half, and each node stores the radius it really covers. On the
sphere the angle between query and centre, more or less the angle of the covering radius, bounds the inner products of
everything below a node from both sides.

A search opens the node with the highest upper bound first. It skips nodes that lie outside all windows asked for and,
once a window has its k rows, nodes below the worst of them; the points of leaves are scored exactly, in integers. The
same descent serves both steps: positives are the best rows of the anchor's own label, in an open window; negatives the
best rows of other labels inside the windows that the positive scores set, all windows of an anchor in one descent. The
lists of all blocks are merged by ranked windows, which Spark cuts to k rows a task before its shuffle.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part, nor do anchors
without a key; vectors of other lengths are compared over the dimensions they share; rows are told apart by their
place, so repeated rows and equal ids are candidates of each other; equal scores go by smaller id, null ids last; an
anchor without positives or a window without rows gives no rows, as does an empty table; other columns are never read.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import vectors
from .common import PLACE, freeze

POSITIVES, NEGATIVES, SCALE, LEAF = 5, 10, 256, 32
#: A negative scores between these percentages of its positive.
LEAST_PERCENT, MOST_PERCENT = 30, 90
EXACT = 1 << 53  # doubles hold all integers up to here


def _spread(points: np.ndarray, members: np.ndarray, centre: int, reach: float) -> list[tuple[int, np.ndarray]]:
    """Centres more than `reach` apart, the first being `centre`, each with the members it covers."""
    groups = []
    while len(members):
        near = np.sqrt(((points[members] - points[centre]) ** 2).sum(axis=1)) <= reach
        groups.append((centre, members[near]))
        members = members[~near]
        centre = members[0] if len(members) else centre
    return groups


def cover_forest(table: pa.Table, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """One cover tree for each label of a block, as arrays; the children of a node and the points of a leaf are contiguous."""
    keys, x = vectors.keys_of(table), vectors.matrix(table.column("x"))
    labels = np.array(table.column("label").to_pylist(), str)
    cells = x.astype(float)
    squares = (cells ** 2).sum(axis=1)
    longest = squares.max(initial=0.0)
    points = np.concatenate([cells, np.sqrt(longest - squares)[:, None]], axis=1)
    names, label_of = np.unique(labels, return_inverse=True)
    waiting = [(members[0], members) for members in (np.flatnonzero(label_of == i) for i in range(len(names)))]
    nodes, order, filled, at = [], [], 0, 0
    while at < len(waiting):
        centre, members = waiting[at]
        waiting[at] = ()
        at += 1
        radius = float(np.sqrt(((points[members] - points[centre]) ** 2).sum(axis=1)).max())
        if radius == 0.0 or len(members) <= leaf:
            nodes.append((centre, radius, 0, 0, filled, filled + len(members)))
            order.append(members)
            filled += len(members)
        else:
            kids = _spread(points, members, centre, radius / 2)
            nodes.append((centre, radius, len(waiting), len(waiting) + len(kids), 0, 0))
            waiting.extend(kids)
    order = np.concatenate(order)
    fields = np.array(nodes)
    ranks = np.empty(len(order), np.int64)
    ranks[np.lexsort((keys["place_row"], keys["place_file"], keys["id"], keys["none"]))] = np.arange(len(order))
    return {name: values[order] for name, values in keys.items()} | {
        "x": x[order], "rank": ranks[order], "roots": names, "radius": fields[:, 1], "longest": np.array([longest]),
        "centres": x[fields[:, 0].astype(np.int64)], "spans": fields[:, 2:].astype(np.int64),
    }


class Window:
    """The k best points with scores from `low` to `high`; `need` is what a further point must reach."""

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf):
        self.k, self.need, self.high = k, low, high
        self.points, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, points: np.ndarray, scores: np.ndarray, rank: np.ndarray) -> None:
        fit = (scores >= self.need) & (scores <= self.high)
        if not fit.any():
            return
        points, scores = np.concatenate([self.points, points[fit]]), np.concatenate([self.scores, scores[fit]])
        best = np.lexsort((rank[points], -scores))[: self.k]
        self.points, self.scores = points[best], scores[best]
        if len(best) == self.k:
            self.need = max(self.need, scores[best[-1]])


class Forest:
    """A stored cover forest made ready for searches."""

    def __init__(self, stored: dict[str, np.ndarray]):
        self.stored, self.x, self.rank = stored, stored["x"], stored["rank"]
        self.cells, self.centres = self.x.astype(float), stored["centres"].astype(float)
        self.largest = int(np.abs(self.cells).max(initial=0))
        self.spans, self.radius, self.size = stored["spans"], stored["radius"], float(stored["longest"][0]) ** 0.5
        self.turn = 2 * np.arcsin(np.clip(self.radius / max(2 * self.size, 1e-300), 0, 1))

    def descend(self, query: np.ndarray, roots: np.ndarray, windows: list[Window], skip: int = -1) -> None:
        """Fill the windows from the trees of the given roots, best bound first; the point `skip` is left out."""
        width = min(len(query), self.x.shape[1])
        query = query[:width]
        row = query.astype(float)
        exact = int(np.abs(row).sum()) * self.largest < EXACT
        reach = float(np.sqrt((row ** 2).sum())) * self.size
        slack = 1e-6 * reach + 1e-6
        heap: list[tuple[float, int, float]] = []

        def verify(points: np.ndarray) -> None:
            points = points[points != skip]
            scores = (self.cells[points, :width] @ row).astype(np.int64) if exact else self.x[points, :width] @ query
            for window in windows:
                window.offer(points, scores, self.rank)

        def bound(nodes: np.ndarray) -> None:
            turn = np.arccos(np.clip(self.centres[nodes, :width] @ row / max(reach, 1e-300), -1, 1))
            upper = reach * np.cos(np.maximum(turn - self.turn[nodes], 0)) + slack
            lower = reach * np.cos(np.minimum(turn + self.turn[nodes], np.pi)) - slack
            wanted = np.zeros(len(nodes), bool)
            for window in windows:
                wanted |= (upper >= window.need) & (lower <= window.high)
            single = wanted & (self.radius[nodes] == 0)
            if single.any():
                verify(np.concatenate([np.arange(a, b) for a, b in self.spans[nodes[single], 2:]]))
            for i in np.flatnonzero(wanted & ~single):
                heappush(heap, (-upper[i], int(nodes[i]), lower[i]))

        bound(roots)
        while heap:
            upper, node, lower = heappop(heap)
            if not any(-upper >= w.need and lower <= w.high for w in windows):
                continue
            first, last, begin, end = self.spans[node]
            if end > begin:
                verify(np.arange(begin, end))
            else:
                bound(np.arange(first, last))


def _packed_anchors(table: pa.Table) -> dict[str, np.ndarray]:
    packed = vectors.keys_of(table) | {
        "x": vectors.matrix(table.column("x")), "home": table.column("block").to_numpy(),
        "label": np.array(table.column("label").to_pylist(), str),
    }
    if "positives" in table.column_names:
        rows = table.column("positives").to_pylist()
        flat = [(i, p["positive_score"], p["place"]) for i, each in enumerate(rows) for p in each]
        packed |= {name: np.array([f[i] for f in flat], np.int64) for i, name in enumerate(("owner", "score", "place"))}
    return packed


def _positives(k: int):
    def work(number, block, anchors):
        forest, found = Forest(block), []
        for at, x in enumerate(anchors["x"]):
            own = np.zeros(0, np.int64)
            if anchors["home"][at] == number:
                own = np.flatnonzero((block["place_file"] == anchors["place_file"][at]) & (block["place_row"] == anchors["place_row"][at]))
            window = Window(k)
            roots = np.flatnonzero(block["roots"] == anchors["label"][at])
            forest.descend(x, roots, [window], int(own[0]) if len(own) else -1)
            found.append((np.full(len(window.points), at), window.points, window.scores))
        at, points, scores = _joined(found, 3)
        return pa.RecordBatch.from_arrays([
            pa.array(anchors["place_file"][at]), pa.array(anchors["place_row"][at]),
            pa.array(block["id"][points], pa.int64(), mask=block["none"][points]),
            pa.array(block["place_file"][points]), pa.array(block["place_row"][points]), pa.array(scores, pa.int64()),
        ], [*PLACE, "positive_id", "p_file", "p_row", "positive_score"])

    return work


def _negatives(k: int, least: int, most: int):
    def work(number, block, anchors):
        forest, found = Forest(block), []
        for at, x in enumerate(anchors["x"]):
            mine = np.flatnonzero(anchors["owner"] == at)
            windows = [
                Window(k, -(-least * int(s) // 100), most * int(s) // 100) for s in anchors["score"][mine]
            ]
            forest.descend(x, np.flatnonzero(block["roots"] != anchors["label"][at]), windows)
            for one, window in zip(mine, windows):
                found.append((np.full(len(window.points), one), window.points, window.scores))
        one, points, scores = _joined(found, 3)
        at = anchors["owner"][one]
        return pa.RecordBatch.from_arrays([
            pa.array(anchors["place_file"][at]), pa.array(anchors["place_row"][at]), pa.array(anchors["place"][one]),
            pa.array(block["id"][points], pa.int64(), mask=block["none"][points]), pa.array(scores, pa.int64()),
        ], [*PLACE, "place", "negative_id", "negative_score"])

    return work


def _joined(parts: list[tuple[np.ndarray, ...]], n: int) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, np.int64), *[p[i] for p in parts]]) for i in range(n)]


def mine(rows: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PERCENT, most: int = MOST_PERCENT,
         scale: int = SCALE, components: int = vectors.COMPONENTS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Negatives are the first `negatives` rows of other labels whose score lies between `least` and `most` percent of the
    score of the positive; positives the first `positives` other rows of the anchor's label.
    """
    named = label.cast("string")
    asked = F.coalesce(is_anchor, F.lit(False)) & F.col(key).isNotNull()
    usable = vectors.integer_vectors(rows, key, vector, scale, label=named, asked=asked).where(F.col("label").isNotNull())
    blocked, blocks = vectors.in_blocks(usable, components=components)
    anchors, _ = vectors.in_blocks(blocked.where("asked"), "anchor_block", components)
    forests = vectors.pack(blocked, "block", cover_forest, "cover-forests")
    packed = vectors.pack(anchors, "anchor_block", _packed_anchors, "anchors")
    near = vectors.meet(
        forests, blocks, packed, _positives(positives),
        f"{PLACE[0]} long, {PLACE[1]} long, positive_id long, p_file long, p_row long, positive_score long",
    )
    order = W.partitionBy(*PLACE).orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "p_file", "p_row")
    chosen = freeze(near.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= positives).select(
        *PLACE, "place", "positive_id", "positive_score"
    ), "positives")
    lists = chosen.groupBy(*PLACE).agg(F.collect_list(F.struct("place", "positive_score")).alias("positives"))
    sought = vectors.pack(anchors.join(lists, list(PLACE)), "anchor_block", _packed_anchors, "windows")
    far = vectors.meet(
        forests, blocks, sought, _negatives(negatives, least, most),
        f"{PLACE[0]} long, {PLACE[1]} long, place long, negative_id long, negative_score long",
    )
    order = W.partitionBy(*PLACE, "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ids = anchors.select(*PLACE, F.col("id").alias("anchor_id"))
    return ranked.join(chosen, [*PLACE, "place"]).join(ids, list(PLACE)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
