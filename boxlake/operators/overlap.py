"""Overlap joins of boxes through a tile index.

A box has a size class along each axis, the power of two below its side. A pair whose IoU is at least t has sides that
differ by 1/t at most, so its classes are few steps apart. Every box is therefore entered in the grid of its own class
and in those of the next larger classes within that reach; a grid's cells are twice as wide as its class, so a box
touches few of them. A pair meets in one place only: in the grid of the larger class of both along each axis, in the
cell that holds the lower corner of the intersection. Boxes are compared inside cells and nowhere else.

Cells that hold very many boxes of one side are ordinary skewed keys of an inner join, which Spark splits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.operators.batching import spread_by

CORNERS = ("x1", "y1", "x2", "y2")
TILE = ("lx", "ly", "tx", "ty")
#: Class of a side of the whole image, which no clipped box exceeds.
_TOP = 0


def size_class(low: Column, high: Column) -> Column:
    return F.floor(F.log2(high - low)).cast("int")


def class_reach(min_iou: float) -> int:
    """How many classes apart the sides of two boxes can be at this IoU."""
    return math.floor(math.log2(1.0 / min_iou) + 1e-9) + 1


def with_classes(boxes: DataFrame, min_iou: float) -> DataFrame:
    """Boxes with an area, plus their classes `kx`, `ky` and the largest classes `mx`, `my` they are entered in.

    At an IoU of 0 any sizes can meet; then all boxes go up to the class of the whole image.
    """
    rows = boxes.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))).withColumns({
        "kx": size_class(F.col("x1"), F.col("x2")), "ky": size_class(F.col("y1"), F.col("y2")),
    })
    if min_iou > 0:
        reach = F.lit(class_reach(min_iou))
        return rows.withColumns({"mx": F.col("kx") + reach, "my": F.col("ky") + reach})
    return rows.withColumns({"mx": F.greatest("kx", F.lit(_TOP)), "my": F.greatest("ky", F.lit(_TOP))})


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), level + 1)


def _cell(place: Column, level: Column) -> Column:
    return F.floor(place / _width(level))


def in_tiles(classed: DataFrame) -> DataFrame:
    """One row for every tile a box of `with_classes` is entered in: level `lx`, `ly`, cell `tx`, `ty`, its sides `wx`, `wy`."""
    levels = classed.select("*", F.explode(F.sequence("kx", "mx")).alias("lx"))
    levels = levels.select("*", F.explode(F.sequence("ky", "my")).alias("ly"))
    rows = levels.select("*", F.explode(F.sequence(_cell(F.col("x1"), F.col("lx")), _cell(F.col("x2"), F.col("lx")))).alias("tx"))
    rows = rows.select("*", F.explode(F.sequence(_cell(F.col("y1"), F.col("ly")), _cell(F.col("y2"), F.col("ly")))).alias("ty"))
    return rows.withColumns({"wx": _width(F.col("lx")), "wy": _width(F.col("ly"))})


def tile_count() -> Column:
    """In how many tiles a box of `with_classes` is entered."""
    def along(low: str, high: str, least: str, most: str) -> Column:
        cells = F.transform(F.sequence(least, most), lambda k: _cell(F.col(high), k) - _cell(F.col(low), k) + 1)
        return F.aggregate(cells, F.lit(0).cast("long"), lambda total, n: total + n)

    return along("x1", "x2", "kx", "mx") * along("y1", "y2", "ky", "my")


def meets_here(a: str, b: str) -> Column:
    """Whether the tile at hand (with its sides) is the one in which the boxes `a` and `b` (structs) meet."""
    def own(axis: str) -> Column:
        level, low = F.col(f"l{axis}"), F.greatest(f"{a}.{axis}1", f"{b}.{axis}1")
        return (level == F.greatest(f"{a}.k{axis}", f"{b}.k{axis}")) & (F.floor(low / F.col(f"w{axis}")) == F.col(f"t{axis}"))

    return own("x") & own("y")


def iou_of(a: str, b: str) -> Column:
    return G.box_iou(*[G.Box(*[F.col(f"{side}.{c}") for c in CORNERS]) for side in (a, b)])


def overlaps(left: DataFrame, right: DataFrame, min_iou: float, on: Sequence[str] = (), spread: bool = False) -> DataFrame:
    """All pairs (`a` of left, `b` of right, `iou`) with an IoU of at least `min_iou` and above 0, each once.

    Both sides have corner columns; pairs agree in the columns `on`, which come first in the result.
    `spread` deals the tiles over all cores; sized by bytes alone they may be packed into too few tasks.
    """
    if not 0.0 <= min_iou <= 1.0:
        raise ValueError("min_iou must be between 0 and 1")
    on = list(on)
    sides = [with_classes(frame, min_iou) for frame in (left, right)]
    tiled = [
        in_tiles(frame).select(
            *on, *TILE, "wx", "wy", *[(F.col(f"k{axis}") == F.col(f"l{axis}")).alias(f"own_{axis}") for axis in "xy"],
            F.struct(*[c for c in frame.columns if c not in ("mx", "my", *on)]).alias(name),
        )
        for frame, name in zip(sides, ("a", "b"))
    ]
    # along each axis one of the two must be of the grid's own class: where `a` is not, `b` is asked to be
    asking = tiled[0].withColumns({f"ask_{axis}": ~F.col(f"own_{axis}") for axis in "xy"}).drop("own_x", "own_y")
    giving = tiled[1].drop("wx", "wy")
    for axis in "xy":
        answers = F.when(F.col(f"own_{axis}"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        giving = giving.select("*", F.explode(answers).alias(f"ask_{axis}")).drop(f"own_{axis}")
    keys = [*on, *TILE, "ask_x", "ask_y"]
    if spread:
        asking, giving = spread_by(asking, keys), spread_by(giving, keys)
    met = asking.join(giving, keys).where(meets_here("a", "b"))
    pairs = met.select(*on, "a", "b", iou_of("a", "b").alias("iou"))
    return pairs.where((F.col("iou") >= F.lit(float(min_iou))) & (F.col("iou") > F.lit(0.0)))
