"""Integer vectors in packed blocks, and the meeting of every block of queries with every block of candidates.

A block is a group of rows drawn by the hash of their place, about COMPONENTS vector components large however the
rows are distributed over keys, labels or files. It is packed into one row, so that a search moves and holds whole
blocks: every candidate block is shuffled once, the packed queries once for each of them.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLACE, freeze, map_arrow, with_place

COMPONENTS, MOST_TASKS = 1 << 18, 10_000


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int, **more: Column) -> DataFrame:
    """id, x and the place of every row that takes part, plus `more`; x holds floor(scale * component).

    Null vectors and vectors with a null or non-finite component take no part.
    """
    cell = F.col(vector).cast("array<double>")
    finite = F.forall(cell, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return with_place(rows).where(F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), F.transform(cell, lambda v: F.floor(v * scale)).alias("x"), *PLACE,
        *[column.alias(name) for name, column in more.items()],
    )


def in_blocks(rows: DataFrame, name: str = "block", components: int = COMPONENTS) -> tuple[DataFrame, int]:
    """rows plus the number of their block, and the number of blocks."""
    total = rows.agg(F.sum(F.greatest(F.size("x"), F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-total // components))
    return rows.withColumn(name, F.pmod(F.xxhash64(*PLACE), F.lit(blocks)).cast("int")), blocks


def dump(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as bytes; whole numbers are stored in the fewest bytes that hold all of them."""
    out, stored = io.BytesIO(), {}
    for name, values in arrays.items():
        if values.dtype.kind in "iu" and values.itemsize > 1:
            low, high = (values.min(), values.max()) if values.size else (0, 0)
            fits = next(t for t in (np.uint8, np.int8, np.uint16, np.int16, np.uint32, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
            values, name = values.astype(fits), f"whole {name}"
        stored[name] = values
    np.savez(out, **stored)
    return out.getvalue()


def load(payload: bytes) -> dict[str, np.ndarray]:
    """The arrays of dump(); stored whole numbers come back as 64-bit integers."""
    with np.load(io.BytesIO(payload)) as stored:
        return {
            name.removeprefix("whole "): stored[name].astype(np.int64) if name.startswith("whole ") else stored[name]
            for name in stored.files
        }


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows; shorter ones are filled with zeros, which add nothing to an inner product."""
    parts = [np.diff(c.offsets.to_numpy()) for c in lists.chunks]
    lengths = np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
    values = np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy() for c in lists.chunks]])
    out = np.zeros((len(lengths), lengths.max(initial=0)), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def keys_of(table: pa.Table) -> dict[str, np.ndarray]:
    """ids, whether they are null, and places, as arrays."""
    ids = table.column("id")
    return {
        "id": ids.fill_null(np.iinfo(np.int64).max).to_numpy(), "none": ids.is_null().to_numpy(),
        "place_file": table.column(PLACE[0]).to_numpy(), "place_row": table.column(PLACE[1]).to_numpy(),
    }


def pack(blocked: DataFrame, block: str, make: Callable[[pa.Table], dict[str, np.ndarray]], purpose: str) -> DataFrame:
    """(block, payload): make(rows of the block) as one written row a block."""
    def run(table: pa.Table) -> pa.Table:
        number = table.column(block)[0].as_py()
        return pa.table({"block": pa.array([number], pa.int32()), "payload": pa.array([dump(make(table))], pa.binary())})

    return freeze(blocked.groupBy(block).applyInArrow(run, "block int, payload binary"), purpose)


def meet(candidates: DataFrame, blocks: int, queries: DataFrame, work: Callable, schema: str) -> DataFrame:
    """The rows of work(block, candidate arrays, query arrays), a record batch, for every pair of blocks.

    Queries are dealt out to the numbers of the candidate blocks and merged with them there; neither side is broadcast.
    """
    tasks = min(3 * blocks, MOST_TASKS)
    dealt = queries.select(F.col("payload").alias("query"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    met = dealt.repartition(tasks, "block").hint("merge").join(candidates.repartition(tasks, "block"), "block")

    def run(batches):
        for batch in batches:
            held = None
            for number, payload, query in zip(*[batch.column(i) for i in range(3)]):
                stored = payload.as_py()
                if held is None or held[0] != stored:
                    held = (stored, load(stored))
                yield work(number.as_py(), held[1], load(query.as_py()))

    return map_arrow(met.select("block", "payload", "query"), run, schema)


def selected(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, highest first, equal ones by position."""
    k = min(k, len(scores))
    if not k:
        return np.zeros(0, np.int64)
    cut = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > cut)
    chosen = np.concatenate([above, np.flatnonzero(scores == cut)[: k - len(above)]])
    return chosen[np.argsort(-scores[chosen], kind="stable")]
