"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. All blocks of all texts are sorted, and each gets as its name the
rank of its content among the distinct contents. Then neighbouring names are paired, the pairs are sorted and named in
the same way, and so on until each text has a single name. Names come from sorting whole contents, never from a hash,
so two texts share (level, name) exactly if they are equal.

The sort is a range partitioning by a 128-bit digest of the content and by row, so a content that a third of all blocks
have is spread over many tasks, and the ranges are drawn from short keys. Within a task blocks are ordered by digest and
content. A task numbers its contents from zero and reports its first and last one; a task whose first content equals the
last of the task before shares that name. Only these reports, one row a task, are added up. The digest decides where a
block is compared, the bytes decide the name; should two contents of one digest meet at the border of two tasks, the
job stops with an error rather than give a wrong name.

Defined results: null text counts as empty, and all empty texts are equal; of equal texts the row with the largest
doc_id stays, null doc_id last; among rows with equal text and doc_id the one with the largest tie columns stays, so
exactly one row of a group stays; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PLACE, freeze, keep_places, map_arrow, with_place

BLOCK_BYTES = 4096
_CARRY = ("row", "owner", "sha")


def _blocks(docs: DataFrame, owner: list[str], text: str, size: int) -> DataFrame:
    """(row, owner, sha, pos, total, block): folded bytes in blocks; owner and sha on the first block only."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*owner).alias("owner"),
        F.col(text).cast("binary").alias("text"),
    )
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("owner", rows.schema["owner"].dataType), T.StructField("sha", T.StringType()),
        T.StructField("pos", T.LongType()), T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType()),
    ])

    def cut(batches):
        for batch in batches:
            source, sha, pos, total, blocks = [], [], [], [], []
            for i, value in enumerate(batch.column(2)):
                folded = (value.as_py() or b"").lower()
                pieces = [folded[a:a + size] for a in range(0, len(folded), size)] or [b""]
                source += [i] * len(pieces)
                sha += [hashlib.sha256(folded).hexdigest()] + [None] * (len(pieces) - 1)
                pos += range(len(pieces))
                total += [len(pieces)] * len(pieces)
                blocks += pieces
            take = pa.array(source, pa.int64())
            first = pa.array([i if p == 0 else None for i, p in zip(source, pos)], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(first), pa.array(sha, pa.string()),
                pa.array(pos, pa.int64()), pa.array(total, pa.int64()), pa.array(blocks, pa.binary()),
            ], names=["row", "owner", "sha", "pos", "total", "block"])

    return map_arrow(rows, cut, schema)


def _named(items: DataFrame, content: list[str]) -> DataFrame:
    """Replace the content columns by `name`, the rank of the content among all distinct contents."""
    rest = [c for c in items.columns if c not in content]
    digests = [F.xxhash64(*content), F.xxhash64(F.lit(1), *content)]
    ordered = (
        items.repartitionByRange(*digests, "row", "pos").sortWithinPartitions(digests[0], *content)
        .select(*rest, *content)
    )
    fields = {f.name: f for f in items.schema}
    schema = T.StructType(
        [T.StructField("task", T.IntegerType()), T.StructField("rank", T.LongType())]
        + [T.StructField(c, fields[c].dataType) for c in rest]
        + [T.StructField(f"{e}_{c}", fields[c].dataType) for e in ("first", "last") for c in content]
    )
    n = len(rest)

    def number(batches):
        task, last, first, rank, arrow = TaskContext.get().partitionId(), None, None, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            arrow = batch.schema
            keys = batch.columns[n:]
            head = tuple(k[0].as_py() for k in keys)
            changes = [head != last]
            if batch.num_rows > 1:
                differ = [pc.not_equal(k[1:], k[:-1]) for k in keys]
                changes += (differ[0] if len(differ) == 1 else pc.or_(*differ)).to_pylist()
            ranks = []
            for change in changes:
                rank += change
                ranks.append(rank)
            first = first if first is not None else head
            last = tuple(k[-1].as_py() for k in keys)
            none = [pa.nulls(batch.num_rows, k.type) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * batch.num_rows, pa.int32()), pa.array(ranks, pa.int64()), *batch.columns[:n], *none, *none],
                names=schema.names,
            )
        if first is not None:
            edges = [pa.array([v], t.type) for vs in (first, last) for v, t in zip(vs, list(arrow)[n:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([rank], pa.int64()), *[pa.nulls(1, t.type) for t in list(arrow)[:n]], *edges],
                names=schema.names,
            )

    numbered = freeze(map_arrow(ordered, number, schema), "names")
    # one row a task from here on
    order = Window.orderBy("task")
    tasks = freeze(
        numbered.where("row is null").withColumn("at", F.row_number().over(order)).drop("row", *rest), "name-tasks"
    )
    before = tasks.select((F.col("at") + 1).alias("at"), *[F.col(f"last_{c}").alias(f"before_{c}") for c in content])
    first, last = [F.struct(*[F.col(f"{side}_{c}").alias(c) for c in content]) for side in ("first", "before")]
    clash = (F.xxhash64(first) == F.xxhash64(last)) & (first != last)
    same = F.when(clash, F.raise_error(F.lit("two contents of one digest at a border"))).otherwise(first == last)
    offsets = (
        tasks.join(before, "at", "left")
        .select("at", "task", (F.col("rank") + 1).alias("n"), F.coalesce(same, F.lit(False)).cast("long").alias("same"))
        .withColumn("offset", F.sum(F.col("n") - F.col("same")).over(Window.orderBy("at")) - F.col("n"))
        .select("task", "offset")
    )
    return (
        numbered.where("row is not null").join(offsets, "task")
        .select(*rest, (F.col("offset") + F.col("rank")).alias("name"))
    )


def identities(docs: DataFrame, owner: list[str], text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: owner columns, sha (folded text), level and name; equal (level, name) means equal text."""
    named = freeze(_named(_blocks(docs, owner, text, block_bytes), ["block"]), "level")
    done, level = [], 0
    while True:
        done.append(named.where("total = 1").select(*_CARRY, F.lit(level).alias("level"), "name"))
        open_rows = named.where("total > 1")
        if open_rows.isEmpty():
            break
        even = F.col("pos") % 2 == 0
        pairs = open_rows.groupBy("row", F.expr("pos div 2").alias("half")).agg(
            F.max("owner").alias("owner"), F.max("sha").alias("sha"),
            F.max(F.expr("(total + 1) div 2")).alias("total"),
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
        ).select(*_CARRY, F.col("half").alias("pos"), "total", "a", "b")
        level += 1
        named = freeze(_named(pairs, ["a", "b"]), "level")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def duplicate_groups(docs: DataFrame, key: str = "doc_id", ties: tuple[str, ...] = (), text: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, tie columns, keep_id, group_size, kept, text_sha256, level and name of every row."""
    rows = identities(docs, [key, *ties], text, block_bytes)
    groups = freeze(rows.groupBy("level", "name").agg(
        F.max(F.struct("owner", "row")).alias("keep"), F.count("*").alias("group_size")
    ), "groups")
    return rows.join(groups, ["level", "name"]).select(
        *[F.col(f"owner.{c}").alias(c) for c in (key, *ties)],
        F.col(f"keep.owner.{key}").alias("keep_id"), "group_size",
        (F.col("keep.row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"), "level", "name",
    )


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of docs."""
    placed = with_place(docs)
    return keep_places(placed, duplicate_groups(placed, key, PLACE, text).where("kept"))
