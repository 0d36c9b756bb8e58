"""Sharding by extendible hashing.

A row's key has a string of 60 hash bits, followed by 60 bits of the row's own that matter only among rows of equal
key. The directory starts with one bucket, the empty prefix; a bucket over the byte limit is split on its next bit, and
a bucket that fits is left alone. So the shard of a row is its shortest prefix whose bucket fits, and shards differ in
depth only where the data are uneven.

Splitting is done for many bits at once: rows are summed by a prefix some bits longer than the average shard needs
(cells), the sums of all shorter prefixes follow from the cells, and a cell's shard is the first of its prefixes that
fits. Cells that do not fit themselves are cut further in the next round, and nothing else is; a cell that holds a
single key goes on to the row bits directly. A key that holds a third of all rows is thus split like any other bucket,
and no bucket is ever gathered: all sums are partial before the shuffle, and rows meet cells in joins Spark can split.

Defined results: null and empty texts have 0 bytes and are placed like others; a single row over the limit is a shard of
its own; null keys are equal keys; repeated rows are told apart by their place in the first scan, which is written, so
every row is placed once; an empty table gives no rows; in `assign` clashing names of other columns can't occur, as
only the columns asked for are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze

SHARD_BYTES = 64 << 20
KEY_BITS, ALL_BITS, SPARE_BITS = 60, 120, 3


def _bits(value: Column) -> Column:
    return F.lpad(F.conv(F.substring(F.md5(value), 1, KEY_BITS // 4), 16, 2), KEY_BITS, "0")


def _prefixes(cells: DataFrame) -> DataFrame:
    return cells.withColumn("prefix", F.explode(F.transform(
        F.sequence(F.col("base") + 1, F.col("depth")), lambda d: F.substring("cell", F.lit(1), d)
    )))


def assign(rows: DataFrame, key: str = "doc_id", n_bytes: str | Column = "n_bytes", keep: tuple[str, ...] = (),
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """key, kept columns, n_bytes, shard (its bits), depth, shard_bytes and shard_rows of every row."""
    size = F.col(n_bytes) if isinstance(n_bytes, str) else n_bytes
    names = [key, *keep]
    placed = freeze(
        rows.select(
            *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(size, F.lit(0)).cast("long").alias("n_bytes"),
            F.concat(
                _bits(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
                _bits(F.monotonically_increasing_id().cast("string").cast("binary")),
            ).alias("bits"),
        ),
        "sharded-rows",
    )
    total = placed.agg(F.sum("n_bytes")).first()[0] or 0
    need = math.ceil(math.log2(max(1.0, total / shard_bytes))) + SPARE_BITS
    open_rows = placed.withColumns({"base": F.lit(-1), "depth": F.lit(need)})
    parts = []
    while True:
        celled = open_rows.withColumn("cell", F.expr("substring(bits, 1, depth)"))
        cells = freeze(
            celled.groupBy("cell", "base", "depth").agg(
                F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"),
                F.min(F.expr(f"substring(bits, 1, {KEY_BITS})")).alias("a"), F.max(F.expr(f"substring(bits, 1, {KEY_BITS})")).alias("z"),
            ),
            "cells",
        )
        nodes = freeze(
            _prefixes(cells).groupBy("prefix", "base").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
            .withColumn("fits", (F.col("shard_bytes") <= shard_bytes) | (F.col("shard_rows") == 1)),
            "directory",
        )
        above = nodes.where("not fits").select(F.col("prefix").alias("parent"))
        first = nodes.where("fits and length(prefix) = base + 1")
        deeper = nodes.where("fits and length(prefix) > base + 1").withColumn(
            "parent", F.expr("substring(prefix, 1, length(prefix) - 1)")
        ).join(above, "parent").select(*nodes.columns)
        shards = first.unionByName(deeper).select("prefix", "shard_bytes", "shard_rows")
        cell_shard = freeze(_prefixes(cells.select("cell", "base", "depth")).join(shards, "prefix").select(
            "cell", F.col("prefix").alias("shard"), "shard_bytes", "shard_rows"
        ), "cell-shards")
        parts.append(celled.join(cell_shard, "cell"))
        rest = cells.join(cell_shard, "cell", "left_anti")
        worst = rest.agg(F.max("bytes")).first()[0]
        if worst is None:
            break
        # a cell of one key has nothing left to split in its key bits
        more = math.ceil(math.log2(max(2.0, worst / shard_bytes))) + SPARE_BITS
        start = F.when((F.col("a") == F.col("z")) & (F.col("depth") < KEY_BITS), F.lit(KEY_BITS)).otherwise(F.col("depth"))
        next_cells = freeze(rest.select(
            "cell", start.alias("next_base"), F.least(start + more, F.lit(ALL_BITS)).alias("next_depth"),
        ), "open-cells")
        open_rows = freeze(
            celled.join(next_cells, "cell").drop("cell", "base", "depth")
            .withColumnsRenamed({"next_base": "base", "next_depth": "depth"}),
            "open-rows",
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_bytes", "shard",
        F.length("shard").alias("depth"), "shard_bytes", "shard_rows",
    )


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Write docs as Parquet below path, one folder `shard=<bits>` per shard; a shard is written by one task."""
    packed = docs.select(F.col(key).alias("shard_key"), text_bytes(text).alias("row_bytes"), F.struct("*").alias("row"))
    placed = assign(packed, "shard_key", "row_bytes", ("row",), shard_bytes)
    placed.select("row.*", F.concat(F.lit("p"), "shard").alias("shard")).repartition("shard").write.partitionBy("shard").parquet(path)
