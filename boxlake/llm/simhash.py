"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Every bit of a fingerprint is given a point of the projective space PG(r, q). A table keeps the bits off one
hyperplane. Any r points lie on a common hyperplane, so two fingerprints that differ in at most r bits agree in the
table of a hyperplane through the differing bits: no pair within the radius is lost. With r = 2 and q = 3 there are 13
tables that keep about 44 of 64 bits each, so unrelated documents seldom meet.

Inside a bucket no pairs are formed. Members differ in dropped bits alone, and two of them are within r bits of each
other exactly if they are both within r / 2 flips of one value. Each fingerprint names the values within r / 2 flips of
the bits that any of its shared buckets drops, each value once, and those that name the same value are linked to the
smallest of them. For r = 2 a fingerprint names and a value has at most 65, whatever the size of a bucket.

Defined results: null text and text without words have fingerprint zero; repeated rows and ties share a fingerprint
and a component; null doc_id counts only if a component has no other; an empty table gives no rows; other columns are
never read.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLACE, freeze, keep_places, map_arrow, with_place
from .graph import components

SHINGLE, RADIUS, FIELD, BITS = 3, 2, 3, 64
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text, A-Z folded; repeated shingles count each time.

    bytes.split() cuts at exactly space and 0x09-0x0D, and bytes.lower() changes A-Z alone.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])
        hashes = np.array([digest(joined[a:b]) for a, b in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns `keep` of every row plus `print`, the signed fingerprint of its whole text."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("text"))
    n = len(keep)

    def compute(batches):
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(n)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], prints], [*batch.schema.names[:n], "print"])

    schema = ", ".join([*(f"k{i} {t}" for i, (_, t) in enumerate(rows.dtypes[:n])), "print bigint"])
    out = map_arrow(rows, compute, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "print")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(radius: int = RADIUS, q: int = FIELD) -> list[tuple[int, list[int]]]:
    """(kept bits as a mask, dropped bit positions) per table; q is prime."""
    points = [p for p in product(range(q), repeat=radius + 1) if any(p) and next(x for x in p if x) == 1]
    tables = []
    for plane in points:
        dropped = [
            bit for bit in range(BITS)
            if sum(a * b for a, b in zip(plane, points[bit % len(points)])) % q == 0
        ]
        mask = ((1 << BITS) - 1) & ~sum(1 << bit for bit in dropped)
        tables.append((mask, dropped))
    return tables


def _middles(flips: int) -> Column:
    """Every value within `flips` flips of the bits `loose` of `print`, once each."""
    bits = F.filter(
        F.array(*[F.lit(_signed(1 << bit)) for bit in range(BITS)]), lambda b: b.bitwiseAND(F.col("loose")) != 0
    )
    values = F.array("print")
    for _ in range(flips):
        near = F.flatten(F.transform(values, lambda v: F.transform(bits, lambda b: v.bitwiseXOR(b))))
        values = F.array_distinct(F.concat(values, near))
    return values


def links(prints: DataFrame, radius: int = RADIUS, q: int = FIELD) -> DataFrame:
    """Links (print, least) among distinct fingerprints; they connect exactly what lies within `radius` bits, chained."""
    if radius < 2 or radius % 2:
        raise ValueError("radius must be even and at least 2")
    tables = covering_masks(radius, q)
    keys = F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for i, (mask, _) in enumerate(tables)
    ])
    buckets = prints.select("print", F.explode(keys).alias("b")).select("print", "b.table", "b.key")
    shared = buckets.groupBy("table", "key").agg(F.min("print").alias("a"), F.max("print").alias("z"))
    met = buckets.join(shared.where("a <> z").select("table", "key"), ["table", "key"], "left_semi")
    # a bit that several tables drop is flipped once
    loose = F.element_at(F.array(*[F.lit(_signed(~mask & (1 << BITS) - 1)) for mask, _ in tables]), F.col("table") + 1)
    open_bits = met.groupBy("print").agg(F.bit_or(loose).alias("loose"))
    named = open_bits.select("print", F.explode(_middles(radius // 2)).alias("middle"))
    least = named.groupBy("middle").agg(F.min("print").alias("least"), F.max("print").alias("most"))
    return (
        named.join(least.where("least <> most"), "middle").where("print <> least").select("print", "least").distinct()
    )


def near_groups(docs: DataFrame, key: str = "doc_id", extra: tuple[str, ...] = (), text: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """key, extra columns, `print`, `root` (a print that names the group) and `component` (smallest key reachable by links).

    Groups that share a smallest key, or have none, still have roots of their own.
    """
    prints = freeze(fingerprints(docs, [key, *extra], text, shingle), "prints")
    ids = freeze(prints.groupBy("print").agg(F.min(key).alias("least_key")), "print-ids")
    found = components(links(ids.select("print"), radius), "print", "least")
    rooted = ids.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    smallest = rooted.groupBy("root").agg(F.min("least_key").alias("component"))
    classes = rooted.select("print", "root").join(smallest, "root").select("print", "root", "component")
    return prints.join(classes, "print").select(key, *extra, "print", "root", "component")


def hex_print(column: str = "print"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate group stays: the smallest key, of equal keys the first by place."""
    placed = with_place(docs)
    grouped = near_groups(placed, key, PLACE, text)
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col(key).isNull(), key, *PLACE)).alias("first"))
    return keep_places(placed, first.select(*[f"first.{c}" for c in PLACE]))
