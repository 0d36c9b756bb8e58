"""Connected components by star contraction: joins and partial minima only, no group is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(high, low))")).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    Each round links every node to the smallest node it can see, first from its larger neighbours, then from its
    smaller ones, until only stars remain; the number of rounds grows with the logarithm of the longest path. Rounds
    are written tables. Edges may repeat, in either direction; loops are dropped; no edges give no rows.
    """
    stars = freeze(
        edges.select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
        .where("high <> low").distinct(),
        "stars",
    )
    seen = _state(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("root")).withColumn("root", F.least("high", "root"))
        wide = (
            both.join(least, "high").where("low > high")
            .select(F.col("low").alias("high"), F.col("root").alias("low")).where("high <> low").distinct()
        )
        nearest = wide.groupBy("high").agg(F.min("low").alias("root"))
        stars = freeze(
            wide.join(nearest, "high").select(F.col("low").alias("high"), F.col("root").alias("low"))
            .unionByName(nearest.select("high", F.col("root").alias("low")))
            .where("high <> low").distinct(),
            "stars",
        )
        now = _state(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.unionByName(stars.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
