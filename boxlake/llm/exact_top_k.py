"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of weighted terms: its non-zero components, numbered by dimension. A block of candidates is
packed as postings, for every term the positions and weights of the candidates that hold it; a list that fills more than
half of its block is stored with its gaps as zeros and without positions. A query visits its terms one by one and
scatters weight times posting weight into a dense array with one score for each candidate of the block. Partition
selection takes the k best of the array, and the short lists of all blocks are merged by a ranked window, which Spark
cuts to k rows a task before its shuffle.

Every query meets every candidate, in blocks of bounded size; no index decides what is looked at. Scores are 64-bit
integers.

Defined results: rows with a null vector or a null or non-finite component take no part; vectors of other lengths are
compared over the dimensions they share; an empty vector scores zero; a row is told from others by its place, so
repeated rows and equal ids are candidates of each other; equal scores go by smaller id, null ids last; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import vectors
from .common import PLACE

TOP, SCALE = 5, 256


def postings(table: pa.Table) -> dict[str, np.ndarray]:
    """Posting lists of a block; candidates are numbered in the order in which equal scores rank."""
    keys, x = vectors.keys_of(table), vectors.matrix(table.column("x"))
    order = np.lexsort((keys["place_row"], keys["place_file"], keys["id"], keys["none"]))
    x, lists, places = x[order], [], []
    for weights in x.T:
        held = np.flatnonzero(weights)
        full = 2 * len(held) > len(weights)
        lists.append(weights if full else weights[held])
        places.append(held[:0] if full else held)
    return {name: values[order] for name, values in keys.items()} | {
        "weights": np.concatenate([np.zeros(0, np.int64), *lists]), "ends": np.cumsum([0, *map(len, lists)]),
        "places": np.concatenate([np.zeros(0, np.int64), *places]), "place_ends": np.cumsum([0, *map(len, places)]),
    }


def accumulate(block: dict[str, np.ndarray], query: np.ndarray) -> np.ndarray:
    """Scores of all candidates of a block against one query, term at a time."""
    scores, ends, place_ends = np.zeros(len(block["id"]), np.int64), block["ends"], block["place_ends"]
    for term in np.flatnonzero(query[: len(ends) - 1]):
        weighted = block["weights"][ends[term]:ends[term + 1]] * query[term]
        if place_ends[term] == place_ends[term + 1] and len(weighted) == len(scores):
            scores += weighted
        else:
            scores[block["places"][place_ends[term]:place_ends[term + 1]]] += weighted
    return scores


def _searched(k: int):
    def work(number, block, queries):
        found = []
        for at, x in enumerate(queries["x"]):
            scores, own = accumulate(block, x), np.zeros(0, np.int64)
            if queries["home"][at] == number:
                own = np.flatnonzero((block["place_file"] == queries["place_file"][at]) & (block["place_row"] == queries["place_row"][at]))
            best = vectors.selected(scores, k + len(own))
            best = best[~np.isin(best, own)][:k]
            found.append((np.full(len(best), at), best, scores[best]))
        at, best, scores = (np.concatenate([np.zeros(0, np.int64), *part]) for part in zip(*found)) if found else np.zeros((3, 0), np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(queries["id"][at]), pa.array(queries["place_file"][at]), pa.array(queries["place_row"][at]),
            pa.array(block["id"][best], pa.int64(), mask=block["none"][best]), pa.array(scores, pa.int64()),
        ], ["query_id", *PLACE, "id", "score"])

    return work


def _packed_queries(table: pa.Table) -> dict[str, np.ndarray]:
    return vectors.keys_of(table) | {"x": vectors.matrix(table.column("x")), "home": table.column("block").to_numpy()}


def search(rows: DataFrame, is_query: Column, k: int = TOP, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE, components: int = vectors.COMPONENTS) -> DataFrame:
    """query_id, rank, key and score: the k best other rows of every query row with a key."""
    asked = F.coalesce(is_query, F.lit(False)) & F.col(key).isNotNull()
    blocked, blocks = vectors.in_blocks(vectors.integer_vectors(rows, key, vector, scale, asked=asked), components=components)
    queries, _ = vectors.in_blocks(blocked.where("asked"), "query_block", components)
    lists = vectors.pack(blocked, "block", postings, "postings")
    asked_for = vectors.pack(queries, "query_block", _packed_queries, "top-k-queries")
    schema = f"query_id long, {PLACE[0]} long, {PLACE[1]} long, id long, score long"
    found = vectors.meet(lists, blocks, asked_for, _searched(k), schema)
    order = W.partitionBy(*PLACE, "query_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score"
    )
