"""Repeated passages by De Bruijn compaction.

A window is WINDOW consecutive words, an edge of the graph whose nodes are the word sequences one shorter. The graph is
built in compacted form. Every window is led by one of its k-mers, the one with the smallest hash; neighbouring windows
mostly share it, and a run of windows with the same leading k-mer, a path, is stored as one row: the k-mer, a 128-bit
name of the words the path covers, and its source coordinates (document, first window, last window). Equal windows have
equal leading k-mers, so a window can repeat only among the paths of its k-mer.

1. Documents and names are counted by k-mer and joined back to the coordinates. Paths whose k-mer is in a single
   document drop out. A k-mer with one name is nonbranching: its path is the same wherever it occurs.
2. What is left is joined to the smallest document of its (k-mer, name). A path that also occurs in a smaller document
   is removed whole, without looking at its windows. That is what happens inside long repeated passages and copies.
3. Only where a k-mer has several names, at the ends of passages and around edits, the first occurrences of each name are
   opened into windows, which are named by 128 bits and compared in the same way.
4. The coordinates are joined to the texts, and the words they cover are cut.

No group is gathered: all counts are partial minima before the shuffle, and rows meet in joins that Spark can split.

Defined results: null and empty texts have no words; texts shorter than a window keep all; rows with null doc_id neither
remove nor lose words; rows of equal doc_id do not remove each other's words; very long texts are processed whole; an
empty table gives no rows; other columns are never read. Bytes 0x20 and 0x09-0x0D separate words.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACE, freeze, map_arrow, with_place

WINDOW, KMER = 50, 12
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_U = np.uint64


@lru_cache(4)
def _powers(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    with np.errstate(over="ignore"):
        return [
            tuple(np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, b, _U)])) for b in (base, pow(base, -1, 1 << 64)))
            for base in _BASES
        ]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(32))


class Names:
    """128-bit names of any run of words of one text, in constant time each."""

    def __init__(self, words: list[bytes]):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
        room = 1 << max(12, len(words).bit_length())
        with np.errstate(over="ignore"):
            self.sides = []
            for up, down in _powers(room):
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * up[:len(words)], dtype=_U)])
                self.sides.append((sums, down))

    def name(self, start: np.ndarray, end: np.ndarray, side: int = 0) -> np.ndarray:
        sums, down = self.sides[side]
        with np.errstate(over="ignore"):
            return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U)).view(np.int64)


def paths(words: list[bytes], window: int = WINDOW, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """(leading k-mer, name, second half of the name, first window, last window) of each path of a text."""
    n = len(words) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    names = Names(words)
    starts = np.arange(len(words) - kmer + 1)
    kmers = names.name(starts, starts + kmer)
    lead = np.lib.stride_tricks.sliding_window_view(kmers, window - kmer + 1).argmin(1) + np.arange(n)
    first = np.concatenate([[0], np.flatnonzero(lead[1:] != lead[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [n - 1]])
    end = last + window
    return kmers[lead[first]], names.name(first, end, 0), names.name(first, end, 1), first, last


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64), kind))


def _sketches(rows: DataFrame, window: int, kmer: int) -> DataFrame:
    """Per row: place, doc, n_words, sha of all words, and its paths as parallel arrays."""

    def sketch(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts, shas, found = [], [], []
                for text in some.column(3).to_pylist():
                    words = _words(text)
                    counts.append(len(words))
                    shas.append(_digest(words))
                    found.append(paths(words, window, kmer))
                columns = [_lists([f[i] for f in found], pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(counts, pa.int64()), pa.array(shas, pa.string()), *columns],
                    names=[*some.schema.names[:3], "n_words", "sha", "kmer", "high", "low", "first", "last"],
                )

    arrays = ", ".join(f"{c} array<bigint>" for c in ("kmer", "high", "low", "first", "last"))
    return map_arrow(rows, sketch, f"{PLACE[0]} bigint, {PLACE[1]} bigint, doc bigint, n_words bigint, sha string, {arrays}")


def _judged_paths(sketches: DataFrame) -> DataFrame:
    """(place, first, last, whole): paths to remove whole, and paths to open into windows."""
    rows = sketches.where("doc is not null").select(
        *PLACE, "doc", F.explode_outer(F.arrays_zip("kmer", "high", "low", "first", "last")).alias("p")
    ).select(*PLACE, "doc", "p.*")
    rows = rows.where("kmer is not null")
    met = freeze(
        rows.groupBy("kmer").agg(
            F.min("doc").alias("a"), F.max("doc").alias("z"), (F.min("high") != F.max("high")).alias("branching")
        ).where("a < z").select("kmer", "branching"),
        "path-kmers",
    )
    repeated = freeze(rows.join(met, "kmer"), "path-repeats")
    named = freeze(
        repeated.groupBy("kmer", "high", "low").agg(F.min("doc").alias("least")),
        "path-names",
    )
    return repeated.join(named, ["kmer", "high", "low"]).where("branching or doc > least").select(
        *PLACE, "first", "last", (F.col("doc") > F.col("least")).alias("whole")
    )


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(place, doc, at, high, low) of the windows of the paths to open."""

    def open_paths(batches):
        for batch in batches:
            for place_a, place_b, doc, text, ranges in zip(*[c.to_pylist() for c in batch.columns]):
                at = np.concatenate([np.arange(r["first"], r["last"] + 1) for r in ranges if not r["whole"]] or [np.zeros(0, np.int64)])
                if not len(at):
                    continue
                names, n = Names(_words(text)), len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place_a] * n, pa.int64()), pa.array([place_b] * n, pa.int64()), pa.array([doc] * n, pa.int64()),
                     pa.array(at, pa.int64()), *[pa.array(names.name(at, at + window, s), pa.int64()) for s in (0, 1)]],
                    names=[*PLACE, "doc", "at", "high", "low"],
                )

    return map_arrow(texts, open_paths, f"{PLACE[0]} bigint, {PLACE[1]} bigint, doc bigint, at bigint, high bigint, low bigint")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   kmer: int = KMER) -> tuple[DataFrame, DataFrame]:
    """(all rows: place, doc, n_words, sha of all words; rows with repeats: place, text and their removed window ranges)."""
    rows = with_place(docs.select(key, text)) if PLACE[0] not in docs.columns else docs
    rows = rows.select(*PLACE, F.col(key).cast("bigint").alias("doc"), F.col(text).cast("binary").alias("text"))
    sketches = freeze(_sketches(rows, window, kmer), "sketches")
    judged = _judged_paths(sketches).groupBy(*PLACE).agg(F.collect_list(F.struct("first", "last", "whole")).alias("ranges"))
    texts = freeze(rows.join(judged, list(PLACE)), "repeat-texts").select(*PLACE, "doc", "text", "ranges")
    opened = freeze(_windows(texts, window), "windows")
    least = freeze(
        opened.groupBy("high", "low").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .where("least < most").select("high", "low", "least"),
        "window-names",
    )
    late = opened.join(least, ["high", "low"]).where("doc > least").groupBy(*PLACE).agg(F.collect_list("at").alias("late"))
    removed = texts.join(late, list(PLACE), "left").select(
        *PLACE, "text", F.filter("ranges", lambda r: r["whole"]).alias("ranges"), "late"
    )
    return sketches.select(*PLACE, "doc", "n_words", "sha"), removed


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   kmer: int = KMER) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 of every row, and `kept`, the words that stay, where some were removed."""
    everything, removed = repeated_spans(docs, key, text, window, kmer)

    def cut(batches):
        for batch in batches:
            gone, shas, texts = [], [], []
            for text, ranges, late in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]):
                words = _words(text)
                change = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    change[r["first"]] += 1
                    change[r["last"] + window] -= 1
                late = np.array(late or [], np.int64)
                np.add.at(change, late, 1)
                np.add.at(change, late + window, -1)
                stay = np.cumsum(change[:-1]) == 0
                kept = [w for w, s in zip(words, stay.tolist()) if s]
                gone.append(len(words) - len(kept))
                shas.append(_digest(kept))
                texts.append((b" ".join(kept)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(gone, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*PLACE, "gone", "kept_sha", "kept"],
            )

    cuts = map_arrow(removed, cut, f"{PLACE[0]} bigint, {PLACE[1]} bigint, gone bigint, kept_sha string, kept string")
    return everything.join(cuts, list(PLACE), "left").select(
        F.col("doc").alias(key), "n_words", F.coalesce("gone", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept",
    )
