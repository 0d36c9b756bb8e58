"""Ranked lexical search with Block-Max MaxScore over a sharded inverted index.

Documents are indexed where they are read: a task turns every few million postings of its documents into one shard, so
no text and no posting is shuffled. A shard keeps its documents in the order of equal scores and, for every term, a
posting list in blocks of BLOCK postings, stored as variable-byte gaps and counts. Beside each block lie its last
document and its staircase: for every count that occurs, the shortest document that reaches it. Scores grow with the
count and fall with the length, so the staircase gives the exact block maximum under any corpus statistics.

Corpus statistics (documents, terms, document frequency) are sums over shards. Query items are packed in blocks that
meet every shard; per item and shard, lists are visited by falling bound. A list is essential while the bounds of it
and of all lists after it reach the k-th best score so far; the rest can't lift a new document into the result and
are never candidates. A document of an essential list first gets the bounds, then the block maxima of the lists
after it added; only documents that still reach the k-th score have blocks decompressed, one list after the other. The k
best of all shards are merged by a ranked window, which Spark cuts to k rows a task before its shuffle.

Defined results: null texts and texts without a term are in no list and count for no statistic; items without a term
that occurs give no rows; only scores above zero are returned; items are told apart by their place, so equal item ids
are answered each; equal scores go by smaller key, null keys last; long texts are indexed whole; empty tables give no
rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.operators.batching import KEY_BOUND, with_ordinal

from . import vectors
from .common import PLACE, fold_ascii, freeze, map_arrow, with_place

TOP, BLOCK, SHARD_POSTINGS, ITEMS_A_BLOCK, LEAD = 10, 128, 1 << 21, 256, 256
BETWEEN_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A-Z become a-z, all other ASCII characters but a-z and 0-9 a blank; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class _Numbers(dict):
    """Terms to numbers, in the order in which they turn up."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _encoded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-byte code of non-negative values, low bits first, and the end of each value in it."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        sizes += values >= 1 << bits
    ends = np.cumsum(sizes)
    out, starts = np.zeros(int(sizes.sum()), np.uint8), ends - sizes
    for step in range(int(sizes.max(initial=0))):
        some = sizes > step
        more = (sizes[some] > step + 1).astype(np.uint8) << 7
        out[starts[some] + step] = (values[some] >> (7 * step) & 127).astype(np.uint8) | more
    return out, ends


def _decoded(code: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(code < 128)
    starts = np.concatenate([[0], last[:-1] + 1])
    step = np.arange(len(code)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((code & 127).astype(np.int64) << (7 * step), starts) if len(code) else code.astype(np.int64)


def _shard(terms: _Numbers, keys: list[int | None], docs: list[np.ndarray], counts: list[np.ndarray], lengths: list[int]) -> dict:
    """One shard from the term numbers and counts of its documents."""
    none = np.array([k is None for k in keys])
    key = np.array([0 if k is None else k for k in keys], np.int64)
    order = np.lexsort((key, none))
    seat = np.empty(len(order), np.int64)
    seat[order] = np.arange(len(order))
    sizes = np.array(lengths, np.int64)[order]
    doc = np.repeat(seat, [len(d) for d in docs])
    term, tf = np.concatenate(docs), np.concatenate(counts)
    by = np.lexsort((doc, term))
    doc, term, tf = doc[by], term[by], tf[by]
    df = np.bincount(term, minlength=len(terms))
    first = np.cumsum(df) - df
    place = np.arange(len(doc)) - np.repeat(first, df)
    head = np.flatnonzero(place % BLOCK == 0)
    gaps = doc.copy()
    gaps[1:] -= doc[:-1]
    gaps[head] = doc[head]
    code, ends = _encoded(np.stack([gaps, tf], axis=1).ravel())
    block_ends = np.append(head[1:], len(doc))
    block = np.repeat(np.arange(len(head)), block_ends - head)
    # the staircase: of each block and count, the shortest document; longer ones of smaller counts are below it
    stairs = np.lexsort((sizes[doc], -tf, block))
    new = np.ones(len(stairs), bool)
    new[1:] = (block[stairs][1:] != block[stairs][:-1]) | (tf[stairs][1:] != tf[stairs][:-1])
    stairs = stairs[new]
    names = list(terms)
    return {
        "key": key[order], "none": none[order], "size": sizes, "code": code,
        "code_size": np.diff(ends[2 * block_ends - 1], prepend=0), "block_first": doc[head], "block_last": doc[block_ends - 1],
        "stair_tf": tf[stairs], "stair_size": sizes[doc[stairs]], "stair_count": np.bincount(block[stairs], minlength=len(head)),
        "term": np.frombuffer(b" ".join(names), np.uint8), "df": df,
    }


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """One written row a shard: n_docs and n_terms, its terms with their document frequency, and the packed lists."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))

    def row(state: tuple) -> pa.RecordBatch:
        shard = _shard(*state)
        names, df = [t.decode() for t in state[0]], shard["df"]
        entries = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(df, pa.int64())], ["term", "df"])
        return pa.RecordBatch.from_arrays([
            pa.array([len(shard["key"])], pa.int64()), pa.array([int(shard["size"].sum())], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), entries), pa.array([vectors.dump(shard)], pa.binary()),
        ], ["n_docs", "n_terms", "terms", "payload"])

    def build(batches):
        state, held = (_Numbers(), [], [], [], []), 0
        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                words = terms_of(t.as_py() or b"")
                if not words:
                    continue
                terms, keys, found, counts, lengths = state
                numbers, tf = np.unique(np.fromiter(map(terms.__getitem__, words), np.int64, len(words)), return_counts=True)
                keys.append(k.as_py())
                found.append(numbers.astype(np.int32))
                counts.append(tf.astype(np.int32))
                lengths.append(len(words))
                held += len(numbers)
                if held >= shard_postings:
                    yield row(state)
                    state, held = (_Numbers(), [], [], [], []), 0
        if held:
            yield row(state)

    schema = "n_docs long, n_terms long, terms array<struct<term:string,df:long>>, payload binary"
    return freeze(map_arrow(rows, build, schema), "lexical-index")


class Shard:
    """A stored shard made ready for searches under given corpus statistics; a block is decompressed once, when it is first needed."""

    def __init__(self, stored: dict[str, np.ndarray], n_docs: int, n_terms: int):
        self.code, self.code_ends = stored["code"], np.concatenate([[0], np.cumsum(stored["code_size"])])
        self.ends = np.concatenate([[0], np.cumsum(-(-stored["df"] // BLOCK))])
        self.first, self.last = stored["block_first"], stored["block_last"]
        self.m = 10 + 90 * stored["size"] * n_docs // n_terms
        names = stored["term"].tobytes().split(b" ")
        self.number = {term: i for i, term in enumerate(names)}
        stairs = self.impact(stored["stair_tf"], 10 + 90 * stored["stair_size"] * n_docs // n_terms)
        self.peak = np.maximum.reduceat(stairs, np.cumsum(stored["stair_count"]) - stored["stair_count"])
        self.list_peak = np.maximum.reduceat(self.peak, self.ends[:-1])
        sizes = np.full(self.ends[-1], BLOCK)
        sizes[self.ends[1:] - 1] = (stored["df"] - 1) % BLOCK + 1
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        # a closed block repeats its first document, so that lists are sorted throughout
        self.docs = np.repeat(self.first, sizes).astype(np.int32)
        self.impacts = np.zeros(len(self.docs), np.int32)
        self.closed = np.ones(len(sizes), bool)

    @staticmethod
    def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m)

    def _postings(self, blocks: np.ndarray) -> np.ndarray:
        """Positions of the postings of blocks."""
        sizes = self.starts[blocks + 1] - self.starts[blocks]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1]) + np.repeat(self.starts[blocks] - ends + sizes, sizes)

    def open(self, blocks: np.ndarray) -> None:
        blocks = blocks[self.closed[blocks]]
        if not len(blocks):
            return
        values = _decoded(np.concatenate([self.code[self.code_ends[b]:self.code_ends[b + 1]] for b in blocks])).reshape(-1, 2)
        spots, sizes = self._postings(blocks), self.starts[blocks + 1] - self.starts[blocks]
        docs, heads = np.cumsum(values[:, 0]), np.cumsum(sizes) - sizes
        # gaps start anew in every block, with the block's first document
        docs -= np.repeat(docs[heads] - values[heads, 0], sizes)
        self.docs[spots], self.impacts[spots] = docs, self.impact(values[:, 1], self.m[docs])
        self.closed[blocks] = False

    def best(self, terms: list[tuple[bytes, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Seats and scores of the k best documents."""
        lists = [(w * int(self.list_peak[i]), w, i) for t, w in terms if w > 0 and (i := self.number.get(t)) is not None]
        lists.sort(reverse=True)
        after = np.append(np.cumsum([b for b, _, _ in lists][::-1])[::-1], 0)
        seats, scores, need, at, room = np.zeros(0, np.int64), np.zeros(0, np.int64), 1, 0, LEAD
        seen = np.zeros(len(self.m), bool)
        while at < len(lists) and after[at] >= need:
            # lists are essential up to here; a few of them give the next candidates, ever more at a time
            partial, met = np.zeros(len(self.m), np.int64), 0
            while at < len(lists) and after[at] >= need and met < room:
                _, weight, number = lists[at]
                if met >= k and met + self.starts[self.ends[number + 1]] - self.starts[self.ends[number]] > room:
                    break
                at += 1
                blocks = np.arange(self.ends[number], self.ends[number + 1])
                blocks = blocks[weight * self.peak[blocks] + after[at] + (partial.max() if met else 0) >= need]
                if len(blocks):
                    self.open(blocks)
                    spots = self._postings(blocks)
                    partial[self.docs[spots]] += weight * self.impacts[spots].astype(np.int64)
                    met += len(spots)
            partial[seen] = 0
            docs = np.flatnonzero(partial)
            seen[docs] = True
            held, sums = self._finish(docs, partial[docs], lists[at:], int(after[at]), need)
            seats, scores = np.concatenate([seats, held]), np.concatenate([scores, sums])
            top = np.lexsort((seats, -scores))[:k]
            seats, scores = seats[top], scores[top]
            if len(top) == k:
                need = max(need, int(scores[-1]))
            room *= 4
        return seats, scores

    def _finish(self, docs: np.ndarray, sums: np.ndarray, lists: list[tuple[int, int, int]], bound: int, need: int):
        """Whole scores of the documents that reach `need`, given the lists in which they may occur besides."""
        ahead = np.full(len(docs), bound)
        alive = np.flatnonzero(sums + ahead >= need)
        docs, sums, ahead = docs[alive], sums[alive], ahead[alive]
        # block maxima take the place of the bounds of lists; nothing is decompressed
        for bound, weight, number in lists:
            if not len(docs):
                break
            ahead += self._peaks(docs, weight, number)[1] - bound
            alive = sums + ahead >= need
            if not alive.all():
                docs, sums, ahead = docs[alive], sums[alive], ahead[alive]
        for _, weight, number in lists:
            if not len(docs):
                break
            block, peak = self._peaks(docs, weight, number)
            ahead -= peak
            hit = np.flatnonzero(peak)
            if len(hit):
                self.open(np.unique(block[hit]))
                begin, end = self.starts[self.ends[number]], self.starts[self.ends[number + 1]]
                spot = np.minimum(begin + np.searchsorted(self.docs[begin:end], docs[hit]), end - 1)
                sums[hit] += np.where(self.docs[spot] == docs[hit], weight * self.impacts[spot].astype(np.int64), 0)
            alive = sums + ahead >= need
            if not alive.all():
                docs, sums, ahead = docs[alive], sums[alive], ahead[alive]
        return docs, sums

    def _peaks(self, docs: np.ndarray, weight: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The block of a list that may hold each document, and the block's bound; zero where it can't."""
        begin, end = self.ends[number], self.ends[number + 1]
        block = np.minimum(begin + np.searchsorted(self.last[begin:end], docs), end - 1)
        inside = (self.first[block] <= docs) & (docs <= self.last[block])
        return block, np.where(inside, weight * self.peak[block], 0)


def _packed_items(table: pa.Table) -> dict[str, np.ndarray]:
    keys = vectors.keys_of(table)
    rows = table.column("weights").to_pylist()
    return keys | {
        "term": np.frombuffer(b" ".join(w["term"].encode() for each in rows for w in each), np.uint8),
        "w": np.array([w["w"] for each in rows for w in each], np.int64), "ends": np.cumsum([0, *map(len, rows)]),
    }


def _searched(k: int, n_docs: int, n_terms: int):
    def work(number, block, items):
        shard, found = Shard(block, n_docs, n_terms), []
        terms, ends = items["term"].tobytes().split(b" "), items["ends"]
        for at in range(len(items["id"])):
            span = slice(ends[at], ends[at + 1])
            seats, scores = shard.best(list(zip(terms[span], items["w"][span].tolist())), k)
            found.append((np.full(len(seats), at), seats, scores))
        at, seats, scores = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in range(3))
        return pa.RecordBatch.from_arrays([
            pa.array(items["id"][at], pa.int64(), mask=items["none"][at]), pa.array(items["place_file"][at]), pa.array(items["place_row"][at]),
            pa.array(block["key"][seats], pa.int64(), mask=block["none"][seats]), pa.array(scores, pa.int64()),
        ], ["item", *PLACE, "key", "score"])

    return work


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item, rank, key and score: the k best documents of every item."""
    shards = index(docs, key, text, shard_postings)
    totals = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count("*").alias("shards")).first()
    n_docs, n_terms = totals["docs"] or 0, max(1, totals["terms"] or 0)
    words = F.array_distinct(F.filter(F.split(fold_ascii(item_text), BETWEEN_TERMS), lambda w: w != ""))
    asked = freeze(
        with_place(items).select(F.col(item).cast("long").alias("id"), *PLACE, F.explode(words).alias("term")), "item-terms"
    )
    df = shards.select(F.inline("terms")).join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(
        F.sum("df").alias("df")
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = asked.join(df, "term").groupBy("id", *PLACE).agg(
        F.collect_list(F.struct("term", weight.alias("w"))).alias("weights")
    )
    blocks = max(1, -(-weighted.count() // ITEMS_A_BLOCK))
    blocked = weighted.withColumn("block", F.pmod(F.xxhash64(*PLACE), F.lit(blocks)).cast("int"))
    packed = vectors.pack(blocked, "block", _packed_items, "items")
    many = max(1, totals["shards"])
    placed = with_place(shards.select("payload"))
    # numbered without gaps, so that every task gets about as many shards
    places = with_ordinal(placed.select(*PLACE), F.pmod(F.xxhash64(*PLACE), F.lit(KEY_BOUND).cast("long")), PLACE)
    numbers = freeze(places.withColumnRenamed("ordinal", "block"), "shard-numbers")
    numbered = placed.join(numbers, list(PLACE)).select(F.col("block").cast("int").alias("block"), "payload")
    found = vectors.meet(
        numbered, many, packed, _searched(k, n_docs, n_terms),
        f"item long, {PLACE[0]} long, {PLACE[1]} long, key long, score long",
    )
    order = W.partitionBy(*PLACE, "item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score"
    )
