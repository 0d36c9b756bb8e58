"""Token counts that follow edits.

A document is cut into leaves of about LEAF_CHARS characters. A leaf starts at a space or line break that follows a
letter or digit: there the pre-tokeniser always starts a new pre-token, and its look-ahead for white space never
reaches across, so the counts of leaves add up to the count of the text. The counts are kept in a segment tree: an
array in which node i is the sum of nodes 2i and 2i + 1, and node 1 the count of the document.

An edit replaces the code points from start to stop. Only the leaves it touches are encoded again, and a neighbour
joins them while the border between the two is no longer such a place (the boundary context). The new text goes into
the same leaf slots, so a changed leaf updates the sums on its way to the root alone. Text that has grown beyond its slots
is split into new leaves of at least LEAF_CHARS, and the tree is summed anew from the counts of all leaves; nothing else is
encoded again. However many edits meet at one place, a leaf stays below twice LEAF_CHARS plus the way to the next cut.

Edits refer to the text before any of them. Defined results: edits with a null field or start > stop are rejected, ends beyond
the text are clipped; of edits that overlap the one that starts first stays (ties: the shorter, then by text), the
others are rejected; insertions at one place apply in that order; null text counts as empty and has one empty leaf;
texts without a place to cut are one leaf; repeated rows and edits are judged each for itself; an empty table gives no rows;
columns that clash with the ones added are refused by Spark's schema, others stay.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

TOKENIZERS, RANKS = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
LEAF_CHARS = 512
#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=[^\W_])(?=[ \n])")
EDITS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("text", T.StringType()),
]))

_encodings: dict[int, tiktoken.Encoding] = {}


def read_ranks(spark: SparkSession, path: str | None = None) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path or f"{TOKENIZERS}/{RANKS}").select("content").first()[0])


def encoding(data: bytes) -> tiktoken.Encoding:
    """Built once per worker process and vocabulary."""
    if hash(data) not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        _encodings.clear()
        _encodings[hash(data)] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[hash(data)]


# ---------------------------------------------------------------- one document


def cut_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
    """Lengths of the leaves, at least one."""
    ends, at = [0], 0
    while True:
        found = _CUT.search(text, at + leaf_chars)
        if not found:
            break
        at = found.start()
        ends.append(at)
    return [b - a for a, b in zip(ends, [*ends[1:], len(text)])]


def build_tree(counts: list[int]) -> np.ndarray:
    slots = 1 << (len(counts) - 1).bit_length()
    tree = np.zeros(2 * slots, np.int64)
    tree[slots:slots + len(counts)] = counts
    level = slots
    while level > 1:
        tree[level // 2:level] = tree[level:2 * level:2] + tree[level + 1:2 * level:2]
        level //= 2
    return tree


def accepted(edits, size: int) -> tuple[list[tuple[int, int, str]], int]:
    """Edits that apply, by start, and the number of the others."""
    valid = sorted(
        (min(e["start"], size), min(e["stop"], size), e["text"]) for e in edits
        if e is not None and None not in (e["start"], e["stop"], e["text"]) and 0 <= e["start"] <= e["stop"]
    )
    kept, done = [], 0
    for edit in valid:
        if edit[0] >= done:
            kept.append(edit)
            done = max(done, edit[1])
    return kept, len(edits) - len(kept)


def grown_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
    """Lengths of the leaves of edited text: as `cut_leaves`, but a short last leaf stays with the one before it."""
    sizes = cut_leaves(text, leaf_chars)
    if len(sizes) > 1 and sizes[-1] < leaf_chars:
        sizes[-2:] = [sizes[-2] + sizes[-1]]
    return sizes


def apply_edits(text: str, leaves: np.ndarray, tree: np.ndarray, edits: list[tuple[int, int, str]], count, leaf_chars: int = LEAF_CHARS):
    """(new text, leaves, tree, number of old leaves encoded again)."""
    leaves, tree = leaves.copy(), tree.copy()
    n = len(leaves)
    ends = np.cumsum(leaves)
    begins = ends - leaves
    touched = np.zeros(n, bool)

    def leaf_at(position: int) -> int:
        return min(int(np.searchsorted(ends, position, "right")), n - 1)

    placed = [(leaf_at(a), leaf_at(max(a, b - 1)), a, b, new) for a, b, new in edits]
    for first, last, *_ in placed:
        touched[first:last + 1] = True
    filled = np.flatnonzero(leaves)

    def edited(start: int, end: int, own) -> str:
        out, at = [], start
        for a, b, new in own:
            out += [text[at:a], new]
            at = b
        return "".join(out) + text[at:end]

    while True:
        edges = np.flatnonzero(np.diff(np.concatenate([[False], touched, [False]]).astype(np.int8)))
        regions, grown = [], False
        for first, last in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()):
            start, end = int(begins[first]), int(ends[last])
            new = edited(start, end, [(a, b, t) for f, _, a, b, t in placed if first <= f <= last])
            if start and new and new[0] not in " \n":
                touched[filled[filled < first][-1]:first] = True
                grown = True
            if end < len(text) and (new or start) and not (new or text[:start])[-1].isalnum():
                touched[last + 1:filled[filled > last][0] + 1] = True
                grown = True
            regions.append((first, last, start, end, new))
        if not grown:
            break
    out, at, slots, grown = [], 0, len(tree) // 2, {}
    for first, last, start, end, new in regions:
        sizes, counts, cursor = grown_leaves(new, leaf_chars), [], 0
        for size in sizes:
            counts.append(count(new[cursor:cursor + size]))
            cursor += size
        out += [text[at:start], new]
        at = end
        spare = last - first + 1 - len(sizes)
        if spare < 0:
            grown[first] = sizes, counts
            leaves[first:last + 1] = 0
            continue
        leaves[first:last + 1] = sizes + [0] * spare
        tree[slots + first:slots + last + 1] = counts + [0] * spare
        low, high = (slots + first) // 2, (slots + last) // 2
        while low:
            for node in range(low, high + 1):
                tree[node] = tree[2 * node] + tree[2 * node + 1]
            low, high = low // 2, high // 2
    if grown:
        sizes, counts = [], []
        for i in range(n):
            more, their = grown.get(i, ([leaves[i]], [tree[slots + i]]) if leaves[i] else ([], []))
            sizes += more
            counts += their
        leaves, tree = np.array(sizes, np.int64), build_tree(counts)
    return "".join(out) + text[at:], leaves, tree, int(touched.sum())


# ---------------------------------------------------------------- Spark


def _mapped(rows: DataFrame, added: list[T.StructField], data, work) -> DataFrame:
    """rows plus columns that `work` computes from a dict of each row, a few rows at a time."""
    fields = [*rows.schema.fields, *added]
    names = rows.columns
    arrow = [(f.name, _arrow(f.dataType)) for f in added]

    def run(batches):
        tool = encoding(data.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                got = [work(tool, row) for row in some.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, *[pa.array([g[i] for g in got], kind) for i, (_, kind) in enumerate(arrow)]],
                    [*names, *[name for name, _ in arrow]],
                )

    return map_arrow(rows, run, T.StructType(fields))


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {"long": pa.int64(), "string": pa.string()}[kind.typeName()]


_LONGS = T.ArrayType(T.LongType())


def count_tokens(rows: DataFrame, text: str = "text", ranks: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """rows plus n_tokens and the state to keep: leaf_chars and tree."""
    data = rows.sparkSession.sparkContext.broadcast(read_ranks(rows.sparkSession, ranks))

    def work(tool, row):
        value = row[text] or ""
        leaves, at, counts = cut_leaves(value, leaf_chars), 0, []
        for size in leaves:
            counts.append(len(tool.encode_ordinary(value[at:at + size])))
            at += size
        tree = build_tree(counts)
        return int(tree[1]), leaves, tree.tolist()

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("leaf_chars", _LONGS), T.StructField("tree", _LONGS)]
    return _mapped(rows, added, data, work)


def update_counts(rows: DataFrame, edits: str = "edits", text: str = "text", ranks: str | None = None,
                  leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Counted rows with a column of edits (type EDITS) plus the state after them.

    Adds new_text, new_tokens, new_leaf_chars, new_tree, n_applied, n_rejected and n_reencoded (leaves).
    """
    data = rows.sparkSession.sparkContext.broadcast(read_ranks(rows.sparkSession, ranks))

    def work(tool, row):
        value = row[text] or ""
        leaves, tree = np.array(row["leaf_chars"], np.int64), np.array(row["tree"], np.int64)
        kept, rejected = accepted(row[edits] or [], len(value))
        new, again = value, 0
        if kept:
            new, leaves, tree, again = apply_edits(value, leaves, tree, kept, lambda s: len(tool.encode_ordinary(s)), leaf_chars)
        return new, int(tree[1]), leaves.tolist(), tree.tolist(), len(kept), rejected, again

    long = T.LongType()
    added = [
        T.StructField("new_text", T.StringType()), T.StructField("new_tokens", long), T.StructField("new_leaf_chars", _LONGS),
        T.StructField("new_tree", _LONGS), T.StructField("n_applied", long), T.StructField("n_rejected", long),
        T.StructField("n_reencoded", long),
    ]
    return _mapped(rows, added, data, work)


def attach_edits(rows: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counted rows plus the column `edits` from a table of (key, start, stop, text); rows of one key share its edits.

    The edits of a document come together in its row, as its text does. Edits with a null field go before that.
    """
    listed = edits.where("start is not null and stop is not null and text is not null").groupBy(
        F.col(key).alias("edited_key")
    ).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "text")).alias("edits"))
    return rows.join(listed, F.col(key) == F.col("edited_key"), "left").drop("edited_key")


def drawn_edits(key: str = "doc_id", text: str = "text") -> Column:
    """Three edits drawn from a row itself: a deletion of up to 12, a copy of up to 40 and an insertion of 3 characters."""
    size = F.char_length(F.coalesce(F.col(text), F.lit("")))

    def place(salt: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), F.col(key).cast("string")), F.greatest(size, F.lit(1)).cast("long"))

    def edit(start: Column, length: int, new: Column) -> Column:
        return F.struct(start.alias("start"), (start + length).alias("stop"), F.coalesce(new, F.lit("")).alias("text"))

    return F.array(
        edit(place("delete"), 12, F.lit("")), edit(place("copy"), 0, F.substring(text, 1, 40)), edit(place("insert"), 0, F.lit("'s ")),
    ).cast(EDITS)
