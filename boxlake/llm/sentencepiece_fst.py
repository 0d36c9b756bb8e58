"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a model file. The normaliser puts one space mark before a text that is not empty and
turns spaces into marks (models whose normaliser does more are refused). The piece transducer is a deterministic automaton over the pieces;
a character without a piece takes the byte-fallback arc and gives the pieces of its UTF-8 bytes. The third accepts
sequences of pieces: in a unigram model an arc weighs the negative log probability of its piece; in a BPE model an arc
from piece a to piece b weighs nothing if merging the characters of ab ends in a, b, and infinitely much otherwise. A
sequence is the BPE encoding of its text exactly if all its neighbours pass that test, so the path of least weight is
the encoding the model defines.

Encoding composes them with the input lazily and takes the shortest path in the tropical semiring (min, +), position by
position. For BPE one piece ends the shortest path at each position. No piece has a mark after another character, so a
mark that follows another character is a state all paths pass, and the text is cut there; parts that were seen lately
keep their path in a cache of bounded size. That cut and cache change no result.

Decoding concatenates the bytes of the pieces, turns marks into spaces, drops the leading space and reads UTF-8;
bytes that are not UTF-8 become U+FFFD. The round trip is exact but for a literal U+2581, which the format reads as a
space.

Defined results: null text gives null ids, null ids give null text; an empty text has no ids; very long texts and
parts without spaces are encoded whole; repeated rows get equal ids; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHE_PARTS, CACHE_CHARS, CACHE_PAIRS, ROWS_AT_ONCE = 250_000, 48, 300_000, 128
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_IDS = T.ArrayType(T.IntegerType())


# ---------------------------------------------------------------- model file


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, data[at:at + size]
        at += size


def read_model(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


class Model:
    """Pieces, weights and normaliser settings of a model file."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        self.bpe, self.prefix, squeeze, rules = False, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                spec = dict(_fields(value))
                rules, self.prefix, squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if rules or squeeze:
            raise ValueError("only models with the identity normaliser are compiled")
        if any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds) if k == _NORMAL):
            raise ValueError("a piece has a space mark after another character")


# ---------------------------------------------------------------- transducers


class Transducer:
    def __init__(self, model: Model):
        self.model = model
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (_NORMAL, _USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == _BYTE}
        self.unknown = next(i for i, k in enumerate(model.kinds) if k == _UNKNOWN)
        self.begin, self.spare = len(model.pieces), len(model.pieces) + 1
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matcher.add_word(piece, (i, len(piece)))
        self.matcher.make_automaton()
        self.output = [
            bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k in (_CONTROL, _UNKNOWN) else p.replace(MARK, " ").encode()
            for p, k in zip(model.pieces, model.kinds)
        ]
        self.pairs: dict[int, bool] = {}
        self.packed = [int(i).to_bytes(4, "little") for i in range(len(model.pieces))]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # -- acceptor of piece sequences

    def merged(self, chars: str) -> list[str]:
        """The characters after merging: best score first, leftmost first."""
        parts, scores, ids = list(chars), self.model.scores, self.ids
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                piece = ids.get(parts[i] + parts[i + 1])
                if piece is not None and scores[piece] > best:
                    best, at = scores[piece], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, before: int, piece: int) -> bool:
        """Whether the arc between two pieces weighs nothing; the start and a character without piece never merge."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        text = self.model.pieces[piece]
        ahead = [self.model.pieces[before]] if before < self.begin else []
        found = self.merged("".join(ahead) + text) == [*ahead, text]
        self.pairs[before * (self.spare + 1) + piece] = found
        return found

    def fallback(self, char: str) -> bytes:
        found = [self.bytes.get(b) for b in char.encode("utf-8", "surrogatepass")]
        return b"".join([self.packed[i] for i in ([self.unknown] if None in found else found)])

    # -- composition and shortest path

    def shortest_path(self, part: str) -> bytes:
        """The ids of the path of least weight as little-endian int32."""
        return self._bpe_path(part) if self.model.bpe else self._unigram_path(part)

    def _bpe_path(self, part: str) -> bytes:
        """The matcher gives the arcs by the position they end at, long ones first.

        All finite paths weigh nothing, and the pieces of one that reaches a position are the encoding of that prefix:
        a position has one state, and is done when its first finite arc is found. A position without arcs ends a
        character that has no piece.
        """
        states, begins = [self.begin] + [self.spare] * len(part), list(range(-1, len(part)))
        done, width, pairs = 0, self.spare + 1, self.pairs
        for end, (piece, size) in self.matcher.iter(part):
            if end < done:
                continue
            before = states[end + 1 - size]
            good = pairs.get(before * width + piece)
            if good is None:
                good = self.follows(before, piece)
            if good:
                done = end + 1
                states[done], begins[done] = piece, done - size
        return self._trace(part, states, begins)

    def _unigram_path(self, part: str) -> bytes:
        """Characters without piece weigh 10 more than the heaviest piece."""
        scores = self.model.scores
        if not hasattr(self, "heaviest"):
            self.heaviest = 10.0 - min(scores[i] for i in self.ids.values())
        states, begins = [self.begin] + [self.spare] * len(part), list(range(-1, len(part)))
        weight = [0.0] + [math.inf] * len(part)
        done = 0

        def spare_arcs(until):
            for at in range(done + 1, until + 1):
                weight[at] = min(weight[at], weight[at - 1] + self.heaviest)

        for end, (piece, size) in self.matcher.iter(part):
            spare_arcs(end)
            done = end
            total = weight[end + 1 - size] - scores[piece]
            if total < weight[end + 1]:
                weight[end + 1], states[end + 1], begins[end + 1] = total, piece, end + 1 - size
        return self._trace(part, states, begins)

    def _trace(self, part: str, states: list[int], begins: list[int]) -> bytes:
        end, pieces = len(part), []
        while end:
            start, piece = begins[end], states[end]
            pieces.append(self.packed[piece] if piece < self.begin else self.fallback(part[start:end]))
            end = start
        pieces.reverse()
        return b"".join(pieces)

    def path_bytes(self, part: str) -> bytes:
        """The ids of a part as little-endian int32, by way of the cache."""
        found = self.young.get(part)
        if found is None:
            found = self.old.get(part)
            if found is None:
                found = self.shortest_path(part)
            if len(part) <= CACHE_CHARS:
                if len(self.young) >= CACHE_PARTS:
                    self.old, self.young = self.young, {}
                self.young[part] = found
        return found

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        marked = (MARK if self.model.prefix else "") + text.replace(" ", MARK)
        get, path = self.young.get, self.path_bytes
        if MARK + MARK in marked or not self.model.prefix:
            parts = re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)
        else:
            parts = [MARK + w for w in marked[1:].split(MARK)]
        return b"".join([get(p) or path(p) for p in parts])

    def decode(self, ids) -> str:
        data = b"".join(map(self.output.__getitem__, ids))
        if self.model.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


_compiled: dict[int, Transducer] = {}


def _transducer(broadcast) -> Transducer:
    """Compiled once per worker process and model."""
    data = broadcast.value
    if hash(data) not in _compiled:
        _compiled.clear()
        _compiled[hash(data)] = Transducer(Model(data))
    return _compiled[hash(data)]


# ---------------------------------------------------------------- Spark


def _model_path(model: str | None) -> str:
    return model or f"{TOKENIZERS}/{MODEL}"


def _by_batches(rows: DataFrame, schema: T.StructType, spark_model, convert) -> DataFrame:
    """The columns that `convert` makes of a transducer and a batch of a few rows."""

    def run(batches):
        transducer = _transducer(spark_model)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield pa.RecordBatch.from_arrays(convert(transducer, batch.slice(start, ROWS_AT_ONCE)), schema.names)

    return map_arrow(rows, run, schema)


def _shared_model(spark: SparkSession, model: str | None):
    return spark.sparkContext.broadcast(read_model(spark, _model_path(model)))


def _encode_column(transducer: Transducer, texts: pa.Array) -> pa.Array:
    coded = [None if t is None else transducer.encode(t) for t in texts.to_pylist()]
    ends = np.cumsum([0] + [len(c or b"") // 4 for c in coded], dtype=np.int64)
    values = pa.array(np.frombuffer(b"".join(c or b"" for c in coded), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), values, mask=pa.array([c is None for c in coded], pa.bool_())
    )


def _decode_column(transducer: Transducer, ids: pa.Array) -> pa.Array:
    return pa.array([None if i is None else transducer.decode(i) for i in ids.to_pylist()], pa.string())


def encode(rows: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None) -> DataFrame:
    """rows plus the piece ids of a text column."""
    schema = T.StructType([*rows.schema.fields, T.StructField(ids, _IDS)])
    at = rows.columns.index(text)
    return _by_batches(
        rows, schema, _shared_model(rows.sparkSession, model),
        lambda transducer, some: [*some.columns, _encode_column(transducer, some.column(at))],
    )


def decode(rows: DataFrame, ids: str = "ids", text: str = "decoded", model: str | None = None) -> DataFrame:
    """rows plus the text of a column of piece ids."""
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])
    at = rows.columns.index(ids)
    return _by_batches(
        rows, schema, _shared_model(rows.sparkSession, model),
        lambda transducer, some: [*some.columns, _decode_column(transducer, some.column(at))],
    )


def encode_and_decode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """key, ids, n_ids and decoded text of every row.

    Ids are decoded in the Python worker that made them: a second pass would hold another worker, with pieces of its own,
    for every running task.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("ids", _IDS), T.StructField("decoded", T.StringType())])

    def both(transducer, some):
        ids = _encode_column(transducer, some.column(1))
        return [some.column(0), ids, _decode_column(transducer, ids)]

    return _by_batches(rows, schema, _shared_model(docs.sparkSession, model), both).select(
        F.col("key").alias(key), "ids", F.size("ids").alias("n_ids"), "decoded"
    )
