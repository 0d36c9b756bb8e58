"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to ORDER bytes with the counts of the byte that follows. A byte costs
-log2(c / (n + d)) bits in a context that has seen it c times among n bytes of d kinds; else it pays the escape
-log2(d / (n + d)) and is coded in the context one byte shorter, down to eight bits for any byte (escape method C, no
exclusions). Counts are frozen after fitting, so the cost of a byte is a fixed function of its context: the trees of
all languages are merged into one, in which every byte that some language has seen in a context has a row of costs, and
whole texts are scored by walking it for all positions at once; a byte without a row pays the escapes on its way down. The language with the fewest bits wins; the score is its share under equal priors. Bytes A-Z count as a-z.

Counts come from a sample of labelled rows: about SAMPLE_DOCS whole documents of each language, drawn by a hash of
their key. The bound is a parameter; all contexts of the sample enter the tree, none is dropped, so the collected counts and
the model that is sent to the workers grow with the sample and not with the corpus.

Defined results: null text and text without a letter give `und`, score 0 and no bits; so does everything if there is no
labelled row; ties go to the language that sorts first; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

ORDER, SAMPLE_DOCS = 3, 2000
UNKNOWN = "und"
_CHUNK, ROWS_AT_ONCE = 1 << 18, 512
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def labelled_sample(docs: DataFrame, key: str, text: str, lang: str, sample_docs: int) -> DataFrame:
    """(lang, text) of about `sample_docs` rows of each language; a row is drawn by the hash of its key.

    One count per language goes to the driver.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = rows.groupBy(F.col(lang).alias("lang")).count().collect()
    if not sizes:
        return rows.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
    rate = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], sample_docs / row["count"])])
    draw = F.pmod(F.xxhash64(F.lit("ppm"), F.col(key).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(draw < F.element_at(rate, F.col(lang))).select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")
    )


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, size, gram, n): counts of all byte strings of 1 to order + 1 bytes, packed in a long, summed before the shuffle."""

    def count(batches):
        for batch in batches:
            texts = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(b" " * order + text)
            for lang, parts in texts.items():
                data = _FOLD[np.frombuffer(b"".join(parts), np.uint8)].astype(np.int64)
                for size in range(1, order + 2):
                    if len(data) < size:
                        continue
                    packed = np.zeros(len(data) - size + 1, np.int64)
                    for i in range(size):
                        packed = packed << 8 | data[i:len(data) - size + 1 + i]
                    grams, n = np.unique(packed, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array([size] * len(grams), pa.int32()),
                         pa.array(grams), pa.array(n.astype(np.int64))],
                        names=["lang", "size", "gram", "n"],
                    )

    return (
        map_arrow(sample, count, "lang string, size int, gram bigint, n bigint")
        .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    )


class Model:
    """Merged context tree: `step` walks it by the bytes before a position, `row` finds the costs of the next byte.

    `cost` holds a row per (context, byte) of the sample with the bits in every language, `escape` the bits for leaving a
    context, `shorter` the context without its first byte. Dense are only `step` and `row`, four bytes each per context and
    byte value, whatever the number of languages.
    """

    def __init__(self, counts, order: int = ORDER):
        self.order = order
        self.langs = sorted(set(counts["lang"]))
        kinds = len(self.langs)
        lang = counts["lang"].map({name: i for i, name in enumerate(self.langs)}).to_numpy()
        size, gram, n = (counts[c].to_numpy().astype(np.int64) for c in ("size", "gram", "n"))
        seen = np.unique(gram[size == 1])
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.symbol[65:91] = self.symbol[97:123]
        self.width = width = len(seen) + 1
        self.chunk = max(4096, 4 * _CHUNK // max(4, kinds))

        # contexts by length, then value; that of every gram without its first byte is among them
        names, node = np.unique((size - 1) << 56 | gram >> 8, return_inverse=True)
        length, context = names >> 56, names & ((1 << 56) - 1)
        nodes = self.nodes = len(names)
        tail = context & ((1 << 8 * np.maximum(length - 1, 0)) - 1)
        self.shorter = np.where(length > 0, np.searchsorted(names, (np.maximum(length, 1) - 1) << 56 | tail), -1)
        step = np.tile(np.arange(nodes, 2 * nodes, dtype=np.int32)[:, None], (2, width))
        deep = np.flatnonzero(length > 0)
        step[self.shorter[deep], self.symbol[context[deep] >> 8 * (length[deep] - 1)]] = deep
        self.step = step.reshape(-1)

        cells, at = np.unique(node * width + self.symbol[gram & 255], return_inverse=True)
        self.row = np.full(nodes * width, -1, np.int32)
        self.row[cells] = np.arange(len(cells))
        count = np.zeros((len(cells), kinds))
        np.add.at(count, (at, lang), n)
        held = cells // width
        total, distinct = np.zeros((nodes, kinds)), np.zeros((nodes, kinds))
        np.add.at(total, held, count)
        np.add.at(distinct, held, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2(total + distinct) - np.log2(distinct), 0.0)
            own = np.log2(total + distinct)[held] - np.log2(count)
        cost = np.empty((len(cells), kinds))
        for level in range(order + 1):
            some = np.flatnonzero(length[held] == level)
            lower = 8.0
            if level:
                lower = cost[self.row[self.shorter[held[some]] * width + cells[some] % width]]
            cost[some] = np.where(count[some] > 0, own[some], escape[held[some]] + lower)
        self.cost, self.escape = cost.astype(np.float32), escape.astype(np.float32)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of every text in every language."""
        total, some, size = np.zeros((len(texts), len(self.langs))), [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), self.chunk):
                before = (b" " * self.order + text[max(0, at - self.order):at])[-self.order:]
                some.append((i, before + text[at:at + self.chunk]))
                size += len(some[-1][1])
                if size >= self.chunk:
                    self._add(total, some)
                    some, size = [], 0
        self._add(total, some)
        return total

    def _add(self, total: np.ndarray, parts: list[tuple[int, bytes]]) -> None:
        if not parts:
            return
        symbols = self.symbol[np.frombuffer(b"".join(p for _, p in parts), np.uint8)]
        here = symbols[self.order:]
        state = np.zeros(len(here), np.int64)
        for back in range(1, self.order + 1):
            state = self.step[state * self.width + symbols[self.order - back:len(symbols) - back]].astype(np.int64)
        state %= self.nodes
        row = self.row[state * self.width + here]
        cost = self.cost[row]
        left = np.flatnonzero(row < 0)
        cost[left] = 0
        state = state[left]
        while len(left):
            cost[left] += self.escape[state]
            state = self.shorter[state]
            cost[left[state < 0]] += 8
            left, state = left[state >= 0], state[state >= 0]
            row = self.row[state * self.width + here[left]]
            found = row >= 0
            cost[left[found]] += self.cost[row[found]]
            left, state = left[~found], state[~found]
        ends = np.cumsum([len(p) for _, p in parts])
        starts = np.concatenate([[0], ends[:-1]])
        # positions that belong to the space before the next text carry no cost
        running = np.concatenate([np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0, dtype=np.float64)])
        sums = running[ends - self.order] - running[starts]
        np.add.at(total, [i for i, _ in parts], sums)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
        sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model of the labelled rows of docs, or None if there are none."""
    counts = gram_counts(labelled_sample(docs, key, text, lang, sample_docs), order).toPandas()
    return Model(counts, order) if len(counts) else None


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model | None, text: str = "text", prefix: str = "lang_") -> DataFrame:
    """docs plus {prefix}pred, {prefix}score and {prefix}bits, the mean bits of a byte in that language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    n, names = len(docs.columns), [f"{prefix}{c}" for c in ("pred", "score", "bits")]
    at = docs.columns.index(text)
    rows = docs.select("*", has_letter(text).alias(f"{prefix}letter"))

    def score(batches):
        model = shared.value
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            texts = [t.encode() if letter else None for t, letter in zip(batch.column(at).to_pylist(), batch.column(n).to_pylist())]
            known = [i for i, t in enumerate(texts) if t and model is not None]
            pred, share, rate = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            bits = model.bits([texts[i] for i in known]) if known else []
            for i, each in zip(known, bits):
                best = int(each.argmin())
                pred[i], rate[i] = model.langs[best], float(each[best]) / len(texts[i])
                share[i] = 1.0 / float(np.exp2(np.clip(each[best] - each, -1000, 0)).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(pred, pa.string()), pa.array(share, pa.float64()), pa.array(rate, pa.float64())],
                [*batch.schema.names[:n], *names],
            )

    fields = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"{names[0]} string, {names[1]} double, {names[2]} double"])
    return map_arrow(rows, score, fields)


def keep_known_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                         max_bits: float = 8.0) -> DataFrame:
    """Rows in a language that was learned from the labels of docs.

    A row goes if it has no letter, or if its best language needs `max_bits` a byte or more, that is, if its bytes are
    no better predicted by any language than by none. Without a labelled row nothing can be told and all rows stay.
    """
    model = fit(docs, key, text, lang)
    if model is None:
        return docs
    told = identify(docs, model, text, "__lang_")
    return told.where((F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_bits") < max_bits)).select(*docs.columns)
