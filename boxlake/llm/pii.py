"""Personal data by rules and by boosted trees over candidate spans.

The rules find e-mail addresses, IP addresses, card numbers and phone numbers; their spans always stay. The method adds
to them. High-recall generators propose spans of each kind that may overlap each other and the spans of the rules, such as
"name (at) mail dot com", "10[.]0[.]0[.]1" or any number of 9 to 15 digits, in groups or not, as a phone number. A candidate is described by its
format (length, digits, groups, separators) and its context (the words before and after it), never by the test a rule
makes, and trees boosted on all candidates of the corpus learn which of them look like what the rules find there.
Candidates that meet no span of the rules are counterexamples, and so are the digits of those that do, written as a
plain row of numbers or as one number without the words before it; other numbers, dates for example, are told apart as far
as the corpus shows them.
A score counts if it reaches the threshold of its kind: the lowest at which the calibration half of the corpus, with
scores mapped to probabilities, shows PRECISION or more; a kind without such a threshold adds nothing. Added spans that
overlap a span of the rules or a better added span go.

Fitting reads every document and draws no sample; a hash of its key puts a document into the half that grows the trees or
the one that calibrates. Equal candidates are counted once with their number, the quantiles at which features are cut are those of all of
them, and each level of a tree is one pass in which every task sums gradients by node, feature and bin; only these sums go
to the driver. Gradients are summed in units of 1 / UNIT, so the model does not depend on how rows are dealt out.
Candidates of all whole texts are judged. Positions are code points, the end is exclusive.

Defined results: null and empty texts have no spans; an empty table gives no rows; repeated rows get equal spans; very
long texts are scanned in one pass whose cost grows with their length; ties of added spans go to the earlier, then the
longer one, then to the kind listed first; other columns are never read.
"""

from __future__ import annotations

import re
from bisect import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze, map_arrow

KINDS = ("email", "ip", "card", "phone")
PRECISION, TREES, DEPTH, RATE, BINS, LEAST_EXAMPLES = 0.98, 60, 3, 0.1, 32, 20
UNIT, ROWS_A_TASK, BATCHES_AT_ONCE = 1 << 28, 200_000, 100

# ---------------------------------------------------------------- rules

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def emails(text: str):
    """Leftmost matches of a local part, @ and a dotted domain. A match starts where the run before its @ starts, so
    looking from each @ is the same and stays linear in long runs."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)]
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part_fits(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) by start, then kind; matches that fail their test are dropped without another try."""
    found = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_part_fits, m.group().split("."))):
            found.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# ---------------------------------------------------------------- candidates

# "at" and "dot" in brackets or between blanks stand for their signs
_AT = r"(?:@|[\x20]?[\[({][\x20]?at[\x20]?[\])}][\x20]?|[\x20]at[\x20])"
_DOT = r"(?:\.|[\x20]?[\[({][\x20]?(?:dot|\.)[\x20]?[\])}][\x20]?|[\x20]dot[\x20])"
_MAIL_SIGN = re.compile(rf"{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.I)
_NUMBERS = re.compile(r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20()./\[\]-]{0,3}[0-9])+(?![0-9A-Za-z])")
_WORD = re.compile(r"[^\W\d_]+")
#: Words that often stand before personal data.
CUES = ("mail", "email", "contact", "call", "phone", "tel", "mobile", "fax", "card", "visa", "ip", "host", "address", "at")
FEATURES = 18


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans of each kind with high recall; a span may be proposed for several kinds."""
    found, done = [], 0
    for m in _MAIL_SIGN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end(), 0))
        done = m.end()
    for m in _NUMBERS.finditer(text):
        piece, size = m.group(), len(_digits(m.group()))
        if size <= 12 and len(re.findall("[0-9]+", piece)) == 4 and "." in piece:
            found.append((*m.span(), 1))
        if 12 <= size <= 19:
            found.append((*m.span(), 2))
        if 9 <= size <= 15:
            found.append((*m.span(), 3))
    return found


def features(text: str, start: int, end: int) -> list[float]:
    piece, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 20]
    groups = [len(g) for g in re.findall("[0-9]+", piece)]
    cue = [w.lower() for w in _WORD.findall(before)][-3:]
    letters = sum(c.isalpha() for c in piece)
    parts = [int(g[-4:]) for g in re.findall("[0-9]+", piece)]
    return [
        len(piece), sum(groups), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        letters, piece.count("."), piece.count("-"), piece.count(" "), piece.count("(") + piece.count("["), piece.count("/"),
        max(parts, default=0), float(any(w in CUES for w in cue)), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before.count("\n") > 0), len(after) and float(after[0] in ".,;:!?"),
    ]


# ---------------------------------------------------------------- boosted trees


class Trees:
    """Gradient boosted regression trees on the logistic loss, split at quantiles.

    A tree is three arrays over its nodes: the feature (-1 in a leaf), the last bin that goes left, and the value of a leaf;
    node i has the children 2i + 1 and 2i + 2. Each tree sees a third of the features, drawn with a fixed seed, so that no
    single one decides.
    """

    def __init__(self, cuts: list[np.ndarray], mean: float):
        mean = min(max(mean, 1e-3), 1 - 1e-3)
        self.cuts, self.base, self.trees = cuts, float(np.log(mean / (1 - mean))), []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)

    def start(self) -> None:
        """Add a tree that is a single open node."""
        size = 2 ** (DEPTH + 1) - 1
        self.trees.append((np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)))

    def split(self, node: int, seen: np.ndarray, sums: np.ndarray) -> list[int]:
        """Split a node of the last tree, or give it its value as a leaf; the children that may be split further.

        `sums` holds gradients, weights and rows by feature of `seen` and bin.
        """
        feature, last, value = self.trees[-1]
        (g, h), rows = sums[0, :, :2].sum(0) / UNIT, sums[0, :, 2].sum()
        value[node] = RATE * g / (h + 1)
        best = (1e-6, None, None)
        if rows >= 20:
            for at_seen, j in enumerate(seen):
                left_g, left_h = (np.cumsum(sums[at_seen, :, k]) / UNIT for k in (0, 1))
                gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
                gain[(left_h < 1) | (h - left_h < 1)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], j, at, left_g[at], left_h[at])
        if best[1] is None:
            return []
        feature[node], last[node] = best[1], best[2]
        for child, gradient, weight in ((2 * node + 1, best[3], best[4]), (2 * node + 2, g - best[3], h - best[4])):
            value[child] = RATE * gradient / (weight + 1)
        return [child for child in (2 * node + 1, 2 * node + 2) if child < 2**DEPTH - 1]

    def node(self, tree, binned: np.ndarray) -> np.ndarray:
        """The node every row ends in."""
        at, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(DEPTH):
            feature = tree[0][at]
            at = np.where(feature < 0, at, 2 * at + 1 + (binned[rows, feature] > tree[1][at]))
        return at

    def score_bins(self, binned: np.ndarray, trees=None) -> np.ndarray:
        score = np.full(len(binned), self.base)
        for tree in self.trees if trees is None else trees:
            score += tree[2][self.node(tree, binned)]
        return score

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.score_bins(self.bins(x))

    def sums(self, seen: np.ndarray, nodes: list[int], binned: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What `split` needs for each of some open nodes of the last tree, from some of the rows."""
        p = 1 / (1 + np.exp(-self.score_bins(binned, self.trees[:-1])))
        parts = np.stack([np.rint((y - p) * UNIT).astype(np.int64) * n, np.rint(p * (1 - p) * UNIT).astype(np.int64) * n, n], 1)
        at, out = self.node(self.trees[-1], binned), np.zeros((len(nodes), len(seen), BINS, 3), np.int64)
        for i, node in enumerate(nodes):
            rows = np.flatnonzero(at == node)
            for k, j in enumerate(seen):
                np.add.at(out[i, k], binned[rows, j], parts[rows])
        return out


class Model:
    """Trees and threshold per kind; kinds with too few positive or negative examples add nothing."""

    def __init__(self, by_kind: dict[int, tuple[Trees, float]]):
        self.by_kind = by_kind

    def added(self, text: str, rules: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans beside those of the rules, none overlapping another."""
        # a candidate that overlaps a span of the rules can't be added
        free, at, until, later = [], 0, 0, sorted(rules)
        for start, end, kind in sorted(candidates(text)):
            while at < len(later) and later[at][0] < end:
                until = max(until, later[at][1])
                at += 1
            if kind in self.by_kind and start >= until:
                free.append((start, end, kind))
        scored = []
        for kind, (trees, threshold) in self.by_kind.items():
            own = [s for s in free if s[2] == kind]
            if own and threshold < float("inf"):
                scores = trees.score(np.array([features(text, a, b) for a, b, _ in own], float))
                scored += [(-v, s) for v, s in zip(scores.tolist(), own) if v >= threshold]
        taken: list[tuple[int, int, int]] = []
        for _, span in sorted(scored, key=lambda v: (v[0], v[1][0], -v[1][1], v[1][2])):
            at = bisect(taken, span)
            if (not at or taken[at - 1][1] <= span[0]) and (at == len(taken) or span[1] <= taken[at][0]):
                taken.insert(at, span)
        return taken


def _examples(text: str) -> tuple[list[int], list[bool], list[list[float]]]:
    rules = rule_spans(text)
    own = {k: [(a, b) for a, b, kind in rules if kind == k] for k in range(len(KINDS))}
    kinds, labels, rows = [], [], []
    for start, end, kind in candidates(text):
        kinds.append(kind)
        labels.append(any(a < end and start < b for a, b in own[kind]))
        rows.append(features(text, start, end))
        if labels[-1] and kind in (1, 3):
            before, groups = text[max(0, start - 40):start], re.findall("[0-9]+", text[start:end])
            # the same digits are counterexamples as a plain row of numbers, and as one number that no words introduce
            plain = [(before, " ".join(groups))] if len(groups) > 2 else []
            for head, piece in [*plain, ("", "".join(groups))]:
                kinds.append(kind)
                labels.append(False)
                rows.append(features(head + piece + text[end:end + 20], len(head), len(head) + len(piece)))
    return kinds, labels, rows


# ---------------------------------------------------------------- Spark


def _described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(half, kind, label, x, n): every different example of the corpus and how often it is there."""
    half = F.pmod(F.xxhash64(F.lit("half"), F.col(key).cast("string")), F.lit(2)).cast("int")
    rows = docs.where(F.col(text).isNotNull()).select(half.alias("half"), F.col(text).alias("text"))

    def describe(batches):
        for batch in batches:
            halves, kinds, labels, rows = [], [], [], []
            for half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k, y, x = _examples(text)
                halves += [half] * len(k)
                kinds += k
                labels += y
                rows += x
            values = pa.array(np.array(rows, np.int32).reshape(-1), pa.int32())
            ends = pa.array(np.arange(len(rows) + 1) * FEATURES, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves, pa.int32()), pa.array(kinds, pa.int32()), pa.array(labels, pa.bool_()),
                 pa.ListArray.from_arrays(ends, values)],
                names=["half", "kind", "label", "x"],
            )

    got = map_arrow(rows, describe, "half int, kind int, label boolean, x array<int>")
    return got.groupBy("half", "kind", "label", "x").agg(F.count("*").alias("n"))


def _chunks(batches):
    """(kind, label, bins, n) of a bounded number of batches at a time."""
    held = []
    for batch in batches:
        held.append(batch)
        if len(held) >= BATCHES_AT_ONCE:
            yield _arrays(held)
            held = []
    if held:
        yield _arrays(held)


def _arrays(batches):
    table = pa.Table.from_batches(batches)
    bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(-1, FEATURES)
    return table["kind"].to_numpy(), table["label"].to_numpy().astype(float), bins, table["n"].to_numpy()


def _binned(described: DataFrame, trees: dict[int, Trees], tasks: int) -> DataFrame:
    """(half, kind, label, bins, n): equal rows after binning counted as one, in few partitions, for they are read many times."""

    def work(batches):
        for batch in batches:
            kind, bins = batch.column(1).to_numpy(), np.zeros((batch.num_rows, FEATURES), np.uint8)
            x = batch.column(3).flatten().to_numpy().reshape(-1, FEATURES)
            for k in trees:
                bins[kind == k] = trees[k].bins(x[kind == k])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([row.tobytes() for row in bins], pa.binary()), batch.column(4)],
                names=["half", "kind", "label", "bins", "n"],
            )

    rows = map_arrow(described, work, "half int, kind int, label boolean, bins binary, n bigint")
    return rows.groupBy("half", "kind", "label", "bins").agg(F.sum("n").alias("n")).coalesce(tasks)


def _packed(rows: DataFrame) -> DataFrame:
    """The columns of `_chunks` as bytes, a row for each chunk: the passes unpack nothing and need no plan of their own."""

    def pack(batches):
        for chunk in _chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([column.tobytes()], pa.binary()) for column in chunk], names=["kind", "y", "bins", "n"]
            )

    return map_arrow(rows.select("kind", "label", "bins", "n"), pack, "kind binary, y binary, bins binary, n binary")


def _grow(rows: DataFrame, trees: dict[int, Trees]) -> None:
    """Boost the trees of all kinds side by side, one pass over the rows for each level."""
    packed = freeze(_packed(rows), "pii-packed").rdd
    draw = np.random.default_rng(0)
    for _ in range(TREES):
        seen = draw.choice(FEATURES, max(1, FEATURES // 3), replace=False)
        for own in trees.values():
            own.start()
        nodes = {k: [0] for k in trees}
        while nodes:

            def work(chunks, nodes=nodes, seen=seen):
                total = {}
                for chunk in chunks:
                    kind, y, n = (np.frombuffer(chunk[c], t) for c, t in (("kind", np.int32), ("y", float), ("n", np.int64)))
                    bins = np.frombuffer(chunk["bins"], np.uint8).reshape(-1, FEATURES)
                    for k in nodes:
                        own = np.flatnonzero(kind == k)
                        if len(own):
                            total[k] = total.get(k, 0) + trees[k].sums(seen, nodes[k], bins[own], y[own], n[own])
                yield from total.items()

            sums = {}
            for k, part in packed.mapPartitions(work).collect():
                sums[k] = sums.get(k, 0) + part
            below = {}
            for k, own in nodes.items():
                below[k] = [child for node, part in zip(own, sums[k]) for child in trees[k].split(node, seen, part)]
            nodes = {k: own for k, own in below.items() if own}


def _thresholds(rows: DataFrame, trees: dict[int, Trees]) -> dict[int, float]:
    """By kind, the lowest score from which on at least PRECISION of the candidates, ordered by score, are positive.

    The threshold lies midway between that score and the next lower one, and never where a candidate is less likely
    positive than not. Candidates are added up inside narrow ranges of scores, then over the ranges.
    """

    def work(batches):
        for kind, y, bins, n in _chunks(batches):
            score = np.zeros(len(n))
            for k in trees:
                score[kind == k] = trees[k].score_bins(bins[kind == k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(score), pa.array(y.astype(np.int64) * n), pa.array(n)],
                names=["kind", "score", "hits", "n"],
            )

    told = map_arrow(rows.select("kind", "label", "bins", "n"), work, "kind int, score double, hits bigint, n bigint")
    told = told.groupBy("kind", "score").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    told = freeze(told.withColumn("range", F.floor(F.col("score") * 8)), "pii-scores")
    higher = Window.partitionBy("kind").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = told.groupBy("kind", "range").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).select(
        "kind", "range", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_above") for c in ("hits", "n")]
    )
    inside = Window.partitionBy("kind", "range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    hits, n = (F.col(f"{c}_above") + F.sum(c).over(inside) for c in ("hits", "n"))
    ranked = told.join(ranges, ["kind", "range"]).select("kind", "score", hits.alias("hits"), n.alias("n"))
    good = (F.col("hits") / F.col("n") >= PRECISION) & (F.col("hits") >= 20)
    at = {r["kind"]: r["at"] for r in ranked.where(good).groupBy("kind").agg(F.min("score").alias("at")).collect()}
    if not at:
        return {}
    least = F.element_at(F.create_map(*[F.lit(v) for pair in at.items() for v in pair]), F.col("kind"))
    below = told.where(F.col("score") < least).groupBy("kind").agg(F.max("score").alias("below")).collect()
    below = {r["kind"]: r["below"] for r in below}
    return {k: max(0.0, (v + below.get(k, v)) / 2) for k, v in at.items()}


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """The model of all candidates of docs, or None if there are none."""
    described = freeze(_described(docs, key, text), "pii-candidates")
    cells = described.groupBy("kind", "half", "label").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    if not cells:
        return None
    size = {(c["kind"], c["half"], c["label"]): c["n"] for c in cells}
    kinds = [k for k in range(len(KINDS)) if all(size.get((k, h, y), 0) >= LEAST_EXAMPLES for h in (0, 1) for y in (False, True))]
    if not kinds:
        return Model({})
    described = described.where(F.col("kind").isin(kinds))
    shares = F.array(*[F.lit(float(v)) for v in np.linspace(0, 1, BINS + 1)[1:-1]])
    cuts = described.where("half = 0").groupBy("kind").agg(
        *[F.percentile(F.col("x")[j], shares, F.col("n")).alias(f"x{j}") for j in range(FEATURES)]
    )
    trees = {
        r["kind"]: Trees([np.unique(r[f"x{j}"]) for j in range(FEATURES)], size[r["kind"], 0, True] / (size[r["kind"], 0, True] + size[r["kind"], 0, False]))
        for r in cuts.collect()
    }
    tasks = 1 + sum(c["rows"] for c in cells) // ROWS_A_TASK
    binned = freeze(_binned(described, trees, tasks), "pii-bins")
    _grow(binned.where("half = 0"), trees)
    threshold = _thresholds(binned.where("half = 1"), trees)
    return Model({k: (trees[k], threshold.get(k, float("inf"))) for k in kinds})


def find(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, `base` and `spans` of every row: arrays of (kind, begin, stop) by begin, then kind as listed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    span = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("stop", pa.int64())])

    def told(spans):
        return [{"kind": KINDS[k], "begin": a, "stop": b} for a, b, k in spans]

    def scan(batches):
        model = shared.value
        for batch in batches:
            base, spans = [], []
            for text in batch.column(1).to_pylist():
                rules = rule_spans(text or "")
                more = model.added(text or "", rules) if model is not None else []
                base.append(told(rules))
                spans.append(told(sorted(rules + more, key=lambda s: (s[0], s[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(span)), pa.array(spans, pa.list_(span))],
                names=["key", "base", "spans"],
            )

    kind = "array<struct<kind:string,begin:bigint,stop:bigint>>"
    out = map_arrow(rows, scan, f"key {rows.schema['key'].dataType.simpleString()}, base {kind}, spans {kind}")
    return out.withColumnRenamed("key", key)


def redact(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with every span of its text replaced by [KIND]; overlapping spans are replaced as one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def cut(value: str) -> str:
        model, out, done = shared.value, [], 0
        rules = rule_spans(value)
        for a, b, k in sorted(rules + (model.added(value, rules) if model is not None else [])):
            if a >= done:
                out += [value[done:a], f"[{KINDS[k].upper()}]"]
            done = max(done, b)
        return "".join(out) + value[done:]

    def run(batches):
        for batch in batches:
            new = pa.array([None if t is None else cut(t) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], new, *batch.columns[at + 1:]], batch.schema.names)

    return map_arrow(docs, run, docs.schema)
