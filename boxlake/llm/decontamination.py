"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

A text becomes a sequence of template words: numbers, names (capitalised words inside a sentence) and units turn into
typed placeholders, other words are lower-cased, punctuation goes. Windows of WINDOW template words of the benchmark
are joined by hash with those of the documents and compared word by word. Along one alignment of a document with an
item every placeholder value of the item must map to one value of the document and back; an alignment with a
contradiction does not count, so a question with other numbers or names is caught and one that merely has the same
shape is not. A document is contaminated by an item if one alignment has MIN_WINDOWS consistent windows (13 words), or
all windows of a shorter item.

The benchmark is a stated query set: its windows are broadcast in blocks of at most BLOCK_ROWS rows of 24 bytes, as
many blocks as needed, each against all documents; no window of a document is shuffled unless it has matched.

Defined results: null or empty texts have no window and match nothing; texts shorter than a window have one window, the
whole text, so an item of fewer than WINDOW words is found only in documents that consist of it; windows of an item
with fewer than MIN_LITERALS words outside placeholders are not used; repeated rows and items are judged each for
itself; empty tables give no rows; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLACE, freeze, with_place

WINDOW, MIN_WINDOWS, MIN_LITERALS, BLOCK_ROWS = 8, 6, 4, 500_000

#: Unit words that count as placeholders.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "ounce", "ounces", "pound", "pounds", "ton", "tons",
    "ml", "cl", "l", "litre", "litres", "liter", "liters", "gallon", "gallons",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "cent", "cents", "dollar", "dollars", "euro", "euros", "percent", "degree", "degrees",
)
NAME_MARK, NUMBER_MARK = chr(1), chr(2)
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
NAME_RULE = r"([\p{L}\p{N},;:] )(\p{Lu}\p{Ll})"
NUMBER_RULE = r"([0-9])[.,]([0-9])"
BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}\x01\x02]+"


def raw_words(text: Column) -> Column:
    """Words as written; a name starts with NAME_MARK."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), NAME_RULE, f"$1{NAME_MARK}$2")
    marked = F.regexp_replace(marked, NUMBER_RULE, f"$1{NUMBER_MARK}$2")
    return F.filter(F.split(marked, BETWEEN_WORDS), lambda w: w != "")


def template_words(raw: Column) -> Column:
    def template(word: Column) -> Column:
        low = F.lower(word)
        return (
            F.when((word >= "0") & (word < ":"), F.lit(NUM)).when(word < NUMBER_MARK, F.lit(NAME))
            .when(low.isin(*UNITS), F.lit(UNIT)).otherwise(low)
        )

    return F.transform(raw, template)


def _with_windows(rows: DataFrame, text: str, window: int) -> DataFrame:
    """rows plus `raw`, `words` and the hash of every window, none for rows without words.

    Explode the hashes with an outer explode: from an inner one Spark infers a filter on their number, which it would
    push down by computing all words anew for every window.
    """
    worded = rows.withColumn("raw", raw_words(F.col(text))).drop(text)
    worded = worded.withColumn("words", template_words(F.col("raw")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(window - 1), F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, window)))
    return worded.withColumn("hashes", F.when(F.size("words") > 0, hashes))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int, min_literals: int) -> DataFrame:
    """One row per usable window: row (of the item), item, at, hash, words, raw, n_windows of the item."""
    rows = benchmark.select(F.col(item).alias("item"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    spread = _with_windows(rows, "text", window).select(
        "row", "item", "raw", "words", F.posexplode_outer("hashes").alias("at", "hash")
    )
    cut = spread.select(
        "row", "item", "at", "hash",
        F.slice("words", F.col("at") + 1, window).alias("words"), F.slice("raw", F.col("at") + 1, window).alias("raw"),
    )
    literal = F.size(F.filter("words", lambda w: ~w.isin(NUM, NAME, UNIT)))
    usable = cut.where(F.col("hash").isNotNull() & (literal >= F.least(F.lit(min_literals), F.size("words"))))
    sizes = usable.groupBy("row").agg(F.count("*").alias("n_windows"))
    return freeze(usable.join(sizes, "row"), "benchmark-windows")


def matches(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", item: str = "item_id",
            item_text: str = "text", window: int = WINDOW, min_windows: int = MIN_WINDOWS,
            min_literals: int = MIN_LITERALS) -> DataFrame:
    """Contaminated rows: keys, item, n_windows of the item, matched windows of the best alignment, exact.

    `exact` tells that the placeholders have the values of the benchmark.
    """
    items = benchmark_windows(benchmark, item, item_text, window, min_literals)
    blocks = max(1, -(-items.count() // BLOCK_ROWS))
    names = [f"key{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(text).alias("text"))
    spread = _with_windows(rows, "text", window).select(
        *names, "raw", "words", F.posexplode_outer("hashes").alias("pos", "hash")
    )
    slim = items.select("row", "at", "hash")
    found = None
    for block in range(blocks):
        some = F.broadcast(slim.where(F.pmod(F.col("hash"), F.lit(blocks)) == block))
        hits = spread.join(some, "hash").select(
            *names, "row", "at", "pos",
            F.slice("words", F.col("pos") + 1, window).alias("doc_words"),
            F.slice("raw", F.col("pos") + 1, window).alias("doc_raw"),
        )
        found = hits if found is None else found.unionByName(hits)
    same = found.join(items, ["row", "at"]).where(F.col("words") == F.col("doc_words"))
    slots = F.filter(
        F.arrays_zip("words", "raw", "doc_raw"), lambda s: s["words"].isin(NUM, NAME, UNIT)
    )
    aligned = same.groupBy(*names, "row", "item", "n_windows", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.count("*").alias("matched"), F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots")
    )

    def values(side: str) -> Column:
        return F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["words"], s[side]))))

    consistent = aligned.where((values("raw") == F.size("slots")) & (values("doc_raw") == F.size("slots")))
    exact = F.forall("slots", lambda s: s["raw"] == s["doc_raw"])
    best = consistent.groupBy(*names, "row", "item", "n_windows").agg(
        F.max(F.struct("matched", exact.alias("exact"))).alias("best")
    )
    return best.where(F.col("best.matched") >= F.least("n_windows", F.lit(min_windows))).select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)], F.col("item").alias(item),
        "n_windows", "best.matched", "best.exact",
    )


def matches_of_rows(docs: DataFrame, benchmark: DataFrame, key: str, text: str = "text") -> DataFrame:
    """As matches, each row judged for itself: rows that share a key, or have none, are never added up."""
    return matches(with_place(docs), benchmark, [key, *PLACE], text).drop(*PLACE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that no benchmark item is found in, with their columns.

    The places of the others are written first, so that Spark knows their size when it plans the join with whole texts.
    """
    placed = with_place(docs)
    bad = freeze(matches(placed, benchmark, list(PLACE), text).select(*PLACE).distinct(), "contaminated")
    return placed.join(bad, list(PLACE), "left_anti").drop(*PLACE)
