"""Hard-negative mining, exact top-k and lexical search against brute force and against SQL, on rows with nulls, ties and repeats."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.llm import exact_top_k, hard_negative_mining, lexical_search, queries, vectors

VECTORS = "vec_id long, embedding array<float>, label int, id string, x int, block string, score string, rank int"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vector_rows():
    draw = random.Random(5)
    base = [[draw.gauss(0, 0.3) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(400):
        vector = [x + draw.choice([0, 0, draw.gauss(0, 0.05)]) for x in base[i % 8]]
        rows.append((i, vector, i % 3 if i % 11 else None))
    rows += [(10, rows[10][1], 1), (100, rows[100][1], 2), (100, rows[100][1], 2), (None, base[0], 1), (None, base[1], 0)]
    rows += [(500, None, 1), (600, [0.1, None, 0.2], 1), (700, [float("nan")] * 6, 1), (800, [math.inf] + [0.0] * 5, 1)]
    rows += [(900, [], 0), (1000, [0.5, -0.25], 1), (1050, [0.0] * 6, 2), (1100, [9e4, -9e4, 3.0, 1.0, 0.0, 7e4], 0), (7, base[3], 9), (14, base[3], 9)]
    return [(*r, "a", 1, "b", "s", 4) for r in rows]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors") / "embeddings.parquet")
    spark.createDataFrame(vector_rows(), VECTORS).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def usable(rows, labelled):
    out = []
    for r in rows:
        if r.embedding is None or any(v is None or not math.isfinite(v) for v in r.embedding) or (labelled and r.label is None):
            continue
        out.append((r.vec_id, r.label, [math.floor(256 * float(v)) for v in r.embedding]))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def by_score(scored):
    return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))


@pytest.mark.parametrize("components", [vectors.COMPONENTS, 200])
def test_top_k_is_that_of_all_pairs(stored, components):
    rows = usable(stored.collect(), False)
    want = []
    for n, (i, _, x) in enumerate(rows):
        if i is not None and i % 50 == 0:
            others = by_score((dot(x, y), j) for m, (j, _, y) in enumerate(rows) if m != n)
            want += [(i, k + 1, j, s) for k, (s, j) in enumerate(others[:5])]
    got = exact_top_k.search(stored, F.col("vec_id") % 50 == 0, components=components)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert exact_top_k.search(stored.limit(0), F.lit(True)).count() == 0


def test_postings_leave_zeros_out_of_short_lists():
    import pyarrow as pa

    x = [[0, 5, 0], [0, 0, 0], [3, -2, 0], [0, 4]]
    table = pa.table({"id": pa.array([4, 3, None, 1]), "x": pa.chunked_array([x], pa.list_(pa.int64())), "__place_file": [0] * 4, "__place_row": list(range(4))})
    block = exact_top_k.postings(table)
    assert block["weights"].tolist() == [3, 4, 0, 5, -2] and block["places"].tolist() == [3] and block["ends"].tolist() == [0, 1, 5, 5]
    assert exact_top_k.accumulate(block, np.array([2, 1, 7])).tolist() == [4, 0, 5, 4]


def slow_negatives(rows):
    want = []
    for n, (i, label, x) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(dot(x, y), j, other == label) for m, (j, other, y) in enumerate(rows) if m != n]
        for p_score, p, _ in by_score(s for s in scored if s[2])[:5]:
            fit = by_score(s for s in scored if not s[2] and 30 * p_score <= 100 * s[0] <= 90 * p_score)
            want += [(i, p, k + 1, j, p_score, s) for k, (s, j, _) in enumerate(fit[:10])]
    return want


@pytest.mark.parametrize("components", [vectors.COMPONENTS, 200])
def test_negatives_are_those_of_all_pairs(stored, components):
    got = hard_negative_mining.mine(stored, F.col("vec_id") % 100 == 0, F.col("label"), components=components)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = slow_negatives(usable(stored.collect(), True))
    assert want and collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert hard_negative_mining.mine(stored.limit(0), F.lit(True), F.col("label")).count() == 0


def clustered_forest(n, leaf):
    import pyarrow as pa

    draw = np.random.default_rng(2)
    centres = draw.normal(0, 100, (12, 8))
    x = np.floor(centres[np.arange(n) % 12] + draw.normal(0, 2, (n, 8))).astype(np.int64)
    table = pa.table({
        "id": pa.array(np.arange(n)), "x": pa.chunked_array([x.tolist()], pa.list_(pa.int64())), "label": [str(i % 2) for i in range(n)],
        "__place_file": np.zeros(n, np.int64), "__place_row": np.arange(n),
    })
    return x, hard_negative_mining.cover_forest(table, leaf)


def test_cover_tree_covers_separates_and_skips(monkeypatch):
    x, stored = clustered_forest(3000, 8)
    forest = hard_negative_mining.Forest(stored)
    lift = np.sqrt(stored["longest"][0] - (forest.cells ** 2).sum(axis=1))
    points = np.concatenate([forest.cells, lift[:, None]], axis=1)
    below = {}

    def under(node):
        first, last, begin, end = forest.spans[node]
        below[node] = np.arange(begin, end) if end > begin else np.concatenate([under(k) for k in range(first, last)])
        return below[node]

    for root in range(len(stored["roots"])):
        under(root)
    assert sorted(np.concatenate([below[r] for r in range(len(stored["roots"]))])) == list(range(len(x)))
    for node, (first, last, _, _) in enumerate(forest.spans):
        centre = np.append(forest.centres[node], np.sqrt(max(stored["longest"][0] - (forest.centres[node] ** 2).sum(), 0)))
        assert np.sqrt(((points[below[node]] - centre) ** 2).sum(axis=1)).max() <= forest.radius[node] + 1e-9
        kids = forest.centres[first:last]
        gaps = np.sqrt(((kids[:, None] - kids[None]) ** 2).sum(axis=2) + np.equal.outer(np.arange(len(kids)), np.arange(len(kids))) * 1e9)
        lifts = np.sqrt(np.maximum(stored["longest"][0] - (kids ** 2).sum(axis=1), 0))
        assert not len(kids) or (np.sqrt(gaps ** 2 + (lifts[:, None] - lifts[None]) ** 2) > forest.radius[node] / 2).all()
    looked = []
    offer = hard_negative_mining.Window.offer
    monkeypatch.setattr(hard_negative_mining.Window, "offer", lambda self, p, s, r: (looked.append(len(p)), offer(self, p, s, r))[1])
    for query in x[:20]:
        looked.clear()
        scores = stored["x"] @ query
        window = hard_negative_mining.Window(5)
        forest.descend(query, np.arange(2), [window])
        order = np.lexsort((stored["rank"], -scores))[:5]
        assert window.scores.tolist() == scores[order].tolist() and window.points.tolist() == order.tolist()
        assert sum(looked) < len(x) / 2


def test_huge_components_are_scored_in_integers():
    import pyarrow as pa

    x = [[1 << 40, 3], [1 << 40, 1], [1 << 40, 2]]
    table = pa.table({"id": [1, 2, 3], "x": pa.chunked_array([x], pa.list_(pa.int64())), "label": ["a"] * 3, "__place_file": [0] * 3, "__place_row": [0, 1, 2]})
    forest, window = hard_negative_mining.Forest(hard_negative_mining.cover_forest(table)), hard_negative_mining.Window(2)
    forest.descend(np.array([1 << 20, 1]), np.arange(1), [window])
    assert window.scores.tolist() == [(1 << 60) + 3, (1 << 60) + 2]


# ---------------------------------------------------------------- lexical search


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def document_rows():
    draw = random.Random(9)
    words = [f"w{int(draw.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 60)))) for i in range(600)]
    rows += [(600, None), (601, ""), (602, " .,;\n"), (603, "W1 w1, Éa éa ÉA x-y_z"), (None, "w1 w2 unique"), (None, "w1 w2 unique"), (5, rows[5][1])]
    rows += [(700 + i, "same text of many copies w3 w4") for i in range(200)] + [(604, "w1 w2 w3 " * 5000), (605, "日本 語 ſ K")]
    return [(i, t, "x", 1, 2, "p") for i, t in rows]


ITEMS = [
    (1, "w1 w2 W3 w3 unique"), (2, "same text copies"), (3, None), (4, ""), (5, "nowhere to find"), (6, "éa Éa ÉA x y"), (1, "w1 w2 W3 w3 unique"),
    (None, "w5 w6 w7 w8 w9 w10 w11 w12"), (7, "日本 ſ w1 w2 w4 w14 w20 w21 w33 w40 w41 w55"), (8, " ".join(f"w{i}" for i in range(300))),
]


def slow_search(docs, items, k=10):
    counts = [(i, collections.Counter(re.findall(TERM, lower(t or "")))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, words = len(counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        terms, scored = set(re.findall(TERM, lower(text or ""))), []
        for i, c in counts:
            m = 10 + 90 * c.total() * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((score, i))
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(by_score(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame(document_rows(), "doc_id long, text string, item_id string, rank int, score long, term string").repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, doc_id int").coalesce(1).write.parquet(f"{base}/benchmark.parquet")
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")


@pytest.mark.parametrize("postings", [lexical_search.SHARD_POSTINGS, 700])
def test_ranking_is_that_of_every_document(texts, postings):
    got = lexical_search.search(*texts, shard_postings=postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = slow_search([r[:2] for r in document_rows()], ITEMS)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_empty_sides(texts):
    docs, items = texts
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_lists_are_restored_and_blocks_stay_closed():
    draw = random.Random(4)
    state = (lexical_search._Numbers(), [], [], [], [])
    for i in range(40_000):
        words = [b"common"] * (1 + (i % 977 == 0) * 30) + [b"half"] * (i % 2) + [b"r%d" % draw.randrange(9000)]
        numbers, tf = np.unique([state[0][w] for w in words], return_counts=True)
        for part, value in zip(state[1:], (i, numbers, tf, len(words))):
            part.append(value)
    shard = lexical_search.Shard(lexical_search._shard(*state), 40_000, 100_000)
    rare = next(t for t in state[0] if t.startswith(b"r"))
    shard.best([(b"common", 1), (b"half", 700), (rare, 9000)], 3)
    lists = {t: slice(shard.ends[n], shard.ends[n + 1]) for t, n in shard.number.items() if t in (b"common", b"half")}
    assert shard.closed[lists[b"common"]].mean() > 0.9
    shard.open(np.arange(len(shard.closed)))
    begin, end = (shard.starts[shard.ends[shard.number[b"half"] + i]] for i in (0, 1))
    assert shard.docs[begin:end].tolist() == list(range(1, 40_000, 2))
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 1 << 40])
    assert lexical_search._decoded(lexical_search._encoded(values)[0]).tolist() == values.tolist()


def test_sql_gives_the_same_on_odd_rows(spark, stored, texts, tmp_path):
    con = duckdb.connect()
    con.register("embeddings", stored.where("size(embedding) = 6 or embedding is null").toPandas())
    docs, items = texts
    con.register("documents", docs.toPandas())
    con.register("benchmark", items.toPandas())
    base = str(tmp_path)
    stored.where("size(embedding) = 6 or embedding is null").write.parquet(f"{base}/embeddings.parquet")
    docs.write.parquet(f"{base}/documents.parquet")
    items.write.parquet(f"{base}/benchmark.parquet")
    for name in ("op11_hard_negative_mining", "op12_exact_top_k_search", "op13_ranked_lexical_search"):
        got = queries.QUERIES[name](spark, base)
        rows = con.execute(queries.ORACLES[name])
        order = [[d[0] for d in rows.description].index(c) for c in got.columns]
        want = collections.Counter(tuple(r[i] for i in order) for r in rows.fetchall())
        assert want and collections.Counter(map(tuple, got.collect())) == want, name
