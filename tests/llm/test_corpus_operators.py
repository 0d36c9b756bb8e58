"""Corpus operators against brute force, on rows with nulls, empty, long and repeated texts, ties and clashing columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from boxlake.llm import (
    decontamination, exact_dedup, graph, language_id, license_scan, pii, sentencepiece_fst, sharding,
    simhash, substring_dedup, token_counts,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, `row` string, print string, name int, words string, ids int, kept string, pos int, unit string, hash long"
)
SPACE = r"[^\x20\x09-\x0D]+"
LONG = " ".join(f"word{i % 7001} Of" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(70))


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


TEXTS = [
    (1, "Alpha beta gamma delta"), (2, "alpha BETA gamma delta"), (3, None), (4, ""), (5, " \t\n"), (6, LONG), (7, LONG),
    (8, "ÄÖ äö"), (9, "äÖ äö"), (10, f"x y {PASSAGE} z"), (11, f"{PASSAGE} tail words"), (12, f"head {PASSAGE}"),
    (12, f"head {PASSAGE}"), (13, "one"), (13, "One"), (None, "null id"), (None, "null id"), (None, None), (14, "a▁b  c\x0b日本"),
    (15, "x" * 5000), (16, "X" * 5000), (17, "y" * 4096), (18, f"{PASSAGE} {PASSAGE}"),
]


def rows_of(texts):
    langs = ("en", "de", None)
    return [
        (i, t, langs[k % 3], None if k % 4 else "s", None, "k", "r", "p", k, "w", k, "yes", k, "u", k)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    return collections.Counter(map(tuple, rows))


# ---------------------------------------------------------------- 1 SentencePiece


def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=f"{sentencepiece_fst.TOKENIZERS}/{sentencepiece_fst.MODEL}")


def test_pieces_are_those_of_the_library(docs, none):
    tool = library()
    got = sentencepiece_fst.encode_and_decode(docs).collect()
    want = [(i, None if t is None else tuple(tool.encode(t)), None if t is None else tool.decode(tool.encode(t))) for i, t in TEXTS]
    assert counted((r.doc_id, None if r.ids is None else tuple(r.ids), r.decoded) for r in got) == counted(want)
    assert all(w[2] == t or "▁" in t for w, (_, t) in zip(want, TEXTS) if t is not None)
    assert sentencepiece_fst.encode_and_decode(none).count() == 0


def test_ids_are_decoded_by_the_worker_that_made_them(docs):
    """Two Python passes in a row would hold two workers, each with its own pieces, for every running task."""
    plan = sentencepiece_fst.encode_and_decode(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    apart = sentencepiece_fst.decode(sentencepiece_fst.encode(docs.select("doc_id", "text")))
    got = sentencepiece_fst.encode_and_decode(docs)
    assert apart.columns == ["doc_id", "text", "ids", "decoded"]
    assert counted((r.doc_id, str(r.ids), r.decoded) for r in got.collect()) == counted((r.doc_id, str(r.ids), r.decoded) for r in apart.collect())


def test_path_search_on_odd_strings():
    tool = library()
    with open(f"{sentencepiece_fst.TOKENIZERS}/{sentencepiece_fst.MODEL}", "rb") as model:
        transducer = sentencepiece_fst.Transducer(sentencepiece_fst.Model(model.read()))
    draw, parts = random.Random(7), list("  abeth\n\t▁é日0<>.\x00\U0001f600") + ["the", "ing", "    ", "==", "__"]
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert np.frombuffer(transducer.encode(text), "<i4").tolist() == tool.encode(text), repr(text)


def test_unigram_takes_the_lightest_path():
    model = sentencepiece_fst.Model.__new__(sentencepiece_fst.Model)
    model.pieces, model.scores = ["<unk>", "▁", "a", "b", "ab", "▁a", "bb"], [0.0, -2.0, -1.5, -1.5, -2.0, -2.5, -5.0]
    model.kinds, model.bpe, model.prefix = [2] + [1] * 6, False, True
    transducer = sentencepiece_fst.Transducer(model)
    assert np.frombuffer(transducer.encode("abb"), "<i4").tolist() == [1, 4, 3]
    assert np.frombuffer(transducer.encode("aé"), "<i4").tolist() == [5, 0]


# ---------------------------------------------------------------- 2 sharding


@pytest.mark.parametrize("limit", [50, 6000, 1 << 30])
def test_shards_are_the_shortest_prefixes_that_fit(docs, none, limit):
    rows = sharding.assign(docs, "doc_id", sharding.text_bytes(), ("source",), limit).collect()
    sizes = [len((t or "").encode()) for _, t in TEXTS]
    assert counted((r.doc_id, r.n_bytes) for r in rows) == counted((i, n) for (i, _), n in zip(TEXTS, sizes))
    held = collections.defaultdict(list)
    for r in rows:
        held[r.shard].append(r)
    for shard, own in held.items():
        total = sum(r.n_bytes for r in own)
        assert (total, len(own)) == (own[0].shard_bytes, own[0].shard_rows)
        assert total <= limit or len(own) == 1
        if shard:
            above = [r for r in rows if r.shard.startswith(shard[:-1])]
            assert sum(r.n_bytes for r in above) > limit and len(above) > 1
        for r in own:
            bits = f"{int(hashlib.md5(str('' if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16):060b}"
            assert bits.startswith(shard[:60])
    assert sharding.assign(none, "doc_id", sharding.text_bytes(), (), limit).count() == 0


def test_a_hot_key_is_split_and_shards_are_written_whole(spark, tmp_path):
    hot = spark.range(600).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "repeat('x', 100) as text", "id as shard_key", "1 as row")
    out = str(tmp_path / "shards")
    sharding.write_shards(hot, out, shard_bytes=1000)
    back = spark.read.parquet(out)
    assert back.count() == 600 and back.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 10


# ---------------------------------------------------------------- 3 language ID


def spoken(lang, n, seed):
    draw = random.Random(seed)
    parts = {"aa": ["tion", "the", "ing", "er"], "bb": ["sch", "ung", "ein", "keit"]}[lang]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))


def test_languages_are_told_on_held_out_texts(spark, none):
    rows = [(i, spoken(lang, 40, i), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(frame.where("doc_id < 80"))
    got = language_id.identify(frame.where("doc_id >= 80").select("doc_id", "text"), model).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and 0 <= r.lang_score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "日本語"), (None, "the " * 60_000)], "doc_id long, text string")
    told = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [told[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and told[1].lang_score == 0
    assert told[4].lang_bits > 8 and told[None].lang_pred == "aa"
    assert language_id.fit(none) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}
    stay = language_id.keep_known_languages(frame.unionByName(odd, True))
    assert stay.count() == 121 and stay.columns == frame.columns


def test_code_lengths_are_those_of_the_definition(spark):
    texts = {"aa": b"abcab abd", "bb": b"bbcA"}
    frame = spark.createDataFrame([(l, bytearray(t)) for l, t in texts.items()], "lang string, text binary")
    model = language_id.Model(language_id.gram_counts(frame, 2).toPandas(), 2)

    def bits(lang, text):
        known = b"  " + texts[lang].lower()
        counts = collections.defaultdict(collections.Counter)
        for k in range(3):
            for i in range(k, len(known)):
                counts[known[i - k:i]][known[i]] += 1

        def cost(context, byte):
            seen = counts.get(context) if any(context in (b"  " + t.lower()) for t in texts.values()) else None
            lower = cost(context[1:], byte) if context else 8.0
            if not seen:
                return lower
            n, d = sum(seen.values()), len(seen)
            return -np.log2(seen[byte] / (n + d)) if seen[byte] else lower - np.log2(d / (n + d))

        padded = b"  " + text.lower()
        return sum(cost(padded[max(0, i - 2):i], padded[i]) for i in range(2, len(padded)))

    for text in (b"abcab", b"zab", b"B", "é".encode(), b"cba bcd" * 9, b"abcab abd bbca" * 700):
        assert model.bits([text])[0] == pytest.approx([bits("aa", text), bits("bb", text)], rel=1e-5)


def test_every_context_of_a_rare_language_is_kept(spark):
    """Many languages, one of them in a single short text: its own contexts still decide."""
    common = [(f"l{i:02d}", bytearray("".join(chr(97 + (j * j + i * j) % 26) for j in range(400)).encode())) for i in range(40)]
    rare = bytearray("жук ёж щи".encode())
    model = language_id.Model(language_id.gram_counts(spark.createDataFrame([*common, ("zz", rare)], "lang string, text binary")).toPandas())
    grams = {bytes(b"   " + text)[i:i + 3] for _, text in [*common, ("zz", rare)] for i in range(len(text))}
    assert model.nodes > len(grams) and model.langs[int(model.bits([bytes(rare)])[0].argmin())] == "zz"
    long = bytes(rare) * 3000
    assert model.bits([long, b"abc", long])[2] == pytest.approx(model.bits([long])[0], rel=1e-9)


# ---------------------------------------------------------------- 4 SimHash


def slow_print(text):
    words = re.findall(SPACE, lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_every_pair_within_the_radius_meets_in_a_table():
    for radius, q in ((2, 2), (2, 3), (4, 2)):
        dropped = [set(d) for _, d in simhash.covering_masks(radius, q)]
        draw = random.Random(radius)
        pairs = [(a, b) for a in range(64) for b in range(a)] if radius == 2 else [draw.sample(range(64), 4) for _ in range(500)]
        assert all(any(set(p) <= d for d in dropped) for p in pairs)


def test_near_groups(docs, none):
    got = simhash.near_groups(docs).collect()
    prints = {t: slow_print(t) for _, t in TEXTS}
    assert counted((r.doc_id, r.print & (1 << 64) - 1) for r in got) == counted((i, prints[t]) for i, t in TEXTS)
    values = sorted(set(prints.values()))
    root = {v: v for v in values}
    for _ in values:
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {v: min((i for i, t in TEXTS if root[prints[t]] == v and i is not None), default=None) for v in set(root.values())}
    assert all(r.component == least[root[r.print & (1 << 64) - 1]] for r in got)
    assert simhash.near_groups(none).count() == 0
    stay = simhash.keep_first_of_groups(docs)
    assert stay.columns == docs.columns and stay.count() == len(least)


def test_groups_with_one_key_or_none_stay_apart(spark):
    texts = ["red fox jumps over dogs", "blue whale sings below ice", "green tea cools on tables"]
    rows = [(None, t) for t in texts] + [(5, t + " again") for t in texts] + [(6, texts[0].upper())]
    stay = simhash.keep_first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(None, t) for t in texts[1:]] + [(5, t + " again") for t in texts] + [(6, texts[0].upper())]
    assert counted(stay.collect()) == counted(want)


def test_links_join_all_within_two_bits(spark):
    draw = random.Random(4)
    values = [draw.getrandbits(64) for _ in range(40)]
    for v in values[:20]:
        for _ in range(4):
            values.append(values[-1] ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) if draw.random() < 0.5 else v ^ 1 << draw.randrange(64))
    values = sorted(set(values))
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "print long")
    found = graph.components(simhash.links(frame), "print", "least").collect()
    root = {simhash._signed(v): simhash._signed(v) for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                x, y = simhash._signed(a), simhash._signed(b)
                if (a ^ b).bit_count() <= 2 and root[x] != root[y]:
                    root[x] = root[y] = min(root[x], root[y])
                    changed = True
    got = {r.node: r.root for r in found}
    assert all(got.get(v, v) == root[v] for v in root)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}


# ---------------------------------------------------------------- 5 exact dedup


@pytest.mark.parametrize("size", [7, 4096])
def test_duplicate_groups(docs, none, size):
    got = exact_dedup.duplicate_groups(docs, block_bytes=size).collect() if size > 7 else exact_dedup.duplicate_groups(
        docs.where("length(text) < 600 or text is null"), block_bytes=size).collect()
    texts = [(i, t) for i, t in TEXTS if size > 7 or len(t or "") < 600]
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[lower(t)].append(i)
    want = counted(
        (i, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t in texts
    )
    assert counted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    names = {(r.level, r.name): r.text_sha256 for r in got}
    assert len(names) == len(groups) == len(set(names.values()))
    assert exact_dedup.duplicate_groups(none).count() == 0


def test_names_hold_across_tasks(spark):
    rows = [(i, ("ab" * 40 if i % 3 else f"{i % 20:02d}" * 40)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_dedup.duplicate_groups(frame, block_bytes=8).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    sizes = collections.Counter(t for _, t in rows)
    assert {r.doc_id: r.group_size for r in got} == {i: sizes[t] for i, t in rows}


def test_one_row_of_each_text_stays(docs):
    stay = exact_dedup.keep_one_of_each(docs)
    assert stay.columns == docs.columns and stay.count() == len({lower(t) for _, t in TEXTS})


# ---------------------------------------------------------------- 6 decontamination

ITEMS = [
    (1, "Ann has 12 apples and gives 5 apples to her friend Bob before 12 is asked"), (2, None), (3, ""), (4, "too short item"),
    (None, "Plain words without any numbers or names that fill a whole long sentence here"), (1, "9 8 7 6 5 4 3 2 1 0"),
]
CASES = [
    (1, "Note that Ann has 12 apples and gives 5 apples to her friend Bob before 12 is asked again"),
    (2, "note that Ann has 31 apples and gives 8 apples to her friend Cleo before 31 is asked"),
    (3, "note that Ann has 31 apples and gives 8 apples to her friend Cleo before 44 is asked"),
    (4, "too short item"), (5, None), (6, ""), (7, "something else entirely with several words but none of the items"),
    (None, "here plain words without any numbers or names that fill a whole long sentence HERE!"), (8, "9 8 7 6 5 4 3 2 1 0"),
    (9, "so too short item"), (10, "word " * 20_000),
]


def test_contaminated_documents(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in CASES], "doc_id long, text string, words string, hash int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.exact for r in decontamination.matches(docs, items, ["doc_id"]).collect()}
    assert got == {(1, 1): True, (2, 1): False, (None, None): True, (4, 4): True}
    stay = decontamination.drop_contaminated(spark, docs, items)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {3, 5, 6, 7, 8, 9, 10}
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        assert decontamination.matches(a, b, ["doc_id"]).count() == 0


@pytest.mark.parametrize("key", [None, 7])
def test_rows_with_one_key_or_none_are_judged_apart(spark, key):
    docs = spark.createDataFrame([(key, CASES[0][1]), (key, CASES[0][1]), (key, CASES[1][1])], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    got = decontamination.matches_of_rows(docs, items, "doc_id").collect()
    alone = decontamination.matches_of_rows(docs.limit(1), items, "doc_id").first()
    assert sorted((r.doc_id, r.item_id, r.exact) for r in got) == [(key, 1, False), (key, 1, True), (key, 1, True)]
    assert {(r.n_windows, r.matched) for r in got} == {(alone.n_windows, alone.matched)}


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = decontamination.matches(docs, items, ["doc_id"]).collect()
    monkeypatch.setattr(decontamination, "BLOCK_ROWS", 4)
    assert counted(whole) == counted(decontamination.matches(docs, items, ["doc_id"]).collect())


# ---------------------------------------------------------------- 7 token counts


def test_counts_follow_edits(spark, docs, none):
    with open(f"{token_counts.TOKENIZERS}/{token_counts.RANKS}", "rb") as ranks:
        tool = token_counts.encoding(ranks.read())
    frame = token_counts.count_tokens(docs.select("doc_id", "text"), leaf_chars=64)
    edited = token_counts.update_counts(frame.withColumn("edits", token_counts.drawn_edits()), leaf_chars=64).collect()
    for r in edited:
        assert r.n_tokens == len(tool.encode_ordinary(r.text or ""))
        assert r.new_tokens == r.new_tree[1] == len(tool.encode_ordinary(r.new_text)) and sum(r.new_leaf_chars) == len(r.new_text)
        assert r.n_applied + r.n_rejected == 3 and r.n_reencoded <= len(r.leaf_chars)
    assert max(len(r.leaf_chars) - r.n_reencoded for r in edited) > 1000
    assert token_counts.count_tokens(none.select("doc_id", "text")).count() == 0
    table = spark.createDataFrame(
        [(1, 0, 5, "X"), (1, 2, 3, "no"), (1, None, 1, "no"), (2, 99, 120, " end"), (None, 0, 0, "no"), (404, 0, 0, "no")],
        "doc_id long, start long, stop long, text string",
    )
    got = token_counts.update_counts(token_counts.attach_edits(frame.where("doc_id < 4"), table)).collect()
    assert {r.doc_id: (r.new_text, r.n_applied, r.n_rejected) for r in got} == {
        1: ("X beta gamma delta", 1, 1), 2: ("alpha BETA gamma delta end", 1, 0), 3: ("", 0, 0)}


def test_random_edits():
    with open(f"{token_counts.TOKENIZERS}/{token_counts.RANKS}", "rb") as ranks:
        tool = token_counts.encoding(ranks.read())

    def count(text):
        return len(tool.encode_ordinary(text))

    draw, parts = random.Random(3), ["a", " ", "  ", "\n", "'s", "x1", " 12", "\t", "é", "日", "!", "word ", " the"]
    for _ in range(300):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 200)))
        leaves, at, counts = token_counts.cut_leaves(text, 8), 0, []
        for size in leaves:
            counts.append(count(text[at:at + size]))
            at += size
        tree, leaves = token_counts.build_tree(counts), np.array(leaves, np.int64)
        for _ in range(3):
            edits = [{"start": a, "stop": a + draw.choice([0, 1, 30]), "text": draw.choice(parts) * draw.choice([0, 1, 9])}
                     for a in (draw.randint(0, len(text) + 2) for _ in range(3))]
            kept, _ = token_counts.accepted(edits, len(text))
            text, leaves, tree, _ = token_counts.apply_edits(text, leaves, tree, kept, count, 8)
            assert tree[1] == count(text) and leaves.sum() == len(text)
            assert (tree == token_counts.build_tree(tree[len(tree) // 2:].tolist())).all()


@pytest.mark.parametrize("place", [0, 700, 100_000])
def test_a_chain_of_edits_at_one_place_encodes_little_again(place):
    with open(f"{token_counts.TOKENIZERS}/{token_counts.RANKS}", "rb") as ranks:
        tool = token_counts.encoding(ranks.read())
    encoded = []

    def count(text):
        encoded.append(len(text))
        return len(tool.encode_ordinary(text))

    text = " some words" * 100
    leaves = token_counts.cut_leaves(text, 64)
    ends = np.cumsum(leaves)
    tree, leaves = token_counts.build_tree([count(text[e - n:e]) for e, n in zip(ends, leaves)]), np.array(leaves, np.int64)
    for step in range(1000):
        encoded.clear()
        at = min(place, len(text))
        text, leaves, tree, _ = token_counts.apply_edits(text, leaves, tree, [(at, at, f" word{step} and")], count, 64)
        assert sum(encoded) <= 600
    assert tree[1] == len(tool.encode_ordinary(text)) and leaves.sum() == len(text)
    assert leaves.max() < 160 and len(leaves) < len(text) / 32


# ---------------------------------------------------------------- 8 substring dedup


def slow_repeats(texts, window):
    first = {}
    words = [re.findall(SPACE, t or "") for _, t in texts]
    for (i, _), w in zip(texts, words):
        for p in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(texts, words):
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_repeated_words_go(docs, none):
    got = substring_dedup.remove_repeats(docs).collect()
    assert counted(r[:4] for r in got) == counted(slow_repeats(TEXTS, 50))
    assert sum(r.n_removed for r in got) > 60_000
    assert substring_dedup.remove_repeats(none).count() == 0


def test_repeats_in_random_texts(spark):
    draw = random.Random(9)
    pool = [[draw.choice("abcde") for _ in range(draw.randint(3, 14))] for _ in range(12)]
    texts = [(draw.randint(0, 40), " ".join(w for _ in range(draw.randint(0, 6)) for w in draw.choice(pool))) for _ in range(80)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = substring_dedup.remove_repeats(frame, window=9, kmer=4).collect()
    assert counted(r[:4] for r in got) == counted(slow_repeats(texts, 9))


# ---------------------------------------------------------------- 9 personal data


def slow_rules(text):
    found = [(*m.span(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(*m.span(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m.group().split("."))]
    found += [(*m.span(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d)]
    found += [(*m.span(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_rules_match_their_patterns():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    draw = random.Random(2)
    parts = ["a", "b.c", "@", "@@", "x@y.z", ".", "-", "1", "25", "256", "10.0.0.1", " ", "+1", "(555)", "4111 1111 1111 1111", "é", "日", "\n"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 18)))
        assert pii.rule_spans(text) == slow_rules(text), repr(text)
    assert pii.rule_spans("9" * 50_000 + "@" + "a" * 200_000) == []


def test_trees_add_what_looks_like_the_rules(spark, none):
    draw = random.Random(6)

    def digits(n):
        return "".join(str(draw.randint(0, 9)) for _ in range(n))

    rows = []
    for i in range(600):
        text = f"the order {digits(16)} of {digits(4)}, call +1 ({digits(3)}) {digits(3)}-{digits(4)} now or write to u{i}@mail.example.com. Token {digits(9)}x"
        rows.append((i, text))
    rows += [(9001, "please call (614) 555-8001 today"), (9002, None), (9003, ""), (None, "x" * 300_000), (9004, "version 1234567 and 20261201")]
    rows += [(9005, "version 123456789 of build 20261201123457"), (9006, "met at school.Then home")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(frame)
    found = {r.doc_id: r for r in pii.find(frame, model).collect()}
    for i, text in rows:
        base = [(s.begin, s.stop, pii.KINDS.index(s.kind)) for s in found[i].base]
        assert base == slow_rules(text or "")
        assert set(found[i].base) <= set(found[i].spans)
    assert [(s.kind, s.begin, s.stop) for s in found[9001].spans] == [("phone", 12, 26)]
    assert all(found[i].spans == [] for i in range(9004, 9007)) and found[9002].spans == []
    cut = {r.doc_id: r.text for r in pii.redact(frame, model).collect()}
    assert cut[9001] == "please call [PHONE] today" and cut[9002] is None and "[EMAIL]" in cut[5]
    empty = none.select("doc_id", "text")
    assert pii.fit(empty) is None and pii.find(empty, None).count() == 0


def test_the_model_counts_every_document(spark):
    """A hundred documents among twenty thousand teach a kind; how the rows are dealt out changes nothing."""
    draw = random.Random(8)

    def digits(n):
        return "".join(str(draw.randint(0, 9)) for _ in range(n))

    rows = [(i, f"nothing of note in text {i}") for i in range(20_000)]
    for i in range(0, 20_000, 200):
        rows[i] = (i, f"the order {digits(16)} of {digits(4)}, call +1 ({digits(3)}) {digits(3)}-{digits(4)} now")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    models = [pii.fit(frame.repartition(parts)) for parts in (1, 5)]
    assert 3 in models[0].by_kind and models[0].by_kind[3][1] < float("inf")
    for k, (trees, threshold) in models[0].by_kind.items():
        other, again = models[1].by_kind[k]
        assert threshold == again
        for one, two in zip(trees.trees, other.trees, strict=True):
            assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_every_written_form_is_proposed():
    phones = ["(030) 12345678", "0171 23456789", "6145558001", "+1 614-555-8001", "614.555.8001"]
    long_name, long_host = "n" * 200 + ".x@mail.com", "me@" + "h" * 90 + ".".join("abcdefghijkl") + ".com"
    mails = ["name (at) mail dot com", "name at mail dot com", "name@mail.com", "name [at] mail [dot] co (dot) uk", "name AT mail DOT com", long_name, long_host]
    for kind, pieces in ((3, phones), (0, mails)):
        for piece in pieces:
            for before, after in (("", ""), ("so, ", " then"), ("a b@c.de ", ".")):
                start = len(before) + piece.startswith("+")
                assert (start, len(before + piece), kind) in pii.candidates(before + piece + after), piece
    for text in ("at " * 100_000, "a" * 300_000 + " at " + "b" * 300_000, "a at b dot " * 30_000, "1 " * 150_000):
        pii.candidates(text)


def test_trees_take_single_numbers_where_words_introduce_them(spark):
    draw = random.Random(3)

    def digits(n):
        return "".join(str(draw.randint(1, 9)) for _ in range(n))

    rows = [(i, f"Parcel {digits(11)} is on its way since 2026-0{i % 9 + 1}-1{i % 10} 1{i % 7}:30, {'call' if i % 2 else 'phone'} +{digits(11)} for help, invoice {digits(12)}.") for i in range(600)]
    rows += [(1000 + i, f"please {cue} {digits(11)} for help") for i, cue in enumerate(("call", "phone"))]
    rows += [(2000 + i, f"the {word} {digits(11)} is here") for i, word in enumerate(("parcel", "build", "invoice"))]
    rows += [(2003, "from 2026-12-01 10:30 to 2026-12-02"), (2004, "version 10.20.301.4567")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(frame, pii.fit(frame)).collect()}
    assert [found[i] for i in (1000, 1001)] == [["phone"]] * 2
    assert [found[i] for i in range(2000, 2005)] == [[]] * 5


# ---------------------------------------------------------------- 10 licences


def test_licences(spark, none):
    mit = license_scan.TEMPLATES["MIT"][2]
    rows = [
        (1, "Prose here.\nLicensed under the apache LICENSE, version 2.0\nmore prose"), (2, mit.replace(" of this software", "")),
        (3, mit.replace("software and", "software\nand")), (4, None), (5, ""), (6, "licence of the poet"), (7, "MIT"),
        (None, "Released under the MIT License."), (8, "word " * 50_000 + "\nReleased under the MIT License."),
        (9, "Released under the MIT License.\nReleased under the MIT license"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, unit string, gram int")
    got = {(r.doc_id, r.licence): (round(r.dice, 3), r.n_units) for r in license_scan.scan(frame).collect()}
    assert set(got) == {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (None, "MIT"), (8, "MIT"), (9, "MIT")}
    assert got[1, "Apache-2.0"] == (1.0, 1) and got[9, "MIT"] == (1.0, 3) and 0.9 < got[2, "MIT"][0] < 1
    assert license_scan.scan(none).count() == 0
    assert license_scan.scan(frame, templates={}).count() == 0
