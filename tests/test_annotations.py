from collections import Counter

from pyspark.sql import functions as F

from boxlake.operators import annotations as A
from boxlake.operators import batching as B

LINES = [
    ("a", "0 0.5 0.5 0.2 0.1"), ("a", "1 0.4 0.4 0.2 0.1 extra"), ("a", ""), ("a", "   "), ("a", "0 0.5 0.5"),
    ("a", "0  0.5 0.5 0.2 0.1"), ("a", "0 x 0.5 0.2 0.1"), ("b", "0 0.1 0.2 0.3 0.4"), ("orphan", "0 0.1 0.2 0.3 0.4"),
]
ON = ["image_name"]


def lines(spark):
    return spark.createDataFrame(LINES, "image_name string, value string")


def images(spark):
    rows = [("a", "train", 0, 640, 480), ("b", "valid", 1, 300, 217), ("c", "test", 2, 100, 100)]
    return spark.createDataFrame(rows, "image_name string, split_name string, split_id int, img_width int, img_height int")


def test_parse_labels(spark):
    rows = A.parse_labels(lines(spark)).collect()
    assert sorted((r.image_name, r.class_id) for r in rows) == [("a", 0.0), ("a", 1.0), ("b", 0.0), ("orphan", 0.0)]


def test_rejects(spark):
    rows = {r.reason: r.n_lines for r in A.label_rejects(lines(spark)).collect()}
    assert rows == {"blank": 2, "short": 1, "non_numeric": 2}


def test_bboxes_are_rows_at_every_size(spark):
    rows = [("hot", 0.0, float(i % 40), 0.0, 0.0, 0.0) for i in range(3000)] + [("cold", 0.0, 1.0, 1.0, 1.0, 1.0)] * 4
    labels = spark.createDataFrame(rows, "image_name string, class_id float, cx float, cy float, w float, h float")
    out = A.build_bboxes(labels, ON)
    assert Counter((r.image_name, r.class_id, r.cx, r.pos_mask) for r in out.collect()) == Counter((*r[:3], 1.0) for r in rows)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_join_keeps_unlabeled_and_drops_orphans(spark):
    joined = A.join_images_boxes(images(spark), A.build_bboxes(A.parse_labels(lines(spark)), ON), ON)
    assert Counter((r.image_name, r.cx is None) for r in joined.collect()) == {("a", False): 2, ("b", False): 1, ("c", True): 1}


def test_split_keys_keep_equal_names_apart(spark):
    both = spark.createDataFrame([("s", "train"), ("s", "valid")], "image_name string, split_name string")
    labels = spark.createDataFrame([("s", "train", "0 0.5 0.5 0.1 0.1")], "image_name string, split_name string, value string")
    joined = A.join_images_boxes(both, A.build_bboxes(A.parse_labels(labels)))
    assert {r.split_name: r.pos_mask for r in joined.collect()} == {"train": 1.0, "valid": None}


def test_counted_boxes(spark):
    rows = A.counted_boxes(images(spark), A.parse_labels(lines(spark)), ON).collect()
    assert Counter((r.image_name, r.num_boxes) for r in rows) == {("a", 2): 2, ("b", 1): 1}


def test_statistics_count_names(spark):
    frame = spark.createDataFrame([("s", "train"), ("s", "valid"), ("t", "train"), ("t", "train")], "image_name string, split_name string")
    boxes = spark.createDataFrame([("train", 0.5, 2.0, 0.25)], "split_name string, cx double, aspect_ratio double, bbox_area_norm double")
    got = {r.split_name: (r.total_images, r.total_boxes) for r in A.dataset_stats(frame, boxes, by_split=True).collect()}
    assert got == {"train": (2, 1), "valid": (1, 0), None: (2, 1)}


def test_audits(spark):
    labels = A.parse_labels(lines(spark))
    assert [r.image_name for r in A.unlabeled_images(images(spark), labels, ON).collect()] == ["c"]
    assert [r.image_name for r in A.orphan_labels(images(spark), labels, ON).collect()] == ["orphan"]


def test_count_images(spark):
    many = spark.range(33).select(F.lit("train").alias("split_name"))
    assert list(A.count_images(many, 16).first()) == ["train", 33, 3]


def test_pad_column_edges(spark):
    frame = spark.createDataFrame(
        [([1.0, 2.0], [[1.0, 2.0, 3.0, 4.0], [5.0]], [1.0]), (None, None, None), ([1.0] * 30, [[1.0] * 5] * 30, [0.5] * 30)],
        "c array<float>, r array<array<float>>, m array<double>",
    )
    rows = frame.select(*B.pad_column(F.col("c"), F.col("r"), F.col("m"), 3)).collect()
    assert list(rows[0]) == [[1, 2, 0], [[1, 2, 3, 4], [0] * 4, [0] * 4], [1, 1, 0]]
    assert list(rows[1]) == [[0] * 3, [[0] * 4] * 3, [0] * 3]
    assert list(rows[2]) == [[1] * 3, [[1] * 4] * 3, [0.5] * 3]


def test_pad_targets_keeps_the_first_boxes(spark):
    labels = spark.range(50).select(
        F.lit("a").alias("image_name"), F.lit(0.0).cast("float").alias("class_id"),
        *[(F.col("id") / 100).cast("float").alias(c) for c in ("cx", "cy", "w", "h")],
    )
    rows = {r.image_name: r for r in B.pad_targets(images(spark), labels, ON).collect()}
    assert [round(b[0], 2) for b in rows["a"].reg] == [i / 100 for i in range(20)]
    assert rows["b"].mask == [0.0] * 20


def test_ordinals_match_a_plain_sort(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, "train").otherwise("test").alias("split_name"),
        F.concat(F.lit("img_"), F.col("id").cast("string")).alias("image_name"), "id",
    )
    got = B.make_batches(frame, B.shuffle_key(F.col("id"), 7), F.col("id")).toPandas()
    assert len(got) == 5000
    for split, part in got.groupby("split_name"):
        key = (part.id * 48271 + 7) % (2**31 - 1) if split == "train" else part.id
        expected = part.assign(key=key).sort_values(["key", "image_name"])
        assert list(expected.ordinal) == list(range(len(part)))
        assert (expected.batch_id == expected.ordinal // 16).all()


def test_ordinals_with_equal_keys(spark):
    frame = spark.range(100).select(F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("image_name"))
    got = B.with_ordinal(frame, F.lit(5).cast("long"), ["image_name"]).orderBy("ordinal").collect()
    assert [r.image_name for r in got] == [f"i{i:03d}" for i in range(100)]


def test_ordinals_across_buckets_take_two_reads(spark):
    frame = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("image_name"))
    numbered = B.with_ordinal(frame, (F.col("id") * 37) % 1009, ["image_name"], by=["g"], width=16)
    for g in range(3):
        got = [r.id for r in numbered.where(f"g = {g}").orderBy("ordinal").collect()]
        assert got == sorted(range(g, 1000, 3), key=lambda i: i * 37 % 1009)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2


def test_sample_of_fewer(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "image_name string")
    assert B.sample_images(frame, B.name_key(F.col("image_name"), 3)).count() == 2


def test_stored_positions_are_found_by_a_pushed_filter(spark, tmp_path):
    frame = spark.range(3000).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_name"), "id")
    path = str(tmp_path / "ordered")
    B.store_ordered(frame, path, B.shuffle_key(F.col("id"), 3), row_group_bytes=4096)
    order = sorted(range(3000), key=lambda i: ((i * B.KEY_FACTOR + 3) % B.KEY_BOUND, f"i{i}"))
    for at in (0, 1234, 2999):
        found = B.image_at(spark, path, at)
        assert [tuple(r) for r in found.collect()] == [(at, f"i{order[at]}")]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"EqualTo(ordinal,{at})" in plan and not any(word in plan for word in ("Exchange", "Window", "Sort"))
    assert B.image_at(spark, path, 3000).count() == 0
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("z")).orderBy("a").collect()
    assert len(spans) > 1 and all(one.z < two.a for one, two in zip(spans, spans[1:]))
