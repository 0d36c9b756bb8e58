import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions import pixels as P
from boxlake.operators import history as H
from boxlake.operators import pixels as PX
from boxlake.operators import scoring as S
from boxlake.plans import preprocess
from boxlake.sources import files, sinks
from boxlake.streaming import inbox
from boxlake.stub_model import make_stub


def picture(width, height, seed=0):
    return np.random.default_rng(seed).integers(0, 255, (height, width, 3), dtype=np.uint8)


def filtered_png(pixels, kind):
    """A PNG whose rows all use one filter type."""
    height, width, _ = pixels.shape
    flat = pixels.reshape(height, -1).astype(int)
    out = b""
    for y in range(height):
        up = flat[y - 1] if y else np.zeros_like(flat[0])
        line = []
        for i, v in enumerate(flat[y]):
            left, corner = (flat[y][i - 3], up[i - 3]) if i >= 3 else (0, 0)
            p = left + up[i] - corner
            paeth = min((left, up[i], corner), key=lambda c: abs(p - c))
            line.append((v - (0, left, up[i], (left + up[i]) // 2, paeth)[kind]) % 256)
        out += bytes([kind, *line])
    whole = P.encode_png(pixels)
    head = whole[: whole.index(b"IDAT") - 4]
    body = zlib.compress(out)
    return head + struct.pack(">I", len(body)) + b"IDAT" + body + b"\0\0\0\0" + struct.pack(">I", 0) + b"IEND\0\0\0\0"


def decoded(spark, contents):
    """Pixels of each content as an array, or the error text."""
    frame = spark.createDataFrame(list(enumerate(contents)), "place int, content binary")
    rows = PX.decode_rgb(frame).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(len(contents)))
    return [r.pixels.error or np.frombuffer(r.pixels.rgb, np.uint8).reshape(r.pixels.height, r.pixels.width, 3) for r in rows]


def chunked_png(width, height, depth, interlaced, data):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, depth, 2, 0, 0, interlaced)
    return P.PNG_MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(data)) + chunk(b"IEND", b"")


def interlaced_png(pixels):
    """Seven passes, each a coarse picture of its own: first row and column, then the steps."""
    data = b""
    for top, left, down, across in ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)):
        for row in pixels[top::down, left::across]:
            data += (b"\0" + row.tobytes()) if len(row) else b""
    return chunked_png(pixels.shape[1], pixels.shape[0], 8, 1, data)


def test_image_bytes_of_a_column(spark):
    pixels = picture(9, 11)
    body = b"".join(row[:, ::-1].tobytes().ljust(28, b"\0") for row in pixels[::-1])
    bmp = b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 9, 11, 1, 24, 0, 0, 0, 0, 0, 0)
    deep = b"".join(b"\0" + row.astype(">u2").tobytes() for row in pixels.astype(np.uint16).reshape(11, -1) * 257)
    whole = [P.encode_png(pixels), *[filtered_png(pixels, k) for k in range(5)], bmp + body, chunked_png(9, 11, 16, 0, deep), interlaced_png(pixels)]
    bad = [None, b"", b"hello", P.encode_png(picture(90, 90))[:60], P.encode_png(picture(90, 90))[:9000]]
    got = decoded(spark, [*whole, *bad, whole[0]])
    assert all((one == pixels).all() for one in [*got[:len(whole)], got[-1]])
    assert got[len(whole):-2] == [PX.UNREADABLE] * (len(bad) - 1)
    # a file cut in its last rows is either refused or keeps its size
    assert isinstance(got[-2], str) or got[-2].shape == (90, 90, 3)


def test_jpeg_bytes_of_a_column(spark, tmp_path):
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(32, 16, 1)
    for x in range(32):
        for y in range(16):
            image.setRGB(x, y, 0xC81E0A)
    path = tmp_path / "red.jpg"
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))
    red, = decoded(spark, [path.read_bytes()])
    assert red.shape == (16, 32, 3) and abs(red.astype(int) - [200, 30, 10]).max() <= 6


def test_decoding_keeps_rows_and_columns(spark):
    one = P.encode_png(picture(4, 4))
    frame = spark.createDataFrame([(1, one, "old"), (1, one, "old"), (None, None, "old")], "k int, raw binary, pixels string")
    got = PX.decode_rgb(frame, "raw")
    assert got.columns == ["k", "raw", "pixels"] and sorted(r.k or 0 for r in got.where("pixels.error is null").collect()) == [1, 1]
    for none in (frame.limit(0), frame.where("raw is null")):
        assert PX.decode_rgb(none, "raw").where("pixels.error is null").count() == 0
    assert PX.decode_rgb(frame.where("raw is null"), "raw").count() == 1


def test_resize():
    flat = np.full((10, 20, 3), 77, np.uint8)
    for kernel in P.FILTERS:
        assert (P.resize(flat, 7, 31, kernel) == 77).all()
    same = picture(16, 16)
    assert (P.resize(same, 16, 16) == same).all()
    # halving with a widened triangle: weights 1 3 3 1 over 8 inside the picture
    line = np.zeros((1, 8, 3), np.uint8)
    line[0, :, :] = np.array([0, 80, 160, 240, 0, 0, 0, 0])[:, None]
    assert P.resize(line, 4, 1)[0, 1, 0] == int((80 + 3 * 160 + 3 * 240 + 0) / 8 + 0.5)


@pytest.mark.parametrize("size", [(64, 48), (48, 64), (50, 50), (300, 217), (513, 100)])
def test_letterbox_pixels_agree_with_the_geometry(spark, size):
    canvas, scale, pad_x, pad_y = P.letterbox(picture(*size), 256)
    got = G.letterbox_params(F.lit(size[0]), F.lit(size[1]))
    row = spark.range(1).select(*[c.alias(n) for n, c in got.items()]).first()
    assert (row.scale, row.pad_x, row.pad_y) == (scale, pad_x, pad_y)
    left, top = round(pad_x * 256), round(pad_y * 256)
    outside = canvas.copy()
    outside[top : top + row.new_h, left : left + row.new_w] = 0
    assert not outside.any()


def test_normalize():
    white = P.normalize(np.full((2, 2, 3), 255, np.uint8)).reshape(3, 4)
    assert white[:, 0] == pytest.approx([(1 - m) / s for m, s in zip(P.MEAN, P.STD)], rel=1e-6)


def test_painted_boxes():
    out = P.paint_boxes(np.zeros((20, 20, 3), np.uint8), [(2, 3, 12, 13), (-5, -5, 50, 50)], (0, 255, 0), 3)
    assert out[3, 2, 1] == out[5, 7, 1] == out[13, 12, 1] == out[11, 12, 1] == 255
    assert out[8, 7, 1] == 0 and not out[:, :, 0].any()


def frame_of(spark, images):
    return PX.decode_rgb(S.rows_to_frame(spark, images), "image_bytes").drop("image_bytes")


def test_bad_images_become_error_rows(spark):
    images = [("ok.png", P.encode_png(picture(40, 30))), ("bad.png", b"xx"), ("strip.png", P.encode_png(picture(600, 1)))]
    rows = {r.filename: r for r in S.run_scoring(frame_of(spark, images), make_stub, "run", 0.1).collect()}
    assert rows["ok.png"].status == "success" and rows["ok.png"].nb_plates == len(rows["ok.png"].detections) > 0
    assert rows["bad.png"].status == "error: cannot identify image file" and rows["bad.png"].detections == []
    assert rows["strip.png"].status == "error: image cannot be resized" and not rows["strip.png"].success


def test_scoring_equals_one_image_at_a_time(spark):
    from boxlake.operators.detections import keep_greedily, ranked_boxes

    pixels = picture(80, 50, seed=3)
    row = S.run_scoring(frame_of(spark, [("a.png", P.encode_png(pixels))]), make_stub, None, 0.3).first()
    canvas, _, pad_x, pad_y = P.letterbox(pixels, 256)
    raw = make_stub()(P.normalize(canvas).reshape(1, 3, 256, 256))
    ids, scores, cells = ranked_boxes(raw["logits"].astype(float).reshape(-1, 2), raw["deltas"].astype(float).reshape(-1, 4), 0.3)
    kept = keep_greedily(cells, np.array([0, len(ids)]), 0.4, 100)[0]
    assert row.scores == pytest.approx(scores[kept].tolist(), rel=1e-5)
    x1 = [int(np.clip((v - pad_x) / (1 - 2 * pad_x), 0, 1) * 80) for v in cells[0][kept]]
    y2 = [int(np.clip((v - pad_y) / (1 - 2 * pad_y), 0, 1) * 50) for v in cells[3][kept]]
    assert max(abs(d.x_min - v) for d, v in zip(row.detections, x1)) <= 1
    assert max(abs(d.y_max - v) for d, v in zip(row.detections, y2)) <= 1


def test_annotation_and_payload(spark):
    scored = spark.createDataFrame([("a", [(0.5, 1, 30, 9, 39)])], "filename string, detections array<struct<confidence:double,x_min:int,y_min:int,x_max:int,y_max:int>>")
    plan = PX.annotate_plan(scored).first()
    assert (plan.label, plan.label_y, plan.box_color) == ("Plate 1: 0.50", 10, "#00FF00")
    close = [0.115, 0.125, 0.145, 0.375, 0.995, 0.5, 1.0]
    told = PX.annotate_plan(spark.createDataFrame([([(c, 1, 2, 3, 4) for c in close],)], scored.select("detections").schema))
    assert [r.label for r in told.orderBy("number").collect()] == [f"Plate {i}: {c:.2f}" for i, c in enumerate(close, 1)]
    images = frame_of(spark, [("a", P.encode_png(picture(40, 60)))]).join(scored, "filename")
    row = images.select(PX.paint_boxes(F.col("pixels"), F.col("detections")).alias("png")).select(
        "png", PX.base64_payload(F.col("png")).alias("b64")).first()
    assert tuple(decoded(spark, [bytes(row.png)])[0][30, 1]) == (0, 255, 0)
    import base64
    assert base64.b64decode(row.b64) == bytes(row.png) and "\n" not in row.b64


@pytest.fixture()
def tree(tmp_path):
    """Below a folder called like a split; names with a blank and a plus; one name in two splits."""
    root = tmp_path / "test" / "data"
    for split in ("train", "valid"):
        for kind in ("images", "labels"):
            (root / split / kind).mkdir(parents=True)
    images = {("train", "a b+c"): (64, 48), ("train", "both"): (48, 64), ("valid", "both"): (50, 50), ("valid", "bare"): (33, 20)}
    for n, ((split, name), size) in enumerate(images.items()):
        (root / split / "images" / f"{name}.jpg").write_bytes(P.encode_png(picture(*size, seed=n)))
    (root / "train" / "images" / "broken.jpg").write_bytes(b"not an image")
    (root / "train" / "labels" / "a b+c.txt").write_text("0 0.5 0.5 0.2 0.1\n0 0.1 0.1 0.1 0.1\n\n")
    (root / "train" / "labels" / "both.txt").write_text("0 0.5 0.5 0.2 0.2\n")
    (root / "train" / "labels" / "orphan.txt").write_text("0 0.5 0.5 0.2 0.2\n")
    return root


def test_scans(spark, tree):
    images = {(r.split_name, r.image_name, r.split_id) for r in files.scan_images(spark, str(tree)).collect()}
    assert images == {("train", "a b+c", 0), ("train", "both", 0), ("train", "broken", 0), ("valid", "both", 1), ("valid", "bare", 1)}
    lines = {(r.split_name, r.image_name) for r in files.scan_label_lines(spark, str(tree)).collect()}
    assert lines == {("train", "a b+c"), ("train", "both"), ("train", "orphan")}
    decoded = {(r.split_name, r.image_name): r.image.height for r in files.scan_image_pixels(spark, str(tree)).collect()}
    assert decoded[("train", "a b+c")] == 48 and decoded[("train", "broken")] == -1


def test_image_source_channels(spark, tree):
    row = files.scan_image_pixels(spark, str(tree)).where("image_name = 'a b+c'").select(
        PX.pixels_of_image_source(F.col("image")).alias("p")).first()
    assert np.frombuffer(row.p.rgb, np.uint8).reshape(48, 64, 3).tolist() == picture(64, 48, seed=0).tolist()


def test_preprocess_end_to_end(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    preprocess.preprocess(spark, str(tree), out)
    rows = {(r.split_name, r.image_name): r for r in files.read_training_table(spark, f"{out}/images").collect()}
    assert set(rows) == {("train", "a b+c"), ("train", "both"), ("valid", "both"), ("valid", "bare")}
    boxes = {}
    for r in files.read_training_table(spark, f"{out}/boxes").collect():
        boxes.setdefault((r.split_name, r.image_name), []).append(r)
    assert set(boxes) == set(rows) and len(boxes[("train", "a b+c")]) == 2 and boxes[("valid", "both")][0].cx is None
    box = boxes[("train", "both")][0]
    assert [box.cx, box.cy, box.w, box.h] == pytest.approx([0.5, 0.5, 0.2 * 0.75, 0.2])
    stored, = decoded(spark, [bytes(rows[("train", "both")].images)])
    assert (stored == P.letterbox(picture(48, 64, seed=1), 256)[0]).all()
    with pytest.raises(Exception):
        files.read_training_table(spark, str(tmp_path / "missing"))


def test_inbox_stream_scores_each_file_once(spark, tmp_path):
    folder, history, state = tmp_path / "inbox", str(tmp_path / "history"), str(tmp_path / "state")
    folder.mkdir()
    schema = "image_name string, nb_plates int, status string, original_image_path string"

    def drain():
        inbox.score_inbox_stream(spark, str(folder), make_stub, history, state, score_threshold=0.1).awaitTermination()
        return sorted((r.image_name, r.status) for r in sinks.read_history(spark, history, schema).collect())

    (folder / "a b.png").write_bytes(P.encode_png(picture(40, 30)))
    (folder / "bad.png").write_bytes(b"nothing")
    first = drain()
    assert first == [("a b.png", "success"), ("bad.png", "error: cannot identify image file")]
    assert drain() == first
    (folder / "late.png").write_bytes(P.encode_png(picture(30, 30)))
    assert drain() == [*first, ("late.png", "success")]


def test_two_streams_keep_their_rows_and_a_batch_its_time(spark, tmp_path):
    history, schema = str(tmp_path / "history"), "timestamp timestamp, image_name string, original_image_path string"
    for name in ("one", "two"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / f"{name}.png").write_bytes(P.encode_png(picture(20, 20)))
        state = str(tmp_path / f"state-{name}")
        inbox.score_inbox_stream(spark, str(folder), make_stub, history, state, score_threshold=0.1).awaitTermination()
    rows = sinks.read_history(spark, history, schema).collect()
    assert {r.image_name for r in rows} == {"one.png", "two.png"} and len({r.original_image_path for r in rows}) == 2
    planned = spark.range(1).select(inbox.batch_time(spark, str(tmp_path / "state-one"), 0)).first()[0]
    assert planned in {r.timestamp for r in rows}


def test_late_rows_of_a_stream_are_not_counted(spark, tmp_path):
    source, counts, state = (str(tmp_path / n) for n in ("source", "counts", "state"))
    schema = "timestamp timestamp_ntz, nb_plates int, status string"

    def arrive(*hours):
        rows = ", ".join(f"(timestamp_ntz'2001-01-01 {h:02d}:30:00', 1, 'success')" for h in hours)
        spark.sql(f"select * from values {rows} as t(timestamp, nb_plates, status)").write.mode("append").parquet(source)
        inbox.drain_to_table(inbox.hourly_counts(spark.readStream.schema(schema).parquet(source), "2 hours"), counts, state)

    for hours in ((1, 5), (4, 9), (1, 8)):  # the row of 01:30 comes when hours before 07:30 are closed
        arrive(*hours)
    got = {r.hour.hour: r.n_predictions for r in inbox.latest_counts(spark, counts).collect()}
    assert got == {1: 1, 4: 1, 5: 1, 8: 1, 9: 1}
    assert {r.hour.hour: r.n_predictions for r in H.hourly_predictions(spark.read.parquet(source)).collect()}[1] == 2


def test_jpeg_files_decode_on_the_jvm(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    image = jvm.java.awt.image.BufferedImage(20, 10, 1)
    for x in range(20):
        for y in range(10):
            image.setRGB(x, y, 0xFF0000)
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(tmp_path / "red.jpg")))
    row = files.scan_inbox_pixels(spark, str(tmp_path)).select("filename", PX.pixels_of_image_source(F.col("image")).alias("p")).first()
    red = np.frombuffer(row.p.rgb, np.uint8).reshape(10, 20, 3)
    assert row.filename == "red.jpg" and red[5, 10, 0] > 240 and red[5, 10, 2] < 15


def test_artifact_files(spark, tmp_path):
    rows = [("images/runs/r/a_orig.jpg", b"one"), ("images/b.jpg", b"two"), ("../c", b"three"), ("d", None)]
    frame = spark.createDataFrame(rows, "path string, content binary")
    for _ in range(2):
        assert sinks.write_artifact_files(frame.limit(2), str(tmp_path / "base")) == 2
    for n in (2, 3):
        with pytest.raises(ValueError):
            sinks.write_artifact_files(spark.createDataFrame(rows[:2] + rows[n:n + 1], frame.schema), str(tmp_path / "base"))
    found = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    assert found == {"base/images/runs/r/a_orig.jpg": b"one", "base/images/b.jpg": b"two"}


def test_names_and_run_ids(spark):
    from datetime import datetime

    frame = S.name_in_memory_batch(spark.range(2).withColumnRenamed("id", "ordinal"))
    assert [r.filename for r in frame.orderBy("ordinal").collect()] == ["img_0.jpg", "img_1.jpg"]
    assert S.run_id(datetime(2026, 3, 4, 5, 6, 7), "abcdef99") == "20260304_050607_abcdef"


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"{k}.png").write_bytes(P.encode_png(picture(2, 2, k)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        assert files.scan_inbox_pixels(spark, str(tmp_path)).rdd.getNumPartitions() == 4
        assert files.scan_artifacts(spark, str(tmp_path)).rdd.getNumPartitions() == 4
        rows = spark.createDataFrame([(k, P.encode_png(picture(2, 2, k))) for k in range(40)], "k int, content binary")
        assert PX.decode_rgb(rows).where("pixels.width = 2").count() == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_canvases_and_tensors_leave_in_slices(spark):
    """A batch of pictures of a few bytes; every result is that of the picture beside it."""
    import pyarrow as pa

    batch = pa.array(range(1000))
    sizes = [len(part) for part in PX._slices([batch, batch[:0], batch[:5]])]
    assert sum(sizes) == 1005 and max(sizes) <= 16
    rows = spark.createDataFrame([(k, bytes([k] * 12) if k % 5 else b"no picture") for k in range(60)], "k int, cells binary").coalesce(1)
    good = F.col("k") % 5 != 0
    pixels = F.struct(F.lit(2).alias("width"), F.lit(2).alias("height"), F.when(good, F.col("cells")).alias("rgb"), F.lit(None).cast("string").alias("error"))
    fitted = rows.select("k", pixels.alias("pixels")).withColumn("image", PX.letterbox_resize(F.col("pixels"), 8)["image"])
    for r in fitted.withColumn("tensor", PX.normalize_tensor(F.col("image"), 8)).collect():
        assert r.image == (bytes([r.k]) * 192 if r.k % 5 else None)
        assert (r.tensor is None) == (r.k % 5 == 0) and (r.k % 5 == 0 or abs(r.tensor[0] - (r.k / 255 - 0.485) / 0.229) < 1e-5)


def test_files_of_a_trigger_are_looked_up_by_few_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for k in range(40):
        (tmp_path / "in" / f"{k}.png").write_bytes(P.encode_png(picture(2, 2, k)))
    before, seen = spark.conf.get(inbox.LISTING_KEY), []
    monkeypatch.setattr(inbox, "append_history", lambda rows, *_: seen.append((rows.sparkSession.conf.get(inbox.LISTING_KEY), rows.count())))
    inbox.score_inbox_stream(spark, str(tmp_path / "in"), make_stub, str(tmp_path / "out"), str(tmp_path / "state"), score_threshold=0.5).awaitTermination()
    assert seen == [("4", 40)] and spark.conf.get(inbox.LISTING_KEY) == before
