import base64
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.functions import text
from boxlake.operators import history as H
from boxlake.operators import runs as R
from boxlake.plans import migrate
from boxlake.sources import files, sinks

JPEG, OTHER = (base64.b64encode(b"\xff\xd8\xff\xe0" + fill * 200_000).decode() for fill in (b"x", b"y"))
OLD = f'''timestamp,image_name,nb_plates,detections,status,annotated_image
1999-12-31T23:59:58.5,a.jpg,1,"[{{'confidence': 0.25, 'x_min': 10, 'y_min': 20, 'x_max': 30, 'y_max': 40}}]",success,{JPEG}
1999-12-31T23:59:58.7,f.jpg,0,[],success,{OTHER}
2001-02-03T04:05:06.25,b.jpg,0,[],success,images/x/orig.jpg,images/x/ann.jpg
2001-02-03T04:05:07,c.jpg,0,[],"error: bad ""quote"", and
a line break",images/y/orig.jpg,
nonsense,d.jpg,0,[],success,%%%
never,e.jpg,0,[],success,{JPEG}
'''


@pytest.fixture()
def old(spark, tmp_path):
    (tmp_path / "history.csv").write_text(OLD)
    return files.scan_history_rows(spark, str(tmp_path / "history.csv"))


def test_mixed_width_rows_and_migration(old):
    history, artifacts = H.migrate_history(old)
    rows = {r.image_name: r for r in history.collect()}
    assert re.fullmatch("images/runs/migrated_19991231_235958/migrated_[0-9a-f]{16}_ann.jpg", rows["a.jpg"].annotated_image_path)
    assert rows["f.jpg"].annotated_image_path != rows["a.jpg"].annotated_image_path
    assert (rows["b.jpg"].original_image_path, rows["b.jpg"].annotated_image_path) == ("images/x/orig.jpg", "images/x/ann.jpg")
    assert rows["c.jpg"].status.endswith("a line break") and rows["c.jpg"].original_image_path == "images/y/orig.jpg"
    assert rows["d.jpg"].annotated_image_path == ""
    assert rows["e.jpg"].annotated_image_path.startswith("images/runs/migrated_migrated/migrated_")
    stored = {r.path: base64.b64encode(bytes(r.content)).decode() for r in artifacts.collect()}
    assert stored == {rows[n].annotated_image_path: c for n, c in (("a.jpg", JPEG), ("f.jpg", OTHER), ("e.jpg", JPEG))}


def test_migration_job(spark, tmp_path):
    source, out, base, backup = (str(tmp_path / n) for n in ("history.csv", "new", "base", "backup.csv"))
    assert migrate.migrate(spark, source, out, base, backup) == "missing"
    (tmp_path / "history.csv").write_text(OLD)
    for _ in range(2):
        assert migrate.migrate(spark, source, out, base, backup) == "migrated"
        back = files.scan_history(spark, out)
        assert back.count() == 6 and (tmp_path / "backup.csv").read_text() == OLD
    found = H.resolve_artifacts(back, files.scan_artifacts(spark, base), "annotated_image_path")
    assert {r.image_name for r in found.where("content is not null").collect()} == {"a.jpg", "e.jpg", "f.jpg"}
    for header, told in (("timestamp,annotated_image_path", "current"), ("a,b", "unknown")):
        (tmp_path / "other.csv").write_text(header + "\n")
        assert migrate.migrate(spark, str(tmp_path / "other.csv"), out, base, backup) == told


def test_needs_migration():
    assert H.needs_migration(["timestamp", "annotated_image"])
    assert not H.needs_migration(["annotated_image_path"]) and not H.needs_migration(["other"])


def test_typed_history_and_detections(spark, tmp_path):
    (tmp_path / "history.csv").write_text(OLD)
    typed = files.scan_history(spark, str(tmp_path / "history.csv"))
    rows = {r.image_name: r for r in H.parsed_history(typed).collect()}
    assert rows["a.jpg"].nb_plates == 1 and rows["d.jpg"].timestamp is None
    assert rows["a.jpg"].detections[0].asDict() == {"confidence": 0.25, "x_min": 10, "y_min": 20, "x_max": 30, "y_max": 40}
    assert rows["b.jpg"].detections == []
    exploded = H.explode_detections(H.parsed_history(typed))
    assert exploded.count() == 6 and exploded.where("x_min is not null").count() == 1


def test_literal_round_trip(spark):
    stored = "[{'confidence': 0.5, 'x_min': 1, 'y_min': 2, 'x_max': 3, 'y_max': 4}, {'confidence': 0.25, 'x_min': 5, 'y_min': 6, 'x_max': 7, 'y_max': 8}]"
    row = spark.range(1).select(text.parse_detections(F.lit(stored)).alias("d")).select(
        text.detections_literal(F.col("d")), text.from_detections_json(text.detections_json(F.col("d"))) == F.col("d")
    ).first()
    assert list(row) == [stored, True]
    assert spark.range(1).select(text.parse_detections(F.lit("no list"))).first()[0] in (None, [None])


SCHEMA = "timestamp timestamp_ntz, image_name string, nb_plates int"


def test_append_replay_and_purge(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' as timestamp, 'a' as image_name, 1 as nb_plates")
    for writer, batch in (("a", 0), ("a", 1), ("a", 1), ("b", 0)):
        sinks.append_history(rows, path, writer, batch)
    assert sinks.read_history(spark, path, SCHEMA).count() == 3
    sinks.purge_history(spark, path, SCHEMA)
    assert sinks.read_history(spark, path, SCHEMA).count() == 0


def test_csv_round_trip(spark, tmp_path):
    detections = "[{'confidence': 0.5, 'x_min': 1, 'y_min': 2, 'x_max': 3, 'y_max': 4}]"
    rows = spark.createDataFrame(
        [("a, \"b\".jpg", 1, detections, "error: x\ny", "", "")],
        "image_name string, nb_plates int, detections string, status string, original_image_path string, annotated_image_path string",
    ).withColumn("timestamp", F.lit("2026-01-01 00:00:00.5").cast("timestamp"))
    rows = rows.select("timestamp", *rows.columns[:-1])
    sinks.append_history_csv(rows, str(tmp_path / "csv"))
    sinks.append_history_csv(rows, str(tmp_path / "csv"))
    back = files.scan_history(spark, str(tmp_path / "csv")).collect()
    assert len(back) == 2
    assert (back[0].image_name, back[0].status, back[0].detections) == ("a, \"b\".jpg", "error: x\ny", detections)


def test_uploads(spark):
    rows = [(0, "up/a.jpg", "image/jpeg", 1), (1, "other/a.jpg", "image/png", 2), (2, "b.txt", "text/plain", 3),
            (3, None, "image/jpeg", 4), (4, "c.jpg", None, 5)]
    frame = spark.createDataFrame(rows, "seq int, filename string, content_type string, body int")
    assert {r.filename: r.body for r in H.upload_filter(frame).collect()} == {"a.jpg": 2, "img_3.jpg": 4}
    with pytest.raises(ValueError):
        H.require_images(H.upload_filter(frame.where("seq = 2")))


def test_resolve_artifacts(spark):
    history = spark.createDataFrame([(1, "images/a"), (2, "images/missing"), (3, "../images/a"), (4, ""), (5, None)], "n int, original_image_path string")
    stored = spark.createDataFrame([("images/a", "A"), ("../images/a", "B"), ("", "C")], "path string, content string")
    assert {r.n: r.content for r in H.resolve_artifacts(history, stored).collect()} == {1: "A", 2: None, 3: None, 4: None, 5: None}


def test_history_view_defaults_and_limits(spark):
    rows = spark.sql("select timestamp_ntz'2026-01-01 00:00:00.7' as timestamp, cast(null as string) as image_name, "
                     "cast(null as int) as nb_plates, cast(null as string) as status, cast(null as string) as detections")
    row = H.history_view(rows).first()
    assert (row.filename, row.nb_plates, row.status, row.detections) == ("", 0, "unknown", "[]")
    assert row.datetime.microsecond == 0
    with pytest.raises(ValueError):
        H.check_service_limit(101)


def loop(losses, patience=10):
    best, bad, best_flags, stop = float("inf"), 0, [], None
    for epoch, loss in enumerate(losses, 1):
        best_flags.append(loss < best)
        best, bad = (loss, 0) if loss < best else (best, bad + 1)
        if bad >= patience and stop is None:
            stop = epoch
    return best_flags, stop


def lr_loop(losses, start=1e-3):
    best, bad, lr, out = float("inf"), 0, start, []
    for loss in losses:
        if loss < best * (1 - 1e-4):
            best, bad = loss, 0
        else:
            bad += 1
        if bad > 5:
            lower = max(lr * 0.5, 1e-6)
            lr = lower if lr - lower > 1e-8 else lr
            bad = 0
        out.append(lr)
    return out


@pytest.fixture(scope="module")
def runs():
    import numpy as np

    rng = np.random.default_rng(8)
    out = {k: rng.random(n).tolist() for k, n in enumerate((1, 5, 30, 80, 200))}
    out[10] = [1.0] * 150  # never improves, reaches the floor
    out[11] = [1.0 - i * 1e-5 for i in range(60)]  # strict minima that are no improvement for the schedule
    out[12] = [1.0 - i * 0.01 for i in range(120)]  # falls below zero
    out[13] = [-1.0, -0.99995, -0.5, -1.2] * 8
    return out


def log_of(spark, runs):
    rows = [(k, e, v) for k, losses in runs.items() for e, v in enumerate(losses, 1)]
    return spark.createDataFrame(rows, "run_id int, epoch int, val_loss double")


def test_best_epochs_across_blocks(spark, runs):
    log = log_of(spark, runs)
    for block in (7, 10_000):
        got = R.with_best_before(log, block)
        flags = got.withColumn("b", F.col("best_before").isNull() | (F.col("val_loss") < F.col("best_before")))
        by_run = {}
        for r in flags.orderBy("run_id", "epoch").collect():
            by_run.setdefault(r.run_id, []).append(r.b)
        assert by_run == {k: loop(v)[0] for k, v in runs.items()}


def test_early_stop(spark, runs):
    got = {r.run_id: r.stop_epoch for r in R.early_stop(log_of(spark, runs)).collect()}
    assert got == {k: loop(v)[1] for k, v in runs.items()}


def test_plateau_lr(spark, runs):
    got = {}
    for r in R.plateau_lr(log_of(spark, runs)).orderBy("run_id", "epoch").collect():
        got.setdefault(r.run_id, []).append(r.lr)
    assert got == {k: lr_loop(v) for k, v in runs.items()}


def test_epoch_log_format(spark, tmp_path):
    names = ("train_loss", "train_cls_loss", "train_reg_loss", "val_loss", "val_cls_loss", "val_reg_loss")
    row = spark.range(1).select(F.lit(3).alias("epoch"), *[F.lit(1.23456789).alias(n) for n in names],
                                F.lit(0.000123456789).alias("lr"), F.lit("t").alias("timestamp"))
    assert (sinks.epoch_log_rows(row).first().train_loss, sinks.epoch_log_rows(row).first().lr) == ("1.234568", "0.00012346")
    sinks.append_epoch_log(row, str(tmp_path / "log"))
    assert files.scan_epoch_log(spark, str(tmp_path / "log")).first().val_loss == 1.234568


def test_plateau_lr_of_a_long_run_through_a_tree_of_minima(spark, monkeypatch):
    monkeypatch.setattr(R, "FAN", 4)
    rng = np.random.default_rng(3)
    runs = {
        1: (1.0 / np.arange(1, 900)).tolist(), 2: rng.random(300).tolist(), 3: (rng.random(300) - 0.5).tolist(),
        4: [float("nan"), 0.5, float("inf"), 0.4, float("nan")] * 20, 5: [float("inf")] * 3,
    }
    log = log_of(spark, runs)
    got = {}
    for r in R.plateau_lr(log.where("run_id < 5")).orderBy("run_id", "epoch").collect():
        got.setdefault(r.run_id, []).append(r.lr)
    assert {k: got[k] for k in (1, 2, 3)} == {k: lr_loop(runs[k]) for k in (1, 2, 3)}
    rows = log.where("run_id in (2, 3)")
    later = R.first_later_below(rows, rows.select("run_id", "epoch", (F.col("val_loss") * 0.9).alias("bound"))).collect()
    want = {
        (k, e): next((f for f in range(e + 1, 301) if runs[k][f - 1] < runs[k][e - 1] * 0.9), None) for k in (2, 3) for e in range(1, 301)
    }
    assert {(r.run_id, r.epoch): r.later for r in later} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("cut", [40, 97, 128 << 20])
def test_csv_is_read_in_splits_wherever_it_is_cut(spark, tmp_path, cut):
    rng = np.random.default_rng(cut)
    pieces = ["plain", "a, b", 'say ""hi""', "two\nlines", "\n", '""', "three\n\nlines, and ""quotes""", "x" * 200, "", "1,2\r\n3"]
    for n in range(3):
        lines = ["timestamp,image_name,nb_plates,detections,status,original_image_path,annotated_image_path"]
        for i in range(60):
            fields = [f"t{n}_{i}"] + [pieces[rng.integers(len(pieces))].replace('"', '""') for _ in range(5 + i % 2)]
            lines.append(",".join(f'"{f}"' if set(f) & set(',"\n\r') or i % 3 else f for f in fields))
        (tmp_path / f"part-{n}.csv").write_text("\n".join(lines) + ("\n" if n else ""), newline="")
    (tmp_path / "empty.csv").write_text("")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = files.scan_history_rows(spark, str(tmp_path))
        rows = sorted(got.collect(), key=str)
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    whole = spark.read.schema(files.HISTORY_CSV).options(header=True, multiLine=True, escape='"').csv(str(tmp_path)).collect()
    assert rows == sorted(whole, key=str) and len(rows) == 180
    assert cut > 1000 or tasks > 3
