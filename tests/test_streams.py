"""Streams with state and newest history: parts fed one after the other, with a restart before each."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.operators import history as H
from boxlake.operators import runs as R
from boxlake.sources import sinks
from boxlake.streaming import runs as followed
from boxlake.streaming import uploads as U

SCHEMA = "timestamp timestamp_ntz, event_id long, nb_plates int"


def history_rows(spark, *rows):
    return spark.createDataFrame(rows, "t string, event_id long, nb_plates int").select(
        F.col("t").cast("timestamp_ntz").alias("timestamp"), "event_id", "nb_plates"
    )


def spoil(path, writer, batch):
    """Make the stored rows of a batch unreadable."""
    for file in (path / f"writer={writer}" / f"batch_id={batch}").glob("part-*.parquet"):
        file.write_bytes(b"no parquet")


def test_newest_history_leaves_old_batches_closed(spark, tmp_path):
    path = str(tmp_path)
    for n in range(6):
        sinks.append_history(history_rows(spark, *[(f"2026-01-0{n + 1} 0{k}:00:00", 10 * n + k, k) for k in range(5)]), path, "ab"[n % 2], n)
    sinks.append_history(history_rows(spark, (None, 900, 7), ("2026-01-04 02:00:00", 901, 7)), path, "b", 7)
    whole = sinks.read_history(spark, path, SCHEMA)
    for limit in (1, 5, 7, 13, 14, 31, 32, 500):
        near = sinks.read_newest_history(spark, path, SCHEMA, limit)
        # among equal times and among missing times the order is by event
        assert [r.event_id for r in H.latest_history(near, limit).collect()] == [r.event_id for r in H.latest_history(whole, limit).collect()]
        assert H.history_stats(near, limit).first() == H.history_stats(whole, limit).first()
    for n in range(3):
        spoil(tmp_path, "ab"[n % 2], n)
    near = sinks.read_newest_history(spark, path, SCHEMA, 7)
    assert [r.event_id for r in H.latest_history(near, 7).collect()] == [54, 53, 52, 51, 50, 44, 43]
    with pytest.raises(Exception, match="batch_id="):
        H.latest_history(sinks.read_history(spark, path, SCHEMA), 7).collect()


def test_newest_history_after_failures_and_replays(spark, tmp_path):
    path = str(tmp_path)
    old, new = history_rows(spark, *[(f"2026-01-01 00:00:0{k}", k, 1) for k in range(9)]), history_rows(spark, ("2026-02-01 00:00:00", 50, 2))
    sinks.append_history(old, path, "w", 0)
    sinks.append_history(new, path, "w", 1)

    def newest(n):
        return [r.event_id for r in H.latest_history(sinks.read_newest_history(spark, path, SCHEMA, n), n).collect()]

    assert newest(1) == [50]
    with pytest.raises(Exception):  # the write fails after the entry is made; what lies there is read
        sinks.append_history(new.withColumn("nb_plates", F.raise_error(F.lit("lost")).cast("int")), path, "w", 2)
    assert newest(2) == [50, 8]
    sinks.append_history(history_rows(spark, ("2025-01-01 00:00:00", 1, 1)), path, "w", 1)  # replaced by an older row
    assert newest(2) == [8, 7]
    sinks.append_history(history_rows(spark), path, "w", 3)
    assert newest(20) == [8, 7, 6, 5, 4, 3, 2, 1, 0, 1]
    sinks.append_history(new, path, "w", 4, time=None)
    sinks.index_history(spark, path, SCHEMA)
    assert newest(2) == [50, 8]


def test_newest_history_after_a_purge(spark, tmp_path):
    path = str(tmp_path)
    sinks.append_history(history_rows(spark, ("2026-01-01 00:00:00", 1, 1)), path, "w", 0)
    sinks.purge_history(spark, path, SCHEMA)
    assert sinks.read_newest_history(spark, path, SCHEMA, 5).count() == 0
    sinks.append_history(history_rows(spark, ("2026-01-02 00:00:00", 2, 1)), path, "w", 1)
    for limit in (1, 5):
        assert [r.event_id for r in sinks.read_newest_history(spark, path, SCHEMA, limit).collect()] == [2]


def test_runs_are_followed_over_restarts(spark, tmp_path):
    rng = np.random.default_rng(5)
    losses = {k: rng.random(n).tolist() for k, n in enumerate((1, 9, 30, 80, 200))} | {
        7: [1.0] * 40, 8: [float("nan"), 0.5, float("nan"), 0.4] * 10, 9: (1.0 / np.arange(1, 120)).tolist(),
    }
    rows = [(k, e, v) for k, vs in losses.items() for e, v in enumerate(vs, 1)]
    log = spark.createDataFrame(rows, "run_id int, epoch int, val_loss double")
    source, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    for part in ("epoch <= 12", "epoch > 12 and epoch <= 23", "epoch > 23", "false"):
        log.where(part).orderBy(F.rand(1)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        followed.store_decisions(followed.follow_runs(stream), out, state).awaitTermination()
    got = spark.read.parquet(out)
    flags = ["run_id", "epoch", "is_best"]
    assert sorted(got.select(flags).collect()) == sorted(R.best_epoch(log).select(flags).collect())
    assert sorted(followed.stops(got).collect(), key=str) == sorted(R.early_stop(log).collect(), key=str)


def test_one_name_in_two_triggers_is_stored_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("source", "out", "state"))
    schema = "seq int, filename string, content_type string, body string, arrived timestamp"
    parts = [
        [(1, "up/a.jpg", "image/jpeg", "a1", 0), (2, "b.jpg", "image/jpeg", "b1", 1), (3, "", "image/png", "c", 1), (4, "n.txt", "text/plain", "n", 1)],
        [(6, "other/a.jpg", "image/png", "a3", 4), (5, "a.jpg", "image/jpeg", "a2", 3)],
        [(7, "b.jpg", "image/jpeg", "b2", 40)],
        [(8, "a.jpg", "image/jpeg", "late", 1), (9, "end", "image/jpeg", "end", 90)],
        [(10, "end", "image/jpeg", "end", 95)],
    ]
    for part in parts:
        rows = spark.createDataFrame(part, "seq int, filename string, content_type string, body string, minute int")
        stamped = rows.withColumn("arrived", F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("minute"))).drop("minute")
        stamped.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        U.store_settled(U.settled_uploads(stream, "10 minutes", "5 minutes"), out, state).awaitTermination()
    got = sorted((r.filename, r.body) for r in spark.read.parquet(out).collect())
    assert got == [("a.jpg", "a3"), ("b.jpg", "b1"), ("b.jpg", "b2"), ("img_3.jpg", "c")]
