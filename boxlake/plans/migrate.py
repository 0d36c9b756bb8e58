"""Migration job: a history of the old layout to the new one, its images to files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from boxlake.operators import history as H
from boxlake.sources import files, sinks


def migrate(spark: SparkSession, source: str, out: str, base: str, backup: str) -> str:
    """Move the history CSV `source` to `out` and its images below `base`; says what was done.

    `missing`, `current` (the new header) and `unknown` (neither header) leave everything as it is. `migrated` keeps a
    copy of the source at `backup`, taken before anything is written. Running it again replaces the same results.
    """
    paths = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    place, kept = paths.Path(source), paths.Path(backup)
    store = place.getFileSystem(conf)
    if not store.exists(place):
        return "missing"
    first = spark.read.text(source).first()
    header = [] if first is None else first[0].strip().split(",")
    if not H.needs_migration(header):
        return "current" if "annotated_image_path" in header else "unknown"
    paths.FileUtil.copy(store, place, kept.getFileSystem(conf), kept, False, conf)
    history, artifacts = H.migrate_history(files.scan_history_rows(spark, source))
    sinks.write_artifact_files(artifacts, base)
    # rows whose time does not parse keep their place with an empty one
    typed = history.withColumn("timestamp", F.try_to_timestamp("timestamp"))
    sinks.append_history_csv(typed, out, mode="overwrite")
    return "migrated"
