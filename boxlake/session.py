"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the plans are tuned for; all are ordinary Spark settings and any
# session that lacks them still gives the same results.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(app_name: str = "boxlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the recommended settings; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of a session, once.

    Arrow functions need it there; a cluster that has it installed can do without.
    """
    context = spark.sparkContext
    if not getattr(context, "_boxlake_shipped", False):
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="boxlake-")) / "boxlake.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._boxlake_shipped = True
    return spark


# Bytes of the Arrow batches that rows travel to Python in; a task holds a few of them at once.
BATCH_BYTES_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches at BATCH_BYTES or less, for rows that carry pictures or whole predictions.

    The bound is a setting of the session and stays; a smaller one of the session is left alone.
    """
    held = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES_KEY))
    if not 0 < held <= BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


def session_with(spark: SparkSession, values: dict[str, str]) -> SparkSession:
    """A session of the same context with the same settings but these; `spark` keeps its own."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in values.items():
        own.conf.set(key, value)
    return own


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    """The scratch folder of this process, for local sessions without a configured one; it goes when the process ends."""
    base = tempfile.mkdtemp(prefix="boxlake-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint folder of the session.

    The cluster names the folder in `spark.checkpoint.dir`. Only a local session
    may fall back to the temp folder of this machine: executors elsewhere could
    not read it back.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: its rows stay as they are and its size is known."""
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
