"""Helpers shared by the corpus operators: scratch tables, row places, text folding."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.session import scratch_dir

#: Names given to the place of a row; no table is expected to have columns of these names.
PLACE = ("__place_file", "__place_row")
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def freeze(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: its rows no longer change and lost executors lose nothing."""
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def map_arrow(rows: DataFrame, work: Callable, schema) -> DataFrame:
    """rows.mapInArrow(work, schema) in batches of at most BATCH_ROWS rows, for rows here carry whole texts.

    The bound is a setting of the session and stays; memory that Arrow holds back goes when a task ends.
    """
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(BATCH_KEY)) <= BATCH_ROWS:
        conf.set(BATCH_KEY, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold_ascii(text: str | Column) -> Column:
    """A-Z to a-z, every other character unchanged; null stays null."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_place(rows: DataFrame) -> DataFrame:
    """Rows plus the file and row number they are stored at, a key that is unique even among equal rows.

    The place depends on the stored files alone, not on how a scan is split, so every pass sees the same one. Rows that
    are not a plain file scan are written once to get a place.
    """
    for attempt in (rows, None):
        source = attempt if attempt is not None else freeze(rows, "placed")
        try:
            place = source.metadataColumn("_metadata")
            return source.select(
                "*", F.xxhash64(place["file_path"]).alias(PLACE[0]), place["row_index"].alias(PLACE[1])
            )
        except AnalysisException:
            if attempt is None:
                raise
    raise AssertionError


def keep_places(placed: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `placed` whose place is in `kept`, with their own columns only."""
    return placed.join(kept.select(*PLACE), list(PLACE), "left_semi").drop(*PLACE)
