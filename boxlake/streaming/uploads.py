"""Uploads that arrive over several triggers: the last of equal names wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxlake.operators.history import named_images
from boxlake.sources.sinks import append_history


def settled_uploads(uploads: DataFrame, gap: str, delay: str, time: str = "arrived") -> DataFrame:
    """`history.upload_filter` over a stream: of equal names that arrive within `gap` of each other the last one (by `seq`).

    Uploads of a name form a session that ends when none has come for `gap`; a session is given out once, when the
    watermark (`delay` behind the newest `time`) has passed its end, and is forgotten then. A name that comes again
    later is a new upload. Only images move the watermark. The state holds one row per open session, so pass references to large contents rather than the
    contents. Rows later than the watermark are dropped; rows with no time take no part. On a plain table the same rows come out,
    all sessions being closed.
    """
    named = named_images(uploads.withWatermark(time, delay))
    others = [c for c in named.columns if c != "filename"]
    last = F.max_by(F.struct(*others), F.col("seq")).alias("last")
    sessions = named.where(F.col(time).isNotNull()).groupBy("filename", F.session_window(time, gap).alias("session")).agg(last)
    return sessions.select("filename", "last.*")


def store_settled(settled: DataFrame, path: str, checkpoint: str, writer: str = "uploads", time: str = "arrived") -> StreamingQuery:
    """Store what has settled so far, one folder per batch; a batch repeated after a failure replaces itself."""
    return (
        settled.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: append_history(batch, path, writer, batch_id, time))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
