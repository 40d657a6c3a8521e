"""Structured Streaming front: new files or events go through the same merge as a batch update."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandlake.operators.store import TableStore


def append_stream(stream: DataFrame, store: TableStore, name: str, checkpoint: str, clock=datetime.now, order: str | None = None) -> StreamingQuery:
    """Append each micro-batch's new keys to a stored table; a batch that is run again after a failure changes nothing twice, the ledger included."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, number: store.append_new(name, batch, clock(), order, tag=(checkpoint, number))).start()


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) by event time; on a stream, events later than the watermark are left out."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def deduplicated(events: DataFrame, key: str = "event_id", within: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
