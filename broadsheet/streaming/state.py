"""Streams with state: each article once however often it arrives, and running counts of statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators.maintain import append_batch


def once_per_key(rows: DataFrame, key: str = "id", event_time: str = "arrived", within: str = "30 days") -> DataFrame:
    """The first row of each key of a streaming table; its repetitions are dropped, also after a restart.

    A key is remembered until the watermark, the latest event time less ``within``, has passed its row
    by as much again, so the state holds the keys of a span of time and not all there ever were. Rows
    older than the watermark come too late and are dropped, as are rows without a time or a key.
    """
    timed = rows.where(F.col(event_time).isNotNull() & F.col(key).isNotNull())
    return timed.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])


def append_stream(rows: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a streaming table to a folder, each row exactly once.

    ``every`` is a processing-time interval; without it all present input is consumed and the query ends.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", table)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def count_stream(rows: DataFrame, key: str, log: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Running counts (key, n) of a streaming table, as a log of batches.

    Each micro-batch appends the totals that it changed under its id, so repeating one replaces it; the
    present totals are ``maintain.current_articles(read_log(...), key)``. The state has one row a key.
    """
    totals = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, batch_id: append_batch(batch, log, batch_id))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
