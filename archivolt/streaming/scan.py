"""Incremental forms: keyword hits of new documents, first-seen crawl hits, late rows.

The batch operators are used as they are inside ``foreachBatch`` or on the
streaming frame; a checkpoint in the shared folder makes the sink survive the loss
of the driver. Each batch writes below its own number, so a batch that is
tried again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from archivolt.operators.search import keyword_hits, to_pages


def stream_keyword_hits(documents: DataFrame, keywords: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Hits of each new batch of documents, appended to ``out`` as Parquet."""

    def sink(batch: DataFrame, number: int) -> None:
        keyword_hits(to_pages(batch), keywords).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return documents.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(hits: DataFrame, time: str = "fetched_at", late: str = "30 days") -> DataFrame:
    """The first hit of each keyword and file name that arrives; state is dropped behind the watermark."""
    return hits.withWatermark(time, late).dropDuplicatesWithinWatermark(["keyword", "filename"])


def hits_by_day(hits: DataFrame, time: str = "found_at", late: str = "1 day") -> DataFrame:
    """Hits a day and keyword, final once the watermark has passed the day."""
    return hits.withWatermark(time, late).groupBy(F.window(time, "1 day"), "keyword").agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), "keyword", "n")
