"""Topping up the candle table from a landing folder as a stream."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from barloom.plans.collect import TopUp, top_up
from barloom.schema import PAGE_SCHEMA
from barloom.sources.pages import page_bars, page_counts

log = logging.getLogger(__name__)

# What the stream's progress calls the counts of pages.
PAGES = "pages"


@dataclass(frozen=True)
class BatchReport:
    """The pages of a batch, the failed ones among them, and what its bars have come to."""

    batch: int
    pages: int
    failed: int
    bars: TopUp


class IngestListener(StreamingQueryListener):
    """Adds up the page counts that streams of this module observe while they read.

    For ``spark.streams.addListener``. ``batches`` has (query id, batch, pages, failed, bars) of
    every batch that had pages; ``ended`` the ids of the queries that have ended.
    """

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, int, int, int]] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(PAGES)
        if seen is not None and seen["pages"]:
            self.batches.append((str(progress.id), progress.batchId, seen["pages"], seen["failed"], seen["bars"]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))


def start_ingest(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    interval: str | None = None,
    files_per_batch: int | None = None,
    strict: bool = False,
    rejects_path: str | None = None,
    report: Callable[[BatchReport], None] | None = None,
) -> StreamingQuery:
    """Merge landed pages into the table; stored bars win, late bars are welcome.

    Without an ``interval`` all waiting files are handled and the query ends,
    which suits a scheduler. A batch that is repeated after a failure finds its
    keys stored already and adds nothing. There is no watermark: a bar is new
    as long as its key is, however old it is. Failed pages are warned of, or with
    ``strict`` stop the query before the batch is merged.

    A batch is evaluated once: its pages are counted on the way to the bars, both for
    ``report``, which is called after each batch, and for the stream's progress, which an
    ``IngestListener`` reads. A task that is repeated for a lost executor may count its
    pages twice.
    """

    def merge(batch: DataFrame, number: int) -> None:
        seen = Observation()

        def check() -> None:
            failed = seen.get["failed"]
            if failed and strict:
                raise ValueError(f"batch {number}: {failed} pages are unreadable or without candles")
            if failed:
                log.warning("batch %d: %d pages are unreadable or without candles", number, failed)

        bars = page_bars(batch.observe(seen, *page_counts()))
        done = top_up(batch.sparkSession, bars, table_path, rejects_path, check)
        if report is not None:
            report(BatchReport(number, seen.get["pages"], seen.get["failed"], done))

    reader = spark.readStream.schema(PAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        reader.json(landing)
        .observe(PAGES, *page_counts())
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
