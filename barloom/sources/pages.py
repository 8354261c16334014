"""Landed response pages: one JSON object with a ``candles`` list per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import OHLCV, PAGE_SCHEMA, SERIES


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).json(path)


def parse_pages(texts: DataFrame, column: str = "value") -> DataFrame:
    """Pages from a text column that holds one JSON object per row."""
    return texts.select(F.from_json(column, PAGE_SCHEMA).alias("_p")).select("_p.*")


def page_bars(pages: DataFrame) -> DataFrame:
    """Every candle of every page as text cells, with its ``arrival``.

    A page that is empty, unreadable or has no list adds nothing; see
    ``page_report``. Arrival orders by page number, then by place in the page. A
    page without a number comes before all others.
    """
    return pages.select(*SERIES, "page", F.posexplode("candles").alias("_at", "_bar")).selectExpr(
        *SERIES,
        "_bar.start AS start",
        *[f"_bar.{name} AS {name}" for name in OHLCV],
        "struct(page, _at AS place) AS arrival",
    )


def with_status(pages: DataFrame) -> DataFrame:
    """Pages with ``status``: unreadable, failed (no list of candles), empty or good."""
    status = (
        F.when(F.col("_corrupt_record").isNotNull(), "unreadable")
        .when(F.col("candles").isNull(), "failed")
        .when(F.size("candles") == 0, "empty")
        .otherwise("good")
    )
    return pages.withColumn("status", status)


def page_report(pages: DataFrame) -> DataFrame:
    """Pages and bars of each series by status; an unreadable line has no series."""
    return (
        with_status(pages)
        .groupBy(*SERIES, "status")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum(F.greatest(F.size("candles"), F.lit(0))).alias("bars"),
        )
    )


def page_counts() -> list[Column]:
    """Aggregates over pages: all ``pages``, the ``failed`` ones, and the ``bars`` in their lists.

    A page is failed if it is unreadable or without a list; an empty list is a success.
    """
    return [
        F.count(F.lit(1)).alias("pages"),
        F.expr("count_if(_corrupt_record is not null or candles is null) AS failed"),
        F.expr("coalesce(sum(greatest(size(candles), 0)), 0L) AS bars"),
    ]


def failed_pages(pages: DataFrame) -> int:
    """How many pages are unreadable or without a list; an empty list is a success."""
    return pages.agg(*page_counts()).first()["failed"]
