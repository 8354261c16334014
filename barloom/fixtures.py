"""Bars derived from the star-schema sample tables.

Only an input adapter for tests, queries and the benchmark: the engine itself
receives finished bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import floor_div_sql, wall_epoch_sql
from barloom.schema import OHLCV, PERIOD_SECONDS


def _bars(ticks: DataFrame, *granularities: str) -> DataFrame:
    """Group ticks to bars of each granularity; partial aggregation keeps hot products cheap."""
    grids = ", ".join(
        f"struct('{name}' AS granularity, {floor_div_sql('at', PERIOD_SECONDS[name])}"
        f" * {PERIOD_SECONDS[name]}L AS start)"
        for name in granularities
    )
    return (
        ticks.selectExpr("product_id", "price", "tick", f"inline(array({grids}))")
        .groupBy("product_id", "granularity", "start")
        .agg(
            F.expr("min_by(price, tick) AS open"),
            F.expr("max(price) AS high"),
            F.expr("min(price) AS low"),
            F.expr("max_by(price, tick) AS close"),
            F.expr("cast(count(1) as double) AS volume"),
        )
        .select("product_id", "granularity", "start", *OHLCV)
    )


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order totals, one series per priority."""
    ticks = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderpriority AS product_id",
        f"{wall_epoch_sql('o_orderdate')} AS at",
        "o_totalprice AS price",
        "o_orderkey AS tick",
    )
    return _bars(ticks, "ONE_DAY")


def event_bars(spark: SparkSession, sf_dir: str, *granularities: str) -> DataFrame:
    """Bars of event values, one series per event type and granularity (15 minutes if none is named)."""
    ticks = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_type AS product_id",
        f"{wall_epoch_sql('ts')} AS at",
        "value AS price",
        "ts AS tick",
    )
    return _bars(ticks, *(granularities or ("FIFTEEN_MINUTE",)))


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on a grid of minutes, as one series that is longer than a chunk."""
    ticks = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        f"{floor_div_sql(wall_epoch_sql('ts'), 60)} * 60L AS start", "value", "ts"
    )
    return ticks.groupBy(F.lit("ALL").alias("product_id"), "start").agg(
        F.lit("FIFTEEN_MINUTE").alias("granularity"),
        F.min_by("value", "ts").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


def rounded(df: DataFrame, places: int = 6, **special: int) -> DataFrame:
    """Doubles rounded for comparison with another engine."""
    return df.selectExpr(
        *[
            f"round({name}, {special.get(name, places)}) AS {name}" if kind == "double" else name
            for name, kind in df.dtypes
        ]
    )
