"""Row counts, missing cells and repeated keys, per series.

Starts on the grid of a known granularity are told by the slots of time buckets: a
bitmap has a bit for each of the 32,768 slots of a bucket, so what is shuffled is a row
a bucket, not a row a key. More rows than bits in a bucket mean repeated keys; only the
rows of such buckets are then grouped by key. Other starts are grouped by key at once.
"""

from __future__ import annotations

import logging
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barloom.functions.calendar import floor_div_sql, grid_sql, period_sql
from barloom.operators.chunks import BUCKET_BARS, PLACED
from barloom.schema import CANDLE_COLUMNS, KEYS, PERIOD_SECONDS, SERIES

log = logging.getLogger(__name__)

#: Bits of a bitmap aggregate, fixed by Spark.
SLOTS = 32_768


def _series(df: DataFrame) -> list[str]:
    return [name for name in SERIES if name in df.columns]


def _checked(df: DataFrame) -> list[str]:
    """The key columns that this frame has."""
    return [name for name in CANDLE_COLUMNS if name in df.columns]


def missing(name: str) -> Column:
    """Count of null cells of one column."""
    return F.count_if(F.col(name).isNull()).alias(f"null_{name}")


def row_count(df: DataFrame) -> DataFrame:
    return df.groupBy(*_series(df)).agg(F.count(F.lit(1)).alias("total"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null cells per key column, all in one pass."""
    return df.groupBy(*_series(df)).agg(*[missing(name) for name in _checked(df)])


def duplicate_keys(df: DataFrame) -> DataFrame:
    """How many distinct ``start`` values occur more than once; null is a value too."""
    return _counted(df, []).drop("total")


def quality_report(df: DataFrame, stage: str) -> DataFrame:
    """Total, null cells and repeated keys of every series.

    Without repeated keys the table is scanned once. Every aggregation
    pre-aggregates before its shuffle, so a heavily repeated key costs no more than any other.
    """
    names = _checked(df)
    nulls = [f"null_{name}" for name in names]
    report = _counted(df, names).withColumn("stage", F.lit(stage))
    return report.select(*_series(df), "stage", "total", *nulls, "duplicate_starts")


def slotted(df: DataFrame) -> DataFrame:
    """df with ``_bucket`` and ``_slot`` of starts on the grid, and ``_off``, the others; the rest is null.

    A start is off the grid too if its granularity is unknown or its series is missing.
    """
    if not set(SERIES) <= set(df.columns):
        return df.selectExpr("*", "cast(null as bigint) AS _bucket", "cast(null as bigint) AS _slot", "start AS _off")
    known = ", ".join(f"'{name}'" for name in PERIOD_SECONDS)
    period = grid_sql("granularity")
    fits = f"product_id is not null and granularity in ({known}) and pmod(start, {period}) = 0"
    wide = f"({period} * {SLOTS}L)"
    return df.selectExpr(
        "*",
        f"if({fits}, {floor_div_sql('start', wide)}, null) AS _bucket",
        f"if({fits}, pmod(start, {wide}) div {period}, null) AS _slot",
        f"if({fits}, null, start) AS _off",
    )


def bucket_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows, null cells and different starts of every bucket, or of every start off the grid."""
    return (
        slotted(df)
        .groupBy(*_series(df), "_bucket", "_off")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.bitmap_construct_agg(F.col("_slot")).alias("_bits"),
            *[missing(name) for name in names],
        )
        .withColumn("_starts", F.when(F.col("_bucket").isNull(), 1).otherwise(F.bitmap_count("_bits")))
        .drop("_bits")
    )


def _counted(df: DataFrame, names: list[str]) -> DataFrame:
    """Per series total, null cells of the columns, and how many starts occur more than once."""
    keys = _series(df)
    buckets = bucket_counts(df, names)
    # Asks for every column and nothing of the keys, so that both uses read the same exchange.
    every = " + ".join(["_starts", *[f"null_{name}" for name in names]])
    full = buckets.filter(f"_n > _starts and {every} >= 0").select(*keys, "_bucket")
    # Known before any key is shuffled: in a table without repeats none is.
    some = full.agg(F.count(F.lit(1))).scalar() > 0
    rows = slotted(df.select(*keys, "start")).filter(F.col("_bucket").isNotNull() & some)
    same = reduce(and_, [rows[name].eqNullSafe(full[name]) for name in [*keys, "_bucket"]])
    again = (
        rows.join(full, same, "left_semi")
        .groupBy(*keys, "start")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.count_if(F.col("_n") > 1).alias("_again"))
    )
    totals = buckets.groupBy(*keys).agg(
        F.sum("_n").alias("total"),
        *[F.sum(f"null_{name}").alias(f"null_{name}") for name in names],
        F.count_if(F.col("_bucket").isNull() & (F.col("_n") > 1)).alias("_beside"),
    )
    # Only series that are known have repeats on the grid, so a plain equality is enough.
    joined = totals.join(again, keys, "left") if keys else totals.withColumn("_again", F.lit(0))
    both = (F.col("_beside") + F.coalesce("_again", F.lit(0))).alias("duplicate_starts")
    return joined.select(*keys, "total", *[f"null_{name}" for name in names], both)


def missing_bars(bars: DataFrame) -> DataFrame:
    """Per series its first and last start, bars, and starts of the grid between them that have none.

    From bucket bitmaps alone; only starts on the grid count.
    """
    marked = slotted(bars).filter("_bucket is not null")
    buckets = marked.groupBy(*SERIES, "_bucket").agg(
        F.min("start").alias("_first"),
        F.max("start").alias("_last"),
        F.bitmap_count(F.bitmap_construct_agg(F.col("_slot"))).alias("_bars"),
    )
    spans = buckets.groupBy(*SERIES).agg(
        F.min("_first").alias("first_start"), F.max("_last").alias("last_start"), F.sum("_bars").alias("bars")
    )
    grid = f"(last_start - first_start) div {period_sql('granularity')} + 1"
    return spans.withColumn("missing_bars", F.expr(f"{grid} - bars"))


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and its null cells counted as it is written."""
    seen = Observation()
    return df.observe(seen, *[missing(name) for name in _checked(df)]), seen


def gaps(bars: DataFrame, bucket_bars: int = BUCKET_BARS) -> DataFrame:
    """Where bars are missing inside a series: first and last missing start, and how many.

    The bar before is looked for inside a time bucket and, for the first of a
    bucket, in a table of one row per bucket, so no task orders a whole series.
    Repeated keys count once; bars without a key are passed over.
    """
    bucket = floor_div_sql("start", f"({grid_sql('granularity')} * {bucket_bars}L)")
    keyed = bars.filter(PLACED).selectExpr(*KEYS, f"{bucket} AS _bucket")
    names = ", ".join(SERIES)
    seams = (
        keyed.groupBy(*SERIES, "_bucket")
        .agg(F.max("start").alias("_last"))
        .selectExpr(
            *SERIES,
            "_bucket",
            f"lag(_last) OVER (PARTITION BY {names} ORDER BY _bucket) AS _seam",
        )
    )
    inside = f"lag(start) OVER (PARTITION BY {names}, _bucket ORDER BY start)"
    period = period_sql("granularity")
    return (
        keyed.join(seams, [*SERIES, "_bucket"])
        .selectExpr(*KEYS, f"coalesce({inside}, _seam) AS _before")
        .filter(f"start - _before > {period}")
        .selectExpr(
            *SERIES,
            f"_before + {period} AS gap_start",
            f"start - {period} AS gap_end",
            f"(start - _before) div {period} - 1 AS missing_bars",
        )
    )


def report_totals(report: DataFrame) -> dict[str, int]:
    """Sums of a report over all series: one row reaches the driver."""
    numbers = [name for name, kind in report.dtypes if kind == "bigint"]
    row = report.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in numbers]).first()
    return row.asDict()


def warn_of_findings(totals: dict[str, int], stage: str) -> None:
    """Nulls and repeats are reported, never rejected."""
    for name, n in totals.items():
        if n and name.startswith("null_"):
            log.warning("%s: column %s has %d null cells", stage, name[len("null_") :], n)
        elif n and name == "duplicate_starts":
            log.warning("%s: %d start values occur more than once", stage, n)


def require_same_count(before: int, after: int, step: str) -> None:
    """Rows must neither vanish nor multiply."""
    if before != after:
        raise ValueError(f"{step}: {before} rows in, {after} rows out")
