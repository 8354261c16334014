"""Which bars to ask for: first loads, top-ups, and the pages of a request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import initial_bars, period_seconds, period_sql
from barloom.functions.clock import has_new_bars, last_closed
from barloom.operators.quality import gaps
from barloom.schema import BARS_PER_PAGE, KEYS, PERIOD_SECONDS, PRODUCTS, SERIES
from barloom.sinks.tables import newest_starts, stored_folders


def with_granularities(
    products: DataFrame, granularities: Sequence[str] = tuple(PERIOD_SECONDS)
) -> DataFrame:
    """Every product in every granularity (an explode, not a join), with its sizes."""
    return (
        products.select(
            "product_id",
            F.explode(F.array(*[F.lit(name) for name in granularities])).alias("granularity"),
        )
        .withColumn("period_s", period_seconds())
        .withColumn("target_bars", initial_bars())
    )


def series_catalog(
    spark: SparkSession,
    products: Sequence[str] = PRODUCTS,
    granularities: Sequence[str] = tuple(PERIOD_SECONDS),
) -> DataFrame:
    """The configured series."""
    named = spark.createDataFrame([(name,) for name in products], "product_id string")
    return with_granularities(named, granularities)


def stored_until(history: DataFrame) -> DataFrame:
    """Last bar start of every stored series; partial aggregation, one row per series."""
    return history.groupBy(*SERIES).agg(F.max("start").alias("last_start"))


def load_mode(catalog: DataFrame, history: DataFrame | None) -> DataFrame:
    """``incremental`` for series with stored bars, else ``initial``."""
    return _mode(catalog, None if history is None else stored_until(history).drop("last_start"))


def stored_load_mode(catalog: DataFrame, table_path: str) -> DataFrame:
    """``load_mode`` by the folders of a stored table; no bar is read."""
    folders = stored_folders(catalog.sparkSession, table_path)
    return _mode(catalog, None if folders is None else folders.select(*SERIES).distinct())


def _mode(catalog: DataFrame, stored: DataFrame | None) -> DataFrame:
    if stored is None:
        return catalog.withColumn("load_mode", F.lit("initial"))
    known = stored.withColumn("_stored", F.lit(True))
    return catalog.join(known, list(SERIES), "left").select(
        *catalog.columns,
        F.expr("if(_stored is null, 'initial', 'incremental') AS load_mode"),
    )


def update_plan(catalog: DataFrame, history: DataFrame, now: str | int) -> DataFrame:
    """What a top-up has to fetch for each series.

    ``status`` is ``no_history``, ``skip`` (nothing new has closed) or ``fetch``;
    the request runs from the bar after the last stored one to the last boundary.
    ``now`` is epoch seconds, or the name of a catalog column.
    """
    return _plan(catalog, stored_until(history), now)


def stored_update_plan(catalog: DataFrame, table_path: str, now: str | int) -> DataFrame:
    """``update_plan`` of a stored table, which reads the newest year of each series alone."""
    until = newest_starts(catalog.sparkSession, table_path)
    if until is None:
        until = catalog.select(*SERIES, F.lit(None).cast("long").alias("last_start")).limit(0)
    return _plan(catalog, until, now)


def _plan(catalog: DataFrame, until: DataFrame, now: str | int) -> DataFrame:
    request = "if(status = 'fetch', cast({} as string), null)"
    return (
        catalog.join(until, list(SERIES), "left")
        .withColumn("cutoff", last_closed(now=now))
        .withColumn(
            "status",
            F.when(F.col("last_start").isNull(), "no_history")
            .when(has_new_bars(), "fetch")
            .otherwise("skip"),
        )
        .select(
            *SERIES,
            "last_start",
            "cutoff",
            "status",
            F.expr(
                f"{request.format('last_start + ' + period_sql('granularity'))} AS request_start"
            ),
            F.expr(f"{request.format('cutoff')} AS request_end"),
        )
    )


def backfill_plan(catalog: DataFrame, now: str | int) -> DataFrame:
    """Request windows of a first load, newest first.

    Each window covers a page of bars back from the end of the one before;
    neighbours share an edge.
    """
    width = f"{BARS_PER_PAGE}L * {period_sql('granularity')}"
    return (
        catalog.filter("target_bars > 0")
        .withColumn("cutoff", last_closed(now=now))
        .selectExpr(
            *SERIES,
            "cutoff",
            "explode(sequence(0, cast(ceil(target_bars / "
            f"{BARS_PER_PAGE}) as int) - 1)) AS request",
        )
        .selectExpr(
            *SERIES,
            "request",
            f"cutoff - (request + 1) * {width} AS request_start",
            f"cutoff - request * {width} AS request_end",
        )
    )


def holes(catalog: DataFrame, history: DataFrame, now: str | int) -> DataFrame:
    """What a series lacks of the span that a first load would have given it.

    The span ends with the last boundary and has ``target_bars`` periods before it. Of the
    stretches without stored bars, ``hole`` says which it is: ``all``, ``start``, ``inside`` or
    ``end``; ``first_missing`` and ``last_missing`` are the first and last start that it lacks.
    Stored bars before the span do not matter.
    """
    period = period_sql("granularity")
    spans = (
        catalog.filter("target_bars > 0")
        .withColumn("cutoff", last_closed(now=now))
        .selectExpr(*SERIES, f"cutoff - target_bars * {period} AS _from", "cutoff AS _to")
    )
    # Of the history only the spans' bars; the spans are a row a series.
    kept = history.select(*KEYS).join(spans, list(SERIES)).filter("start between _from and _to")
    stored = kept.groupBy(*SERIES).agg(F.min("start").alias("_first"), F.max("start").alias("_last"))
    edges = spans.join(stored, list(SERIES), "left").selectExpr(
        *SERIES,
        "inline(array("
        f"named_struct('hole', 'all', 'a', if(_first is null, _from, null), 'b', _to),"
        f"named_struct('hole', 'start', 'a', if(_first > _from, _from, null), 'b', _first - {period}),"
        f"named_struct('hole', 'end', 'a', if(_last + {period} <= _to, _last + {period}, null), 'b', _to)))",
    )
    inside = gaps(kept).selectExpr(*SERIES, "'inside' AS hole", "gap_start AS a", "gap_end AS b")
    return (
        edges.filter("a is not null and a <= b")
        .unionByName(inside)
        .selectExpr(*SERIES, "hole", "a AS first_missing", "b AS last_missing")
    )


def repair_plan(catalog: DataFrame, history: DataFrame, now: str | int) -> DataFrame:
    """Page windows that fetch every hole of every series, newest first within a hole.

    A page that failed leaves a hole, which later top-ups never ask for again; this does.
    """
    found = holes(catalog, history, now)
    return _windows(found, "first_missing", "last_missing", "hole", "first_missing")


def update_pages(plan: DataFrame) -> DataFrame:
    """Page windows of every ``fetch`` row of an update plan, newest first.

    A gap longer than a page needs several; the oldest begins with the request.
    """
    first, last = "cast(request_start as bigint)", "cast(request_end as bigint)"
    return _windows(plan.filter("status = 'fetch'"), first, last)


def _windows(stretches: DataFrame, first: str, last: str, *names: str) -> DataFrame:
    """Windows of a page's width back from the end of each stretch; a single start needs one."""
    width = f"{BARS_PER_PAGE}L * {period_sql('granularity')}"
    pages = f"greatest(1, cast(ceil(({last} - {first}) / ({width})) as int))"
    return (
        stretches.selectExpr(
            *SERIES,
            *names,
            f"{first} AS _first",
            f"{last} AS _last",
            f"explode(sequence(0, {pages} - 1)) AS request",
        )
        .selectExpr(
            *SERIES,
            *names,
            "request",
            f"greatest(_first, _last - (request + 1) * {width}) AS request_start",
            f"_last - request * {width} AS request_end",
        )
    )
