"""From landed pages to the stored candle table."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barloom.functions.cleaning import candle_columns, coerce, with_display_date
from barloom.functions.clock import last_closed
from barloom.operators.merge import (
    cut_off,
    keep_first,
    merge_keep_first,
    merge_replace_open,
    keyed,
    new_keys,
    unkeyed,
)
from barloom.schema import SERIES
from barloom.sinks.tables import candle_table, save_partitioned


log = logging.getLogger(__name__)
_CELLS = "cells"


@dataclass(frozen=True)
class TopUp:
    """What a top-up has met: bars that arrived, those of them without a key, and bars added."""

    arrived: int
    rejected: int
    added: int


def initial_load(arrived: DataFrame, now: str | int, closed_only: bool = False) -> DataFrame:
    """A first table from arrived text bars (see ``page_bars``).

    Coerce, drop bars beyond the last boundary, keep the first arrival of each
    key (neighbouring pages share a bar), add the display date. Bars without a
    key are not in it: ``rejected`` has them, ``save_initial`` counts them.
    """
    typed = coerce(arrived).withColumn("cutoff", last_closed(now=now))
    kept = cut_off(typed, closed_only=closed_only).drop("cutoff")
    return candle_columns(with_display_date(keep_first(kept)))


def rejected(arrived: DataFrame) -> DataFrame:
    """Arrived text bars that cannot be stored: no series, or an unreadable start."""
    return _cells(unkeyed(coerce(_with_cells(arrived))))


def _with_cells(arrived: DataFrame) -> DataFrame:
    """Arrived bars with a struct of all cells as they came."""
    return arrived.select("*", F.struct(*[c for c in arrived.columns if c not in SERIES]).alias(_CELLS))


def _cells(bars: DataFrame) -> DataFrame:
    return bars.select(*SERIES, f"{_CELLS}.*")


def _warn_of_rejects(arrived: DataFrame, rejects_path: str | None) -> int:
    """Counts the bars without a key, warns of them and keeps them if there is a place."""
    bad = rejected(arrived)
    if rejects_path is None:
        n = bad.count()
    else:
        seen = Observation()
        bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(rejects_path)
        n = seen.get["n"]
    if n:
        log.warning("%d bars without a series or a readable start were left out", n)
    return n


def save_initial(
    arrived: DataFrame,
    now: str | int,
    table_path: str,
    closed_only: bool = False,
    rejects_path: str | None = None,
) -> int:
    """Write the first table; returns how many bars were rejected for want of a key."""
    save_partitioned(initial_load(arrived, now, closed_only), table_path)
    return _warn_of_rejects(arrived, rejects_path)


def merged(history: DataFrame, arrived: DataFrame, replace_open: bool = False) -> DataFrame:
    """History topped up with arrived text bars; stored bars win.

    With ``replace_open`` the newest stored bar of a series gives way to an
    arrived one, as it may have been stored before it ended.
    """
    merge = merge_replace_open if replace_open else merge_keep_first
    return merge(history, with_display_date(coerce(arrived)))


def top_up(
    spark: SparkSession,
    arrived: DataFrame,
    table_path: str,
    rejects_path: str | None = None,
    before_writing: Callable[[], None] | None = None,
) -> TopUp:
    """Top up a stored table in place.

    As stored bars always win, topping up is appending the keys that are not
    there yet: no stored file is rewritten, and doing it twice adds nothing. Of
    the history only the keys in the years and the time range of the new bars of
    their series are read. Bars without a key are counted, warned of, and kept at
    ``rejects_path`` if one is given.

    ``arrived`` is evaluated once, into a cache that the counts, the rejects and the
    new bars are read from; the write itself counts what it adds. ``before_writing`` is
    called when ``arrived`` has been evaluated and nothing is written yet; it may raise.
    """
    typed = coerce(arrived if rejects_path is None else _with_cells(arrived)).persist()
    try:
        n, rejects, first, last = typed.agg(
            F.count(F.lit(1)), F.count_if(~keyed()), *[call(F.when(keyed(), F.col("start"))) for call in (F.min, F.max)]
        ).first()
        if before_writing is not None:
            before_writing()
        if rejects:
            log.warning("%d bars without a series or a readable start were left out", rejects)
            if rejects_path is not None:
                _cells(unkeyed(typed)).write.mode("append").parquet(rejects_path)
        if first is None:
            return TopUp(n, rejects, 0)
        fresh = candle_columns(with_display_date(keep_first(typed.drop(_CELLS))))
        history = candle_table(spark, table_path, first, last, typed.filter(keyed()))
        seen = Observation()
        save_partitioned(fresh if history is None else new_keys(history, fresh), table_path, mode="append", seen=seen)
        return TopUp(n, rejects, seen.get["rows"])
    finally:
        typed.unpersist()


def append_arrived(
    spark: SparkSession, arrived: DataFrame, table_path: str, rejects_path: str | None = None
) -> bool:
    """``top_up``; False if no bar with a key has arrived."""
    done = top_up(spark, arrived, table_path, rejects_path)
    return done.arrived > done.rejected
