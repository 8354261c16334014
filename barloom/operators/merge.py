"""Combining arrived bars with stored ones: the first arrival of a key stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import period_sql
from barloom.schema import KEYS, SERIES


def keep_first(arrived: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One row per (series, start): the one with the lowest arrival number.

    An aggregation rather than a row number: copies of a key are reduced before
    the shuffle, so a key that arrives very often does not pile up in one task.
    Rows that lack their series or a usable ``start`` have no key and are left
    out; see ``unkeyed``.
    """
    others = [name for name in arrived.columns if name not in (*KEYS, arrival)]
    return (
        arrived.filter(keyed())
        .groupBy(*KEYS)
        .agg(*[F.min_by(name, arrival).alias(name) for name in others])
    )


def keyed() -> Column:
    """Whether a row has a whole key."""
    return F.expr(" and ".join(f"{name} is not null" for name in KEYS))


def unkeyed(arrived: DataFrame) -> DataFrame:
    """Arrived rows without a series or with a ``start`` that could not be read."""
    return arrived.filter(~keyed())


def merge_replace_open(history: DataFrame, arrived: DataFrame) -> DataFrame:
    """As ``merge_keep_first``, but an arrived bar replaces the newest stored one of its series.

    The newest bar may have been stored while it was still open; every older one
    had ended.
    """
    newest = history.groupBy(*SERIES).agg(F.max("start").alias("_newest"))
    fresh = keep_first(arrived)
    replaced = fresh.join(newest, list(SERIES)).filter("start = _newest").select(*KEYS)
    stored = history.join(replaced, list(KEYS), "left_anti")
    return merge_keep_first_of(stored, fresh)


def merge_keep_first_of(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """History plus the rows of ``fresh``, one per key, whose key is new."""
    return history.unionByName(new_keys(history, fresh).select(*history.columns))


def cut_off(bars: DataFrame, cutoff: str = "cutoff", closed_only: bool = False) -> DataFrame:
    """Bars starting no later than the last boundary.

    A bar that starts exactly there has only just opened; ``closed_only`` asks
    for bars that had also ended by then.
    """
    end = f"start + {period_sql('granularity')}" if closed_only else "start"
    return bars.filter(f"{end} <= {cutoff}")


def new_keys(history: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` whose key the history does not have.

    Only the three key columns of the history are read.
    """
    return new.join(history.select(*KEYS), list(KEYS), "left_anti")


def merge_keep_first(history: DataFrame, arrived: DataFrame) -> DataFrame:
    """History plus the first arrival of every key that is new."""
    return merge_keep_first_of(history, keep_first(arrived))


def in_order(bars: DataFrame) -> DataFrame:
    """Series by series, oldest bar first (a range sort: no single task sorts all)."""
    return bars.orderBy(*SERIES, "start")


def last_bar(bars: DataFrame) -> DataFrame:
    """The newest bar of every series, whole."""
    others = [name for name in bars.columns if name not in KEYS]
    return bars.groupBy(*SERIES).agg(
        F.max("start").alias("start"), *[F.max_by(name, "start").alias(name) for name in others]
    )


def span(bars: DataFrame) -> DataFrame:
    """First and last bar start of every series."""
    return bars.groupBy(*SERIES).agg(
        F.min("start").alias("first_start"), F.max("start").alias("last_start")
    )

