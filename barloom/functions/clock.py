"""When did the last bar close?  ``now`` is an argument, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.calendar import exchange_wall_sql, period_sql
from barloom.schema import EXCHANGE_ZONE, PERIOD_SECONDS


def last_closed_sql(granularity: str, now: str) -> str:
    # 20:00 is twenty hours into the day that wall time minus twenty hours falls on.
    day = f"cast({exchange_wall_sql(now)} - interval '20' hour as date)"
    close = f"cast({day} as timestamp_ntz) + interval '20' hour"
    utc = f"convert_timezone('{EXCHANGE_ZONE}', 'UTC', {close})"
    daily = f"(unix_date(cast({utc} as date)) * 86400L + hour({utc}) * 3600)"
    intraday = ", ".join(f"'{name}'" for name in PERIOD_SECONDS if name != "ONE_DAY")
    return (
        f"(CASE WHEN {granularity} = 'ONE_DAY' THEN {daily}"
        f" WHEN {granularity} IN ({intraday})"
        f" THEN {now} - pmod({now}, {period_sql(granularity)}) ELSE {now} END)"
    )


def last_closed(granularity: str = "granularity", now: str | int = "now") -> Column:
    """Epoch seconds of the last bar boundary not after ``now`` (column name or seconds).

    Intraday boundaries are multiples of the period in UTC (Eastern offsets are
    whole hours). A day ends at 20:00 Eastern wall time. An unknown granularity
    is always up to date: ``now`` itself.
    """
    return F.expr(last_closed_sql(granularity, f"{now}L" if isinstance(now, int) else now))


def has_new_bars(
    last_start: str = "last_start", granularity: str = "granularity", cutoff: str = "cutoff"
) -> Column:
    """False when the bar after the last stored one has not closed yet."""
    return F.expr(f"{last_start} + {period_sql(granularity)} < {cutoff}")
