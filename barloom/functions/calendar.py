"""Calendar and naming expressions.

Everything is computed from epoch seconds or from zone-less timestamps, so no
result depends on ``spark.sql.session.timeZone``. The ``*_sql`` helpers take and
return SQL expression text; the others return Columns of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schema import (
    DEFAULT_INITIAL_BARS,
    DEFAULT_PERIOD_SECONDS,
    EXCHANGE_ZONE,
    INITIAL_BARS,
    MINUTE_GRANULARITIES,
    PERIOD_SECONDS,
)


def lookup_sql(table: dict[str, int], key: str, default: int) -> str:
    """Value of ``key`` in a fixed table, or the default."""
    arms = " ".join(f"WHEN '{name}' THEN {value}L" for name, value in table.items())
    return f"(CASE {key} {arms} ELSE {default}L END)"


def period_sql(granularity: str) -> str:
    """Bar length in seconds; an unknown granularity counts as one day."""
    return lookup_sql(PERIOD_SECONDS, granularity, DEFAULT_PERIOD_SECONDS)


def grid_sql(granularity: str) -> str:
    """Spacing of possible bar starts: the period, or one second if unknown."""
    return lookup_sql(PERIOD_SECONDS, granularity, 1)


def floor_div_sql(value: str, width: str | int) -> str:
    """Integer division rounding down, exact for the whole long range."""
    return f"(({value}) - pmod({value}, {width})) div ({width})"


def _day_sql(epoch: str) -> str:
    return f"date_from_unix_date(cast({floor_div_sql(epoch, 86400)} as int))"


def utc_wall_sql(epoch: str) -> str:
    """Epoch seconds as a zone-less UTC timestamp."""
    seconds = f"cast(pmod({epoch}, 86400) as int)"
    return f"timestampadd(SECOND, {seconds}, cast({_day_sql(epoch)} as timestamp_ntz))"


def wall_epoch_sql(wall: str) -> str:
    """Zone-less UTC timestamp back to epoch seconds, by field arithmetic."""
    return (
        f"(unix_date(cast({wall} as date)) * 86400L + hour({wall}) * 3600"
        f" + minute({wall}) * 60 + second({wall}))"
    )


def exchange_wall_sql(epoch: str) -> str:
    """Epoch seconds as zone-less Eastern wall time."""
    return f"convert_timezone('UTC', '{EXCHANGE_ZONE}', {utc_wall_sql(epoch)})"


def display_date_sql(start: str, granularity: str) -> str:
    shown = f"({start} + if({granularity} = 'ONE_DAY', 86400, 0))"
    wall = exchange_wall_sql(shown)
    behind = f"pmod(hour({utc_wall_sql(shown)}) - hour({wall}), 24)"
    return f"concat(cast({wall} as string), if({behind} = 4, ' EDT', ' EST'))"


def period_seconds(granularity: str = "granularity") -> Column:
    return F.expr(period_sql(granularity))


def initial_bars(granularity: str = "granularity") -> Column:
    """How many bars a first load asks for."""
    return F.expr(lookup_sql(INITIAL_BARS, granularity, DEFAULT_INITIAL_BARS))


def calendar_columns(
    start: str = "start", granularity: str = "granularity"
) -> dict[str, Column]:
    """timestamp, year, month, day, hour in UTC; minute for the two finest granularities."""
    fine = ", ".join(f"'{name}'" for name in MINUTE_GRANULARITIES)
    day = _day_sql(start)
    minute = f"cast(pmod({start}, 3600) div 60 as int)"
    return {
        "timestamp": F.expr(f"timestamp_seconds({start})"),
        "year": F.expr(f"year({day})"),
        "month": F.expr(f"month({day})"),
        "day": F.expr(f"day({day})"),
        "hour": F.expr(f"cast(pmod({start}, 86400) div 3600 as int)"),
        "minute": F.expr(f"if({granularity} in ({fine}), {minute}, null)"),
    }


def display_date(start: str = "start", granularity: str = "granularity") -> Column:
    """Eastern wall clock with EST/EDT; a daily bar shows its close time."""
    return F.expr(display_date_sql(start, granularity))


def series_name(product_id: str = "product_id", granularity: str = "granularity") -> Column:
    """Storage name of a series, e.g. BTC_USD_one_day."""
    return F.expr(f"concat_ws('_', translate({product_id}, '-/', '__'), lower({granularity}))")
