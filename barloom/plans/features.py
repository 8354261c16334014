"""The feature table: bars plus calendar parts and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import calendar_columns
from barloom.operators.chunks import BUCKET_BARS, State
from barloom.operators.indicators import add_indicators, standard_indicators
from barloom.schema import CALENDAR_COLUMNS, INDICATOR_COLUMNS


def with_calendar(bars: DataFrame) -> DataFrame:
    """Bars with timestamp, year, month, day, hour and minute (UTC)."""
    return bars.withColumns(calendar_columns())


def feature_table(
    bars: DataFrame,
    core: int | None = None,
    bucket_bars: int = BUCKET_BARS,
    before: State | None = None,
    endless: bool = False,
) -> DataFrame:
    """All series at once; as many rows as ``bars``, which has unique keys.

    With a state ``before`` the bars go on where it ends, and no earlier bar is read. A close of
    zero or less is unknown to the Ehlers lines, or with ``endless`` has the log of floating-point
    arithmetic (see ``ewm_rsi``).

    The calendar is added after the shuffles, from ``start``, so that it does
    not travel through them.
    """
    items = standard_indicators(endless)
    measured = add_indicators(bars, *items, core=core, bucket_bars=bucket_bars, before=before, whole=True)
    calendar = calendar_columns()
    return measured.select(
        *bars.columns,
        *[calendar[name].alias(name) for name in CALENDAR_COLUMNS],
        *[F.col(name) for name in INDICATOR_COLUMNS],
    )
