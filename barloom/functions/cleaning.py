"""Turning arrived text into typed bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import display_date
from barloom.schema import CANDLE_COLUMNS, NUMERIC, OHLCV, SERIES


def to_double_sql(cell: str) -> str:
    """Number or null. Java's parser also takes ``1.5d``; that is not a number here."""
    text = f"trim(cast({cell} as string))"
    number = f"try_cast(if(rlike({text}, '[dDfF]$'), null, {text}) as double)"
    return f"nullif({number}, cast('NaN' as double))"


def to_long_sql(cell: str) -> str:
    """Whole number or null; a decimal number is cut to its whole part."""
    text = f"trim(cast({cell} as string))"
    return f"coalesce(try_cast({text} as bigint), try_cast({to_double_sql(cell)} as bigint))"


def coerce(df: DataFrame) -> DataFrame:
    """Epoch and price cells to numbers; what cannot be read becomes null."""
    cells = {"start": to_long_sql("start"), **{name: to_double_sql(name) for name in OHLCV}}
    return df.withColumns(
        {name: F.expr(cells[name]) for name in NUMERIC if name in df.columns}
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Typed price columns with NaN cells turned into nulls."""
    return df.withColumns(
        {name: F.expr(f"nullif({name}, cast('NaN' as double))") for name in OHLCV}
    )


def with_display_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", display_date())


def candle_columns(df: DataFrame) -> DataFrame:
    """Series keys, then the candle columns in file order."""
    return df.select(*SERIES, *CANDLE_COLUMNS)
