"""Table shapes and the fixed values of the candle data model."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("product_id", "granularity")
KEYS = (*SERIES, "start")
OHLC = ("open", "high", "low", "close")
OHLCV = (*OHLC, "volume")
NUMERIC = ("start", *OHLCV)

# ---- fixed values -----------------------------------------------------------
# Column order of the candle file and of the feature table, products,
# granularities with their bar length in seconds, first-load sizes, page size.
CANDLE_COLUMNS = ("date", "start", "open", "high", "low", "close", "volume")
CALENDAR_COLUMNS = ("timestamp", "year", "month", "day", "hour", "minute")
INDICATOR_COLUMNS = (
    "rsi",
    "rsi_lag1",
    "rsi_lag2",
    "rsi_lag3",
    "rsi_pct",
    "macd",
    "macd_signal",
    "macd_histogram",
    "atr",
    "sma_14",
    "sma_50",
    "sma_138",
    "kijun_v2_200_1",
    "es_stoch_rsi_k",
    "es_stoch_rsi_d",
)
PRODUCTS = ("BTC-USD", "ETH-USD")
PERIOD_SECONDS = {
    "FIFTEEN_MINUTE": 900,
    "ONE_HOUR": 3600,
    "FOUR_HOUR": 14400,
    "ONE_DAY": 86400,
}
DEFAULT_PERIOD_SECONDS = 86400
MINUTE_GRANULARITIES = ("FIFTEEN_MINUTE", "ONE_HOUR")
INITIAL_BARS = {
    "FIFTEEN_MINUTE": 360000,
    "ONE_HOUR": 100000,
    "FOUR_HOUR": 25000,
    "ONE_DAY": 4100,
}
DEFAULT_INITIAL_BARS = 4000
BARS_PER_PAGE = 340
EXCHANGE_ZONE = "America/New_York"
# -----------------------------------------------------------------------------

CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("start", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in OHLCV],
    ]
)

# The stored candle table. Reading with it keeps product names text, which
# Spark would otherwise guess from the folder names.
TABLE_SCHEMA = T.StructType(
    [*[T.StructField(name, T.StringType()) for name in SERIES], *CANDLE_SCHEMA.fields]
)

# One landed response. ``page`` is the fetcher's running number: lower arrived
# earlier. Bar fields arrive as text and are coerced later.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("page", T.LongType()),
        # The line itself, where it is no JSON object of this shape.
        T.StructField("_corrupt_record", T.StringType()),
        T.StructField(
            "candles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(name, T.StringType())
                        for name in ("start", "low", "high", "open", "close", "volume")
                    ]
                )
            ),
        ),
    ]
)
