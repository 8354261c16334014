from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from barloom.functions.calendar import calendar_columns, display_date, period_seconds, series_name
from barloom.functions.clock import has_new_bars, last_closed


def at(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp())


def one(spark, columns, **values):
    kinds = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(columns).first()[0]


@pytest.mark.parametrize(
    "now, granularity, expected",
    [
        ("2025-01-15 12:07:31", "FIFTEEN_MINUTE", "2025-01-15 12:00:00"),
        ("2025-01-15 12:59:59", "ONE_HOUR", "2025-01-15 12:00:00"),
        ("2025-01-15 15:59:59", "FOUR_HOUR", "2025-01-15 12:00:00"),
        ("2025-01-15 12:00:00", "ONE_DAY", "2025-01-15 01:00:00"),
        ("2025-07-15 12:00:00", "ONE_DAY", "2025-07-15 00:00:00"),
        ("2025-03-09 00:59:00", "ONE_DAY", "2025-03-08 01:00:00"),
        ("2025-03-09 01:00:00", "ONE_DAY", "2025-03-09 01:00:00"),
        # The clocks change that night; yesterday's close was still at 20:00 EST.
        ("2025-03-09 12:00:00", "ONE_DAY", "2025-03-09 01:00:00"),
        ("2025-03-10 12:00:00", "ONE_DAY", "2025-03-10 00:00:00"),
        ("2025-11-02 12:00:00", "ONE_DAY", "2025-11-02 00:00:00"),
        ("2025-11-03 12:00:00", "ONE_DAY", "2025-11-03 01:00:00"),
        ("2025-01-15 12:07:31", "TWO_WEEK", "2025-01-15 12:07:31"),
    ],
)
def test_last_closed(spark, now, granularity, expected):
    got = one(spark, last_closed(), now=at(now), granularity=granularity)
    assert got == at(expected)
    assert one(spark, last_closed(now=at(now)), granularity=granularity) == at(expected)


@pytest.mark.parametrize(
    "start, granularity, expected",
    [
        ("2025-01-02 00:00:00", "ONE_HOUR", "2025-01-01 19:00:00 EST"),
        ("2025-01-02 00:00:00", "ONE_DAY", "2025-01-02 19:00:00 EST"),
        ("2025-03-09 06:45:00", "FIFTEEN_MINUTE", "2025-03-09 01:45:00 EST"),
        ("2025-03-09 07:00:00", "FIFTEEN_MINUTE", "2025-03-09 03:00:00 EDT"),
        ("2025-03-08 12:00:00", "ONE_DAY", "2025-03-09 08:00:00 EDT"),
        ("2025-11-02 05:30:00", "FIFTEEN_MINUTE", "2025-11-02 01:30:00 EDT"),
        ("2025-11-02 06:30:00", "FIFTEEN_MINUTE", "2025-11-02 01:30:00 EST"),
    ],
)
def test_display_date(spark, start, granularity, expected):
    assert one(spark, display_date(), start=at(start), granularity=granularity) == expected


def test_calendar_is_utc_whatever_the_session_zone(spark):
    data = [(at("2025-03-09 09:30:00"), "ONE_HOUR"), (at("1969-12-31 23:59:59"), "ONE_DAY")]
    frame = spark.createDataFrame(data, "start long, granularity string")
    rows = frame.select("start", *[c.alias(n) for n, c in calendar_columns().items()]).collect()
    assert tuple(rows[0])[2:] == (2025, 3, 9, 9, 30)
    assert tuple(rows[1])[2:] == (1969, 12, 31, 23, None)
    stamps = frame.select(F.unix_seconds(calendar_columns()["timestamp"])).collect()
    assert [r[0] for r in stamps] == [r["start"] for r in rows]


def test_period_and_name(spark):
    assert one(spark, period_seconds(), granularity="FOUR_HOUR") == 14400
    assert one(spark, period_seconds(), granularity="OTHER") == 86400
    name = one(spark, series_name(), product_id="BTC-USD/X", granularity="ONE_DAY")
    assert name == "BTC_USD_X_one_day"


@pytest.mark.parametrize("cutoff, expected", [(7199, False), (7200, False), (7201, True)])
def test_has_new_bars(spark, cutoff, expected):
    got = one(spark, has_new_bars(), last_start=3600, granularity="ONE_HOUR", cutoff=cutoff)
    assert got is expected
