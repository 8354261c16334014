"""Cleaning, merging, quality, planning."""

import pytest
from pyspark.sql import functions as F

from barloom.functions.cleaning import coerce
from barloom.operators import merge, quality
from barloom.plans.collect import initial_load, merged
from barloom.plans.updates import (
    backfill_plan,
    load_mode,
    series_catalog,
    update_pages,
    update_plan,
)
from barloom.sources.candles import latest_files
from barloom.sources.pages import page_bars, parse_pages
from helpers import BAR, flat, ramp, rows

TEXT_BAR = (
    "product_id string, granularity string, start string, open string, high string,"
    " low string, close string, volume string, arrival long"
)
STORED = "product_id string, granularity string, date string, start long, open double," \
    " high double, low double, close double, volume double"


def arrived(spark, items, product="A", granularity="ONE_HOUR"):
    """(start, price) pairs in arrival order."""
    data = [
        (product, granularity, str(start), *[str(price)] * 5, i)
        for i, (start, price) in enumerate(items)
    ]
    return spark.createDataFrame(data, TEXT_BAR)


def stored(spark, items, product="A", granularity="ONE_HOUR"):
    data = [(product, granularity, "d", start, *[price] * 5) for start, price in items]
    return spark.createDataFrame(data, STORED)


def prices(frame):
    return sorted((r["start"], r["close"]) for r in frame.collect())


def test_coerce(spark):
    cells = ["1.5", " 2 ", "abc", "", None, "1e3", "nan", "3d", "4F", "7.9"]
    frame = spark.createDataFrame([(c, c) for c in cells], "start string, close string")
    got = [tuple(r) for r in coerce(frame).collect()]
    assert [c for _, c in got] == [1.5, 2.0, None, None, None, 1000.0, None, None, None, 7.9]
    assert [s for s, _ in got] == [1, 2, None, None, None, 1000, None, None, None, 7]


def test_keep_first_takes_the_earliest_arrival(spark):
    frame = coerce(arrived(spark, [(3600, 2.0), (0, 1.0), (3600, 3.0), (0, 9.0)]))
    assert prices(merge.keep_first(frame.repartition(4))) == [(0, 1.0), (3600, 2.0)]


def test_keep_first_keeps_a_row_together(spark):
    data = [("A", "ONE_HOUR", "0", "1", None, "3", "4", "5", 0)]
    data.append(("A", "ONE_HOUR", "0", "6", "7", "8", "9", "10", 1))
    row = merge.keep_first(coerce(spark.createDataFrame(data, TEXT_BAR))).first()
    assert (row["open"], row["high"], row["close"]) == (1.0, None, 4.0)


def test_merge_stored_bars_win_and_merging_twice_adds_nothing(spark):
    history = stored(spark, [(3600 * i, float(i)) for i in range(1, 21)])
    new = [(3600 * i, 100.0 + i) for i in range(18, 26)] + [(3600 * 25, 0.0)]
    once = merged(history, arrived(spark, new))
    expected = [(3600 * i, float(i)) for i in range(1, 21)]
    expected += [(3600 * i, 100.0 + i) for i in range(21, 26)]
    assert prices(once) == expected
    assert prices(merged(once, arrived(spark, new))) == expected
    assert prices(merged(history, arrived(spark, []))) == expected[:20]


def test_unreadable_starts_are_reported_not_merged(spark):
    frame = coerce(arrived(spark, [("abc", 1.0), (0, 2.0)]))
    assert prices(merge.keep_first(frame)) == [(0, 2.0)]
    assert merge.unkeyed(frame).count() == 1


PAGES = [
    # Two pages share the bar at 7200; one is empty, one has no list.
    '{"product_id":"A","granularity":"ONE_HOUR","page":1,"candles":['
    '{"start":"7200","low":"1","high":"1","open":"1","close":"1.0","volume":"1"},'
    '{"start":"3600","low":"2","high":"2","open":"2","close":"2.0","volume":"2"}]}',
    '{"product_id":"A","granularity":"ONE_HOUR","page":2,"candles":['
    '{"start":"10800","low":"3","high":"3","open":"3","close":"3.0","volume":"x"},'
    '{"start":"7200","low":"4","high":"4","open":"4","close":"4.0","volume":"4"}]}',
    '{"product_id":"A","granularity":"ONE_HOUR","page":3,"candles":[]}',
    '{"product_id":"A","granularity":"ONE_HOUR","page":4}',
]


def test_initial_load_from_pages(spark):
    texts = spark.createDataFrame([(p,) for p in PAGES], "value string")
    bars = page_bars(parse_pages(texts))
    assert bars.count() == 4
    assert prices(initial_load(bars, now=10800)) == [(3600, 2.0), (7200, 1.0), (10800, 3.0)]
    assert prices(initial_load(bars, now=10799)) == [(3600, 2.0), (7200, 1.0)]
    # The bar that starts at the boundary has not ended.
    closed = initial_load(bars, now=10800, closed_only=True)
    assert prices(closed) == [(3600, 2.0), (7200, 1.0)]
    assert initial_load(bars, now=10800).filter("start = 10800").first()["volume"] is None


def test_quality(spark):
    data = rows(flat(5), "A") + rows(flat(2), "A") + rows(flat(3), "B")
    data += [("A", "FIFTEEN_MINUTE", None, 1.0, None, 1.0, 1.0, None)] * 2
    frame = spark.createDataFrame(data, BAR)
    report = {r["product_id"]: r for r in quality.quality_report(frame, "INPUT").collect()}
    a = report["A"].asDict()
    assert (a["total"], a["null_start"], a["null_high"], a["null_volume"]) == (9, 2, 2, 2)
    # Two repeated starts, and the null start is a repeated key as well.
    assert (a["duplicate_starts"], report["B"]["duplicate_starts"]) == (3, 0)
    totals = quality.report_totals(quality.quality_report(frame, "INPUT"))
    assert totals["total"] == 12 and totals["duplicate_starts"] == 3
    whole = quality.quality_report(frame.drop("product_id", "granularity"), "X").first()
    assert whole["total"] == 12
    with pytest.raises(ValueError, match="2 rows in, 3 rows out"):
        quality.require_same_count(2, 3, "step")


def test_last_bar_and_span(spark):
    frame = spark.createDataFrame(rows(ramp(5)), BAR)
    assert merge.last_bar(frame).first()["close"] == 6.0
    assert tuple(merge.span(frame).first())[2:] == (0, 3600)
    assert [r["start"] for r in merge.in_order(frame).collect()] == [0, 900, 1800, 2700, 3600]


def test_catalog_and_load_mode(spark):
    catalog = series_catalog(spark)
    assert catalog.count() == 8
    targets = {r["granularity"]: r["target_bars"] for r in catalog.collect()}
    assert targets["FIFTEEN_MINUTE"] == 360000 and targets["ONE_DAY"] == 4100
    history = stored(spark, [(0, 1.0)], "BTC-USD", "ONE_DAY")
    modes = load_mode(catalog, history).filter("load_mode = 'incremental'").collect()
    assert [(r["product_id"], r["granularity"]) for r in modes] == [("BTC-USD", "ONE_DAY")]
    assert load_mode(catalog, None).filter("load_mode = 'initial'").count() == 8
    other = series_catalog(spark, ["X"], ["ONE_WEEK"]).first()
    assert (other["period_s"], other["target_bars"]) == (86400, 4000)


def test_update_plan(spark):
    now = 3600 * 1000 + 5
    catalog = series_catalog(spark, ["A", "B", "C"], ["ONE_HOUR"])
    history = stored(spark, [(0, 1.0), (3600 * 200, 1.0)], "A").unionByName(
        stored(spark, [(3600 * 999, 1.0)], "B")
    )
    plan = update_plan(catalog, history, now)
    got = {r["product_id"]: r for r in plan.collect()}
    assert [got[p]["status"] for p in "ABC"] == ["fetch", "skip", "no_history"]
    assert got["A"]["request_start"] == str(3600 * 201)
    assert got["A"]["request_end"] == str(3600 * 1000)
    assert got["B"]["request_start"] is None
    pages = update_pages(plan).orderBy("request").collect()
    edges = [(p["request_start"] // 3600, p["request_end"] // 3600) for p in pages]
    assert edges == [(660, 1000), (320, 660), (201, 320)]


def test_backfill_plan(spark):
    catalog = series_catalog(spark, ["A"], ["ONE_DAY", "FIFTEEN_MINUTE"])
    plan = backfill_plan(catalog, 1_736_942_400).cache()  # 2025-01-15 12:00 UTC
    counts = {r["granularity"]: r["count"] for r in plan.groupBy("granularity").count().collect()}
    assert counts == {"ONE_DAY": 13, "FIFTEEN_MINUTE": 1059}
    daily = plan.filter("granularity = 'ONE_DAY'").orderBy("request").collect()
    assert daily[0]["request_end"] == 1_736_902_800  # 2025-01-15 01:00 UTC
    for newer, older in zip(daily, daily[1:]):
        assert newer["request_start"] == older["request_end"]
        assert newer["request_end"] - newer["request_start"] == 340 * 86400


def test_latest_files(spark):
    catalog = series_catalog(spark, ["BTC-USD", "ETH-USD"], ["ONE_DAY"])
    names = ["BTC_USD_one_day.csv", "BTC_USD_one_day_2025.csv", "BTC_USD_one_hour.csv"]
    files = spark.createDataFrame([("in/" + n, n) for n in names], "path string, name string")
    got = latest_files(files, catalog).collect()
    assert [(r["product_id"], r["path"]) for r in got] == [
        ("BTC-USD", "in/BTC_USD_one_day_2025.csv")
    ]


def test_gaps(spark):
    starts = [0, 3600, 10800, 14400, 50400, 50400, 3600 * 70_000]
    bars = stored(spark, [(s, 1.0) for s in starts])
    bars = bars.unionByName(bars.withColumn("start", F.lit(None).cast("long")))
    want = [(7200, 7200, 1), (18000, 46800, 9), (54000, 3600 * 69_999, 69_985)]
    for bucket in (2, 65_536):
        found = quality.gaps(bars, bucket_bars=bucket).orderBy("gap_start").collect()
        assert [tuple(r)[2:] for r in found] == want
    assert quality.gaps(bars.limit(0)).count() == 0


def test_newest_stored_bar_can_be_replaced(spark):
    history = stored(spark, [(0, 1.0), (3600, 2.0), (7200, 3.0)])
    new = arrived(spark, [(3600, 9.0), (7200, 8.0), (7200, 7.0), (10800, 6.0)])
    assert prices(merged(history, new, replace_open=True)) == [(0, 1.0), (3600, 2.0), (7200, 8.0), (10800, 6.0)]
    assert prices(merged(history, new)) == [(0, 1.0), (3600, 2.0), (7200, 3.0), (10800, 6.0)]
    assert prices(merged(history, arrived(spark, []), replace_open=True)) == prices(history)


def test_no_target_no_window(spark):
    catalog = series_catalog(spark, ["A"], ["ONE_DAY"])
    assert backfill_plan(catalog.withColumn("target_bars", F.lit(0)), 86400 * 100).count() == 0
    assert backfill_plan(catalog, 86400 * 100).count() == 13
