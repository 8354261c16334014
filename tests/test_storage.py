"""Files in and out, the job, the stream."""

import json
import time

import pytest
from pyspark.sql import functions as F

from barloom.functions.cleaning import candle_columns, with_display_date
from barloom.operators.merge import keep_first
from barloom.plans.collect import TopUp, append_arrived, merged, rejected, top_up
from barloom.plans.features import feature_table
from barloom.plans.job import load_bars, process, run_job
from barloom.plans.updates import series_catalog
from barloom.schema import CANDLE_COLUMNS, INDICATOR_COLUMNS, KEYS, SERIES
from barloom.sinks.tables import (
    PARTITIONS,
    candle_table,
    folder_columns,
    publish,
    rewrite_partitions,
    save,
    save_partitioned,
    save_verified,
)
from barloom.sources.candles import list_files, read_candle_csv
from barloom.sources.pages import failed_pages, page_bars, page_report, parse_pages, read_pages
from barloom.streaming.ingest import BatchReport, IngestListener, start_ingest
from barloom.verify.queries import scratch
from helpers import BAR, noise, rows
from test_tables import PAGES, arrived, prices, stored

HEADER = ",".join(CANDLE_COLUMNS)


def contents(frame):
    names = sorted(frame.columns)
    return sorted(map(tuple, frame.select(*names).collect()), key=str)


def test_csv_scan_nulls_cells_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "BTC_USD_one_hour.csv"
    path.write_text(f"{HEADER}\nd,0,1,2,abc,4,5\nd,x,1,2,3,,NaN\nd,7200,1,2,3,4,5\n")
    got = read_candle_csv(spark, str(path), product_id="BTC-USD", granularity="ONE_HOUR")
    assert [tuple(r)[3:] for r in got.collect()] == [
        (0, 1.0, 2.0, None, 4.0, 5.0),
        (None, 1.0, 2.0, 3.0, None, None),
        (7200, 1.0, 2.0, 3.0, 4.0, 5.0),
    ]
    with pytest.raises(ValueError, match="name the series"):
        read_candle_csv(spark, str(path))


def test_csv_directory_finds_series_by_file_name(spark, tmp_path):
    for name in ("BTC_USD_one_hour", "ETH_USD_one_day"):
        (tmp_path / f"{name}.csv").write_text(f"{HEADER}\nd,0,1,2,3,4,5\n")
    got = read_candle_csv(spark, str(tmp_path), series_catalog(spark))
    assert sorted(tuple(r)[:2] for r in got.collect()) == [
        ("BTC-USD", "ONE_HOUR"),
        ("ETH-USD", "ONE_DAY"),
    ]
    assert list_files(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="2 candle files fit no series or several"):
        read_candle_csv(spark, str(tmp_path), series_catalog(spark, ["BTC-USD", "BTC/USD"]).replace("BTC/USD", "BTC_USD"))
    (tmp_path / "unrelated.csv").write_text(f"{HEADER}\nd,0,1,2,3,4,5\n")
    with pytest.raises(ValueError, match="1 candle files fit no series"):
        read_candle_csv(spark, str(tmp_path), series_catalog(spark))


def test_every_file_is_read_or_an_error(spark, tmp_path):
    for name in ("BTC_USD_one_hour", "SOL_USD_one_day_2024"):
        (tmp_path / f"{name}.csv").write_text(f"{HEADER}\nd,0,1,2,3,4,5\n")
    got = load_bars(spark, str(tmp_path), input_format="csv")
    assert sorted(tuple(r)[:2] for r in got.collect()) == [("BTC-USD", "ONE_HOUR"), ("SOL-USD", "ONE_DAY")]
    # One product and one granularity choose among several files.
    assert load_bars(spark, str(tmp_path), ["SOL-USD"], ["ONE_DAY"], "csv").count() == 1
    assert load_bars(spark, str(tmp_path), ["SOL-USD"], ["ONE_HOUR"], "csv").count() == 0
    (tmp_path / "prices.csv").write_text(f"{HEADER}\nd,0,1,2,3,4,5\n")
    with pytest.raises(ValueError, match="1 of 3 candle files"):
        load_bars(spark, str(tmp_path), ["SOL-USD"], ["ONE_DAY"], "csv")
    with pytest.raises(ValueError, match="cannot read 'orc'"):
        load_bars(spark, str(tmp_path), input_format="orc")


def test_filters_hold_for_keyed_folders(spark):
    path = scratch(spark)
    bars = candle_columns(with_display_date(spark.createDataFrame(rows(noise(9), "BTC-USD") + rows(noise(5), "ETH-USD"), BAR)))
    bars.write.partitionBy(*SERIES).option("header", True).csv(path)
    assert load_bars(spark, path, ["BTC-USD"], input_format="csv").count() == 9
    assert load_bars(spark, path, input_format="csv").count() == 14


def test_product_names_stay_text(spark):
    path, target = scratch(spark), scratch(spark)
    named = lambda pairs: stored(spark, pairs).withColumn("product_id", F.lit("007"))
    save_partitioned(named([(0, 1.0), (3600, 2.0)]), path)
    new = arrived(spark, [(7200, 3.0)]).withColumn("product_id", F.lit("007"))
    rewrite_partitions(spark, merged(candle_table(spark, path), new), path, scratch(spark))
    append_arrived(spark, new.withColumn("start", F.lit("10800")), path)
    assert {tuple(r) for r in candle_table(spark, path).select("product_id", "start").collect()} == {
        ("007", s) for s in (0, 3600, 7200, 10800)
    }
    assert publish(spark, path, target)
    copied = candle_table(spark, target)
    assert contents(copied) == contents(candle_table(spark, path))
    assert folder_columns(spark, target) == folder_columns(spark, path) == list(PARTITIONS)


def test_bars_without_a_key_are_counted_and_kept_apart(spark, caplog):
    path, rejects = scratch(spark), scratch(spark)
    bars = arrived(spark, [(0, 1.0), (3600, 2.0)])
    odd = bars.withColumn("start", F.lit("x")).unionByName(bars.withColumn("product_id", F.lit(None).cast("string")))
    for _ in range(3):
        assert append_arrived(spark, bars.unionByName(odd), path, rejects)
    assert candle_table(spark, path).count() == 2
    assert "4 bars without a series" in caplog.text
    kept = spark.read.parquet(rejects)
    assert kept.count() == 12 and kept.filter("start = 'x'").count() == 6
    assert rejected(bars).count() == 0


@pytest.mark.parametrize("output_format", ["parquet", "CSV"])
def test_round_trip(spark, output_format):
    bars = spark.createDataFrame(rows(noise(50)), BAR)
    path = scratch(spark)
    assert save_verified(bars, path, output_format) == 50
    reader = spark.read.schema(bars.schema).option("header", True)
    back = reader.csv(path) if output_format == "CSV" else spark.read.parquet(path)
    assert contents(back) == contents(bars)


def test_other_formats_are_refused(spark):
    bars = spark.createDataFrame(rows(noise(5)), BAR)
    with pytest.raises(ValueError, match="cannot write 'orc'"):
        save(bars, scratch(spark), "orc")
    with pytest.raises(ValueError, match="cannot write"):
        process(bars, scratch(spark), "json")


def test_partition_overwrite_leaves_other_partitions(spark):
    path = scratch(spark)
    save_partitioned(stored(spark, [(0, 1.0)], "A").unionByName(stored(spark, [(0, 2.0)], "B")), path)
    save_partitioned(stored(spark, [(3600, 3.0)], "B"), path)
    assert prices(candle_table(spark, path)) == [(0, 1.0), (3600, 3.0)]
    save_partitioned(stored(spark, [(0, 4.0)], "C"), path, whole=True)
    assert prices(candle_table(spark, path)) == [(0, 4.0)]


def test_product_names_stay_text(spark):
    path = scratch(spark)
    save_partitioned(stored(spark, [(0, 1.0)], "007"), path)
    assert candle_table(spark, path).first()["product_id"] == "007"


def test_rewrite_a_table_that_is_being_read(spark):
    path = scratch(spark)
    save_partitioned(stored(spark, [(0, 1.0), (3600, 2.0)]), path)
    new = arrived(spark, [(3600, 9.0), (7200, 3.0)])
    rewrite_partitions(spark, merged(candle_table(spark, path), new), path, scratch(spark))
    assert prices(candle_table(spark, path)) == [(0, 1.0), (3600, 2.0), (7200, 3.0)]


def test_append_arrived_is_repeatable(spark):
    path = scratch(spark)
    assert candle_table(spark, path) is None
    for _ in range(2):
        append_arrived(spark, arrived(spark, [(0, 1.0), (3600, 2.0), (0, 5.0)]), path)
    append_arrived(spark, arrived(spark, [(3600, 7.0), (7200, 3.0)]), path)
    assert prices(candle_table(spark, path)) == [(0, 1.0), (3600, 2.0), (7200, 3.0)]


def test_publish(spark, monkeypatch):
    source, target = scratch(spark), scratch(spark)
    bars = spark.createDataFrame(rows(noise(20)), BAR)
    save(bars, source)
    assert publish(spark, source, target)
    assert contents(spark.read.parquet(target)) == contents(bars)
    monkeypatch.setattr("barloom.sinks.tables.save", lambda df, *_: df.count())
    assert not publish(spark, source, scratch(spark))


def test_job_from_csv_files(spark, tmp_path):
    bars = candle_columns(with_display_date(spark.createDataFrame(
        rows(noise(300, 1), "BTC-USD") + rows(noise(220, 2), "ETH-USD"), BAR)))
    for product in ("BTC-USD", "ETH-USD"):
        part = bars.filter(F.col("product_id") == product).select(*CANDLE_COLUMNS).toPandas()
        name = f"{product.replace('-', '_')}_fifteen_minute.csv"
        part.to_csv(tmp_path / name, index=False)
    output = scratch(spark)
    assert run_job(spark, str(tmp_path), output, input_format="csv") == 520
    names = [*KEYS, "close", *INDICATOR_COLUMNS]
    assert contents(spark.read.parquet(output).select(*names)) == contents(
        feature_table(bars).select(*names)
    )
    one = scratch(spark)
    assert run_job(spark, str(tmp_path), one, ["ETH-USD"], partitioned=False, input_format="csv") == 220
    assert "rsi" in spark.read.parquet(one).columns
    csv = scratch(spark)
    file = tmp_path / "prices" / "latest.csv"
    file.parent.mkdir()
    file.write_text((tmp_path / "ETH_USD_fifteen_minute.csv").read_text())
    assert run_job(spark, str(file), csv, ["E"], ["FIFTEEN_MINUTE"], "csv", input_format="csv") == 220


def test_job_from_stored_table(spark):
    path = scratch(spark)  # whatever its name
    save_partitioned(stored(spark, [(3600 * i, float(i)) for i in range(60)]), path)
    assert load_bars(spark, path, ["B"]).count() == 0
    assert load_bars(spark, path, ["A"], ["ONE_HOUR"]).count() == 60
    assert run_job(spark, path, scratch(spark)) == 60


def test_job_stops_when_rows_vanish(spark, monkeypatch):
    path = scratch(spark)
    bars = spark.createDataFrame(rows(noise(5)), BAR)
    assert process(bars, path) == process(bars, path) == 5
    monkeypatch.setattr("barloom.plans.job.feature_table", lambda bars: bars.limit(3))
    with pytest.raises(ValueError, match="5 rows in, 3 rows out"):
        process(bars, path, partitioned=False)
    assert spark.read.parquet(path).filter("rsi_lag1 is null").count() == 5


def test_read_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(PAGES))
    got = page_bars(read_pages(spark, str(tmp_path))).orderBy("arrival")
    assert [r["start"] for r in got.collect()] == ["7200", "3600", "10800", "7200"]


def test_pages_of_any_number_and_length(spark):
    page = json.loads(PAGES[0])
    cells = page["candles"]
    texts = [json.dumps(page | {"page": n, "candles": cells}) for n in (2**43, None, -5)]
    long = json.dumps(page | {"page": 1, "candles": [{"start": "0", "close": "1"}] * 1_200_000})
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    got = keep_first(page_bars(parse_pages(frame)))
    assert got.count() == 2
    many = page_bars(parse_pages(spark.createDataFrame([(long,)], "value string")))
    assert many.agg(F.max("arrival.place")).first()[0] == 1_199_999


def test_page_report_and_strict_stream(spark, tmp_path, caplog):
    lines = [*PAGES, '{"error":"busy","product_id":"A","granularity":"ONE_HOUR"}', '{"product_id":"A", "candl']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    for pages in (
        read_pages(spark, str(tmp_path / "in")),
        parse_pages(spark.createDataFrame([(x,) for x in lines], "value string")),
    ):
        found = {}
        for r in page_report(pages).collect():
            old = found.get(r.status, (0, 0))
            found[r.status] = (old[0] + r.pages, old[1] + r.bars)
        assert found == {"good": (2, 4), "empty": (1, 0), "failed": (2, 0), "unreadable": (1, 0)}
        assert failed_pages(pages) == 3
    table = scratch(spark)
    with pytest.raises(Exception, match="3 pages are unreadable"):
        start_ingest(spark, str(tmp_path / "in"), table, scratch(spark), strict=True).awaitTermination()
    assert candle_table(spark, table) is None
    start_ingest(spark, str(tmp_path / "in"), table, scratch(spark)).awaitTermination()
    assert candle_table(spark, table).count() == 3 and "3 pages are unreadable" in caplog.text


def test_stream_equals_batch(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "in", scratch(spark), scratch(spark)
    landing.mkdir()

    def run():
        start_ingest(spark, str(landing), table, checkpoint, files_per_batch=1).awaitTermination()

    (landing / "1.json").write_text(PAGES[0] + "\n" + PAGES[2])
    run()
    assert prices(candle_table(spark, table)) == [(3600, 2.0), (7200, 1.0)]
    run()
    (landing / "2.json").write_text(PAGES[1] + "\n" + PAGES[3])
    late = json.loads(PAGES[0])
    late["page"], late["candles"] = 9, [dict.fromkeys(("low", "high", "open", "close", "volume"), "8")]
    late["candles"][0]["start"] = "0"
    (landing / "3.json").write_text(json.dumps(late))
    run()
    expected = [(0, 8.0), (3600, 2.0), (7200, 1.0), (10800, 3.0)]
    assert prices(candle_table(spark, table)) == expected
    assert candle_table(spark, table).select(*SERIES).distinct().count() == 1


def test_top_up_reads_only_the_stretch_it_needs(spark):
    path = scratch(spark)
    days = [(86400 * 300 * i, float(i)) for i in range(20)]
    save_partitioned(stored(spark, days), path)
    stretch = candle_table(spark, path, 86400 * 400, 86400 * 1000)
    assert prices(stretch) == days[2:4]
    plan = stretch._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "GreaterThanOrEqual(start" in plan
    assert not append_arrived(spark, arrived(spark, []), path)
    assert append_arrived(spark, arrived(spark, [(86400 * 600, 9.0), (86400 * 601, 8.0)]), path)
    assert len(prices(candle_table(spark, path))) == 21


@pytest.mark.parametrize("kept", [False, True])
def test_a_batch_is_evaluated_once_and_counted_by_what_writes_it(spark, tmp_path, kept):
    bad = ['{"error":"busy","product_id":"A","granularity":"ONE_HOUR"}', '{"product_id":"A", "candl']
    odd = PAGES[0].replace('"start"', '"begin"')
    landing, table, checkpoint = tmp_path / "in", scratch(spark), scratch(spark)
    rejects = scratch(spark) if kept else None
    landing.mkdir()
    (landing / "1.json").write_text("\n".join([*PAGES, *bad, odd]))
    reports, listener = [], IngestListener()
    spark.streams.addListener(listener)
    try:
        query = start_ingest(spark, str(landing), table, checkpoint, rejects_path=rejects, report=reports.append)
        query.awaitTermination()
        (landing / "2.json").write_text("\n".join(PAGES))
        again = start_ingest(spark, str(landing), table, checkpoint, report=reports.append)
        again.awaitTermination()
        late = time.monotonic() + 60
        while len(listener.batches) < 2 and time.monotonic() < late:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    lost = len(json.loads(PAGES[0])["candles"])
    good = sum(len(json.loads(page).get("candles") or []) for page in PAGES)
    stored_bars = candle_table(spark, table).count()
    n, failed = len(PAGES), 1  # one of the pages has no list
    assert reports == [
        BatchReport(0, n + 3, failed + 2, TopUp(good + lost, lost, stored_bars)),
        BatchReport(1, n, failed, TopUp(good, 0, 0)),
    ]
    # A second evaluation of a batch would count its pages again.
    assert [b[1:] for b in listener.batches] == [(0, n + 3, failed + 2, good + lost), (1, n, failed, good)]
    if kept:
        assert spark.read.parquet(rejects).count() == lost


def test_top_up_counts_what_it_writes(spark):
    path = scratch(spark)
    bars = arrived(spark, [(0, 1.0), (3600, 2.0), (0, 5.0)])
    odd = bars.withColumn("start", F.lit("x"))
    assert top_up(spark, bars.unionByName(odd), path) == TopUp(6, 3, 2)
    assert top_up(spark, bars, path) == TopUp(3, 0, 0)
    assert top_up(spark, arrived(spark, [(3600, 7.0), (7200, 3.0)]), path) == TopUp(2, 0, 1)
    assert top_up(spark, odd, path) == TopUp(3, 3, 0)

    def refuse():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        top_up(spark, arrived(spark, [(86400, 7.0)]), path, before_writing=refuse)
    assert candle_table(spark, path).count() == 3
