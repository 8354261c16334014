"""Slot bitmaps, holes and their repair, digests of copies, rejects of CSV scans."""

import random
from collections import Counter

import pytest
from helpers import BAR, noise, rows
from pyspark.sql import functions as F

from barloom.operators import quality
from barloom.functions.cleaning import with_display_date
from barloom.plans.updates import holes, load_mode, repair_plan, stored_load_mode, stored_update_plan, update_plan
from barloom.schema import PERIOD_SECONDS
from barloom.sinks import tables
from barloom.sources.candles import csv_rejects, read_candle_csv, reject_counts

KEYED = "product_id string, granularity string, start long, close double"


def keyed_rows(draw, n):
    starts = [0, 900, -900, 1_700_000_100, 1_700_001_000, 901, None, 900 * 32_768, 900 * 32_767, -(1 << 62), (1 << 62) + 1]
    starts += [86_400 * i for i in range(-3, 30)] + [900 * draw.randrange(-70_000, 70_000) for _ in range(200)]
    kinds = ["FIFTEEN_MINUTE", "FIFTEEN_MINUTE", "ONE_DAY", "ODD", None]
    return [
        (draw.choice(["A", "A", "B", None]), draw.choice(kinds), draw.choice(starts), draw.choice([1.0, None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed, n", [(1, 0), (2, 40), (3, 1500)])
def test_repeats_and_nulls_as_counted_one_by_one(spark, seed, n):
    made = keyed_rows(random.Random(seed), n)
    frame = spark.createDataFrame(made, KEYED).repartition(3)
    times = Counter(r[:3] for r in made)
    want = {}
    for product, granularity, start, close in made:
        total, no_start, no_close = want.get((product, granularity), (0, 0, 0))
        want[product, granularity] = total + 1, no_start + (start is None), no_close + (close is None)
    repeats = Counter(k[:2] for k, c in times.items() if c > 1)
    got = quality.quality_report(frame, "x").collect()
    assert len(got) == len(want)
    for r in got:
        key = r.product_id, r.granularity
        assert (r.total, r.null_start, r.null_close, r.stage) == (*want[key], "x")
        assert r.duplicate_starts == repeats[key], key
    assert {(r.product_id, r.granularity): r.duplicate_starts for r in quality.duplicate_keys(frame).collect()} == {
        k: repeats[k] for k in want
    }
    alone = quality.duplicate_keys(frame.select("start")).collect()
    assert [r.duplicate_starts for r in alone] == ([sum(c > 1 for c in Counter(r[2] for r in made).values())] if made else [0]) or not made


def test_a_clean_table_shuffles_buckets_not_bars(spark):
    bars = spark.range(200_000).selectExpr(
        "if(id % 2 = 0, 'A', 'B') AS product_id", "'FIFTEEN_MINUTE' AS granularity", "id div 2 * 900 AS start", "1D AS close"
    )
    assert quality.bucket_counts(bars, []).count() == 8
    report = quality.quality_report(bars, "x")
    assert [r.duplicate_starts for r in report.collect()] == [0, 0]
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and plan.count("Range (") == 1  # no key was looked for
    twice = bars.unionByName(bars.filter("start = 1800 and product_id = 'A'"))
    assert {r.product_id: r.duplicate_starts for r in quality.quality_report(twice, "x").collect()} == {"A": 1, "B": 0}
    found = {r.product_id: tuple(r)[2:] for r in quality.missing_bars(twice.filter("start % 9000 > 0")).collect()}
    assert found["A"] == (900, 99_999 * 900, 90_000, 9_999)


def catalog_of(spark, series):
    named = [(p, g, PERIOD_SECONDS[g], n) for p, g, n in series]
    return spark.createDataFrame(named, "product_id string, granularity string, period_s long, target_bars int")


def test_repair_asks_for_every_missing_bar_and_no_other(spark):
    draw, period, now = random.Random(4), 900, 1_700_000_000
    cutoff = now - now % period
    span = [cutoff - i * period for i in range(2001)][::-1]
    inside = [s for s in span[50:-30] if draw.random() < 0.97 and not 700 < (s - span[0]) / period < 1500]
    stored = {"A": inside, "B": span, "C": span[:1] + [span[0] - 90_000], "D": [], "E": [span[0] - 900]}
    made = [(p, "FIFTEEN_MINUTE", s, 1.0) for p, starts in stored.items() for s in starts]
    history = spark.createDataFrame(made, KEYED)
    catalog = catalog_of(spark, [(p, "FIFTEEN_MINUTE", 2000) for p in stored] + [("F", "FIFTEEN_MINUTE", 0)])
    asked = {p: Counter() for p in stored}
    for r in repair_plan(catalog, history, now).collect():
        assert r.request_start <= r.request_end <= r.request_start + 340 * period
        for s in range(r.request_start, r.request_end + 1, period):
            asked[r.product_id][s] += 1
    for p, starts in stored.items():
        assert set(asked[p]) == set(span) - set(starts), p
    kinds = {(r.product_id, r.hole) for r in holes(catalog, history, now).collect()}
    assert kinds == {("A", "start"), ("A", "inside"), ("A", "end"), ("C", "end"), ("D", "all"), ("E", "all")}
    assert repair_plan(catalog.limit(0), history, now).count() == 0
    assert repair_plan(catalog, history.limit(0), now).select("product_id").distinct().count() == 5


def test_a_copy_with_another_value_is_refused(spark, tmp_path, monkeypatch, caplog):
    bars = spark.createDataFrame(rows(noise(300, 3)), BAR)
    source, target, altered = (str(tmp_path / name) for name in ("source", "target", "altered"))
    assert tables.save_verified(bars, source, partitioned=True) == 300
    assert tables.publish(spark, source, target) and tables.same_content(spark, source, target)
    shuffled = tables.read_back(spark, source).repartition(5).select("volume", *[c for c in bars.columns if c != "volume"], "year")
    shuffled.write.parquet(str(tmp_path / "order"))
    assert tables.same_content(spark, source, str(tmp_path / "order"))
    one = bars.agg(F.max("start")).first()[0]
    changed = bars.withColumn("close", F.when(F.col("start") == one, F.col("close") + 1e-9).otherwise(F.col("close")))
    tables.save_partitioned(changed, altered)
    assert tables.read_back(spark, altered).count() == 300 and not tables.same_content(spark, source, altered)
    assert not tables.same_content(spark, source, str(tmp_path / "nowhere"))

    whole = tables.read_back

    def spoilt(session, path, output_format="parquet"):
        found = whole(session, path, output_format)
        return found if path == source else found.withColumn("close", F.expr(f"if(start = {one}, 0D, close)"))

    monkeypatch.setattr(tables, "read_back", spoilt)
    assert not tables.publish(spark, source, str(tmp_path / "again")) and "other values" in caplog.text
    with pytest.raises(ValueError, match="not those that were written"):
        tables.save_verified(bars, str(tmp_path / "third"))


def test_digest_of_empty_and_repeated_rows(spark):
    bars = spark.createDataFrame(rows(noise(5, 3)), BAR)
    none = tables.content_digest(bars.limit(0))
    assert (none["rows"], none["mix"]) == (0, 0)
    twice = tables.content_digest(bars.union(bars))
    assert twice["mix"] == 0 and twice["total"] == 2 * tables.content_digest(bars)["total"]


CSV = """date,start,open,high,low,close,volume
d,900,1,2,0.5,1.5,7
d,1800,x,2,0.5,1.5,7
d,2700,1,,0.5,1.5,
d,later,1,two,0.5,1.5,7
d,3600,1,2
d,4500,1,2,0.5,1.5,7,8
"""


def test_rejects_of_a_csv_scan(spark, tmp_path):
    folder = tmp_path / "csv"
    for product in ("A", "B"):
        place = folder / f"product_id={product}" / "granularity=ONE_DAY"
        place.mkdir(parents=True)
        (place / "part.csv").write_text(CSV if product == "A" else CSV.split("\n", 2)[0] + "\nd,900,1,2,0.5,1.5,7\n")
    found = csv_rejects(spark, str(folder)).orderBy("record").collect()
    assert [(r.product_id, r.record, r.failed) for r in found] == [
        ("A", "d,1800,x,2,0.5,1.5,7", ["open"]),
        ("A", "d,3600,1,2", ["cells"]),
        ("A", "d,4500,1,2,0.5,1.5,7,8", ["cells"]),
        ("A", "d,later,1,two,0.5,1.5,7", ["start", "high"]),
    ]
    assert all(r.file.endswith("part.csv") for r in found)
    counts = {r.column: r.records for r in reject_counts(csv_rejects(spark, str(folder))).collect()}
    assert counts == {"open": 1, "start": 1, "high": 1, "cells": 2}
    assert read_candle_csv(spark, str(folder)).count() == 7
    single = csv_rejects(spark, str(folder / "product_id=A" / "granularity=ONE_DAY" / "part.csv"))
    assert single.count() == 4 and "product_id" not in single.columns


def test_plans_of_a_stored_table_read_no_older_year(spark, tmp_path):
    day, names = 86_400, ["007", "A+B", "x y%z", "late"]
    made = [
        (p, "ONE_DAY", day * (19_000 + 40 * i - (700 if p == "late" else 0)), 1.0, 1.0, 1.0, 1.0, 1.0)
        for p in names
        for i in range(30)
    ]
    bars = with_display_date(spark.createDataFrame(made, BAR))
    path, now = str(tmp_path / "table"), day * 20_400
    catalog = catalog_of(spark, [(p, "ONE_DAY", 100) for p in [*names, "new"]])
    assert {r.load_mode for r in stored_load_mode(catalog, path).collect()} == {"initial"}
    assert {r.status for r in stored_update_plan(catalog, path, now).collect()} == {"no_history"}
    tables.save_partitioned(bars, path)
    assert sorted(stored_load_mode(catalog, path).collect()) == sorted(load_mode(catalog, bars).collect())
    found = stored_update_plan(catalog, path, now)
    assert sorted(map(str, found.collect())) == sorted(map(str, update_plan(catalog, bars, now).collect()))
    assert len(found.inputFiles()) < len(spark.read.parquet(path).inputFiles())
    folders = tables.stored_folders(spark, path)
    assert sorted({r.product_id for r in folders.collect()}) == sorted(names)
    # What lies in older years is not looked at: broken files there go unnoticed.
    newest = {(r.product_id, r.year) for r in folders.groupBy("product_id").agg(F.max("year").alias("year")).collect()}
    for file in (tmp_path / "table").rglob("year=*/*.parquet"):
        product = file.parts[-4].split("=")[1].replace("%25", "%")
        if (product, int(file.parts[-2].split("=")[1])) not in newest:
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"broken")
    again = stored_update_plan(catalog, path, now)
    assert sorted(map(str, again.collect())) == sorted(map(str, update_plan(catalog, bars, now).collect()))
    flat = str(tmp_path / "flat")
    bars.write.parquet(flat)
    assert {r.last_start for r in tables.newest_starts(spark, flat).collect()} == {
        r[0] for r in bars.groupBy("product_id").agg(F.max("start")).select("max(start)").collect()
    }
