import pytest

import brute
from barloom.operators import indicators as ind
from barloom.operators.chunks import Decay, _chunk_states, chunk_bars, index_bars
from barloom.plans.features import feature_table
from barloom.schema import CALENDAR_COLUMNS, INDICATOR_COLUMNS
from helpers import BAR, assert_close, column, flat, noise, ramp, rows

SERIES = {"A": noise(900, 1), "B": noise(431, 2, 5000.0), "C": noise(10, 3), "D": noise(1, 4)}


def table(spark, series=None, partitions=3, granularity="FIFTEEN_MINUTE"):
    data = [r for name, bars in (series or SERIES).items() for r in rows(bars, name, granularity)]
    return spark.createDataFrame(data[::-1], BAR).repartition(partitions)


@pytest.mark.parametrize(
    "core, bucket", [(64, 50), (377, 8), (3584, 65536)], ids=["short", "odd", "default"]
)
def test_features_equal_bar_by_bar_computation(spark, core, bucket):
    got = feature_table(table(spark), core=core, bucket_bars=bucket).cache()
    assert got.count() == sum(len(bars) for bars in SERIES.values())
    for product, bars in SERIES.items():
        for name, expected in brute.features(bars).items():
            assert_close(column(got, name, product), expected, 1e-8, f"{product}.{name}")


def test_column_order(spark):
    got = feature_table(table(spark))
    bars = ["product_id", "granularity", "start", "open", "high", "low", "close", "volume"]
    assert got.columns == [*bars, *CALENDAR_COLUMNS, *INDICATOR_COLUMNS]


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitioning_and_batching_do_not_matter(spark, partitions):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = ind.add_indicators(
            table(spark, {"A": SERIES["A"]}, partitions), ind.rsi(), ind.sma(14), core=100
        ).cache()
        assert_close(column(got, "rsi"), brute.rsi([b["close"] for b in SERIES["A"]]))
        assert_close(column(got, "sma_14"), brute.sma([b["close"] for b in SERIES["A"]], 14))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_single_indicators(spark):
    bars = SERIES["A"]
    closes = [b["close"] for b in bars]
    got = ind.add_indicators(
        table(spark, {"A": bars}),
        ind.ema(),
        ind.ewm_rsi(),
        ind.super_smoother(),
        ind.kijun(60, 3),
        ind.stochastic("close", 50, "stoch"),
        ind.minmax_position("close", 20, "place"),
        ind.true_range(),
        ind.lag_of("close", 2),
        ind.sma(97),
        core=128,
    ).cache()
    assert_close(column(got, "ema_20"), brute.ema(closes))
    assert_close(column(got, "ewm_rsi"), brute.ewm_rsi(closes))
    assert_close(column(got, "super_smoother"), brute.smoother(closes))
    assert_close(column(got, "kijun_v2_60_3"), brute.kijun(bars, 60, 3))
    assert_close(column(got, "stoch"), brute.stochastic(closes, 50))
    assert_close(column(got, "place"), brute.position(closes, 20))
    assert_close(column(got, "true_range"), brute.true_range(bars))
    assert_close(column(got, "close_lag2"), brute.lagged(closes, 2))
    assert_close(column(got, "sma_97"), brute.sma(closes, 97))


def test_flat_series(spark):
    got = feature_table(table(spark, {"A": flat(400)}), core=64).cache()
    assert column(got, "rsi")[13:16] == [None, 0.0, 0.0]
    assert column(got, "atr")[399] == 0.0
    assert column(got, "rsi_pct")[13:16] == [None, 0.5, 0.5]
    assert set(column(got, "es_stoch_rsi_k")) == {0.0}
    assert column(got, "sma_50")[399] == 5.0


def test_flat_tail_keeps_its_ratio(spark):
    """Thousands of quiet bars: both means fade together, their ratio stays."""
    bars = noise(200, 5, gaps=False)
    last = bars[-1]
    for i in range(1, 3000):
        still = dict.fromkeys(("open", "high", "low", "close"), last["close"])
        bars.append({"start": last["start"] + 900 * i, **still})
    got = ind.add_indicators(table(spark, {"A": bars}), ind.rsi(), core=256)
    assert_close(column(got, "rsi"), brute.rsi([b["close"] for b in bars]), 1e-7)


def test_ramp_has_full_strength(spark):
    got = feature_table(table(spark, {"A": ramp(60)}))
    assert column(got, "rsi")[14:] == [100.0] * 46
    assert column(got, "sma_14")[13] == pytest.approx(sum(range(2, 16)) / 14)
    assert column(got, "macd")[:33] == [None] * 33
    assert column(got, "macd")[33] == pytest.approx(7.0)


def test_short_series_has_only_the_ehlers_lines(spark):
    got = feature_table(table(spark, {"A": ramp(10)}))
    for name in INDICATOR_COLUMNS:
        values = column(got, name)
        assert (None not in values) if name.startswith("es_") else (set(values) == {None})


@pytest.mark.parametrize("core", [32, 3584])
def test_missing_cells(spark, core):
    bars = noise(500, 7)
    bars[30]["close"] = None
    bars[100]["high"] = None
    got = feature_table(table(spark, {"A": bars}), core=core).cache()
    expected = brute.features(bars)
    for name in INDICATOR_COLUMNS:
        assert_close(column(got, name), expected[name], 1e-8, name)
    assert column(got, "rsi")[29] is not None and column(got, "rsi")[30] is None
    assert column(got, "atr")[30] is not None and column(got, "atr")[31] is None
    assert column(got, "sma_14")[44] is not None and column(got, "sma_14")[43] is None


def test_zero_price_counts_as_no_move(spark):
    bars = noise(80, 8)
    bars[40]["close"] = 0.0
    got = feature_table(table(spark, {"A": bars}))
    assert_close(column(got, "es_stoch_rsi_k"), brute.k_line([b["close"] for b in bars]))


def test_bounds(spark):
    got = feature_table(table(spark))
    checks = got.selectExpr(
        "count_if(rsi not between 0 and 100) AS a",
        "count_if(rsi_pct not between 0 and 1) AS b",
        "count_if(atr < 0) AS c",
    ).first()
    assert tuple(checks) == (0, 0, 0)


def test_bars_without_keys_are_kept_without_features(spark):
    data = rows(SERIES["A"][:50]) + [
        ("A", "FIFTEEN_MINUTE", None, 1.0, 2.0, 3.0, float(i), 1.0) for i in range(20)
    ]
    data.append((None, "FIFTEEN_MINUTE", 900, 1.0, 2.0, 3.0, 4.0, 1.0))
    got = feature_table(spark.createDataFrame(data, BAR)).collect()
    assert len(got) == 71
    unplaced = [r for r in got if r["start"] is None or r["product_id"] is None]
    assert len(unplaced) == 21
    assert all(r[name] is None for r in unplaced for name in INDICATOR_COLUMNS)


def test_positions_span_buckets(spark):
    got = index_bars(table(spark, {"A": SERIES["A"]}), bucket_bars=16)
    assert column(got, "_pos") == list(range(900))
    closes = [b["close"] for b in SERIES["A"]]
    assert column(got, "_prev_close") == [None, *closes[:-1]]


def test_unknown_granularity_is_placed_by_the_second(spark):
    bars = table(spark, {"A": SERIES["B"]}, granularity="FIVE_MINUTE")
    got = feature_table(bars, core=64)
    assert_close(column(got, "rsi"), brute.rsi([b["close"] for b in SERIES["B"]]))


def test_negative_starts(spark):
    bars = [{**b, "start": b["start"] - 1_710_000_000} for b in SERIES["A"]]
    assert bars[0]["start"] < 0 < bars[-1]["start"]
    got = index_bars(table(spark, {"A": bars}), bucket_bars=7)
    assert column(got, "_pos") == list(range(900))


def test_halo_copies_are_bounded(spark):
    got = chunk_bars(table(spark, {"A": SERIES["A"]}), lookback=10, core=100)
    assert got.count() == 900 + 8 * 10
    assert got.filter("_core").count() == 900


LONG = noise(6_000, seed=5)


@pytest.mark.parametrize(
    "make",
    [
        lambda: ind.rsi(2), lambda: ind.rsi(3), lambda: ind.ema(3), lambda: ind.ema(5), lambda: ind.ema(1),
        lambda: ind.atr(2), lambda: ind.ewm_rsi(2), lambda: ind.rsi(1),
        lambda: ind.super_smoother(n=5), lambda: ind.super_smoother(n=10), lambda: ind.super_smoother(n=12),
        lambda: ind.es_stoch_rsi_k(3, 5, 60),
    ],
)
def test_no_period_is_too_short_for_a_chunk(spark, make):
    bars = table(spark, {"A": LONG})
    name = make().outputs[0]
    blocks = column(ind.add_indicators(bars, make(), core=20_000), name)
    short = column(ind.add_indicators(bars, make(), core=150), name)
    assert_close(blocks, short, 1e-8, name)
    if name == "rsi_2":
        assert_close(blocks, brute.rsi([b["close"] for b in LONG], 2))


def test_long_and_short_periods_together(spark):
    bars = table(spark, {"A": LONG})
    both = ind.add_indicators(bars, *ind.standard_indicators(), ind.sma(2300), ind.rsi(2))
    alone = ind.add_indicators(bars, *ind.standard_indicators())
    closes = [b["close"] for b in LONG]
    assert_close(column(both, "sma_2300")[2299:2310], [sum(closes[i - 2299 : i + 1]) / 2300 for i in range(2299, 2309)] + [sum(closes[10:2310]) / 2300])
    for name in ("rsi", "atr", "es_stoch_rsi_d", "macd_signal"):
        assert_close(column(both, name), column(alone, name), 1e-8, name)
    assert_close(column(both, "rsi_2"), brute.rsi(closes, 2))


CHAINS = {
    "sma_14_lag3": lambda: [ind.sma(14), ind.lag_of("sma_14", 3)],
    "sma_50_pct": lambda: [ind.sma(50), ind.minmax_position("sma_50", 20)],
    "wave": lambda: [ind.macd(), ind.stochastic("macd", 50, "wave")],
    "far": lambda: [ind.sma(14), ind.lag_of("sma_14", 9), ind.minmax_position("sma_14_lag9", 30, "far")],
    "smooth": lambda: [ind.sma(20), ind.super_smoother("sma_20", 8, "smooth")],
}


@pytest.mark.parametrize("name", CHAINS)
@pytest.mark.parametrize("core", [7, 64])
def test_chained_indicators_do_not_depend_on_chunks(spark, name, core):
    bars = table(spark, {"A": SERIES["A"]})
    whole = column(ind.add_indicators(bars, *CHAINS[name](), core=3_584), name)
    cut = column(ind.add_indicators(bars, *CHAINS[name](), core=core), name)
    assert_close(cut, whole, 1e-7, name)


def test_two_of_a_kind_and_conflicts(spark):
    bars = table(spark, {"A": SERIES["A"]})
    got = ind.add_indicators(bars, ind.rsi(14), ind.rsi(7), ind.macd(), ind.macd(5, 35, 5), ind.rsi(14))
    closes = [b["close"] for b in SERIES["A"]]
    assert_close(column(got, "rsi"), brute.rsi(closes, 14))
    assert_close(column(got, "rsi_7"), brute.rsi(closes, 7))
    assert_close(column(got, "macd"), column(ind.add_indicators(bars, ind.macd()), "macd"))
    assert "macd_5_35_5_signal" in got.columns
    with pytest.raises(ValueError, match="two ways"):
        ind.add_indicators(bars, ind.rsi(14), ind.rsi(7, out="rsi"))


def test_further_columns_may_have_any_plain_name(spark):
    bars = table(spark, {"A": SERIES["A"]})
    for name in ("age", "pos", "chunk", "prev_close", "core"):
        bars = bars.withColumn(name, bars["close"] * 2)
    got = ind.add_indicators(bars, ind.rsi(), ind.sma(14), ind.change())
    assert_close(column(got, "age"), [2 * b["close"] for b in SERIES["A"]])
    with pytest.raises(ValueError, match="reserved"):
        ind.add_indicators(bars.withColumn("_pos", bars["close"]), ind.rsi())


def test_projections_need_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "bars")
    table(spark).write.parquet(path)
    bars = spark.read.parquet(path)
    plan = lambda *items: ind.add_indicators(bars, *items)._jdf.queryExecution().executedPlan().toString()
    flat_plan = plan(ind.log_price(), ind.clip("close", 1.0, 2.0, "held"))
    assert "Exchange" not in flat_plan and "Window" not in flat_plan
    assert "_chunk" not in plan(ind.true_range(), ind.change())
    assert "ShuffledHashJoin" not in plan(ind.rsi())


def test_states_go_only_to_chunks_there_are(spark):
    indexed = index_bars(table(spark, {"A": SERIES["A"]}))
    assert _chunk_states(indexed, [Decay("x", 0.9, "close")], 10, 3_584).count() == 0
    assert _chunk_states(indexed, [Decay("x", 0.99, "close")], 10, 100).count() == 8


def test_no_window_is_partitioned_by_series_alone(spark):
    """Only the one-row-per-bucket table may be ordered over a whole series."""
    plan = feature_table(table(spark))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line:
            spec = line[line.rindex("], [product_id") :]
            assert "chunk" in spec or "_bucket" in spec or "[sum(_n#" in line
    assert "PythonUDF" not in plan and "InPandas" not in plan


def test_repeated_keys_are_bars_of_their_own(spark):
    bars = sorted(
        [{**b} for b in SERIES["B"]] + [{**b} for b in SERIES["B"][50:60]] * 2,
        key=lambda b: (b["start"], b["close"]),
    )
    got = feature_table(table(spark, {"A": bars}, 5), core=64).collect()
    assert len(got) == len(bars)
    expected = brute.features(bars)
    order = sorted(got, key=lambda r: (r["start"], r["rsi_lag1"] or 0))
    assert_close([r["sma_50"] for r in order][-300:], expected["sma_50"][-300:])
    assert_close([r["rsi"] for r in order][-300:], expected["rsi"][-300:])


def test_scan_reads_only_the_columns_used(spark, tmp_path):
    path = str(tmp_path / "bars")
    table(spark).write.parquet(path)
    got = ind.add_indicators(spark.read.parquet(path), ind.sma(14), ind.rsi())
    picked = got.select("product_id", "granularity", "start", "sma_14", "rsi")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas
    for line in schemas:
        read = line[line.index("ReadSchema") :]
        assert not any(f"{name}:" in read for name in ("open", "high", "low", "volume")), read


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_feature_table_shuffles_its_bars_once(spark, tmp_path, limit):
    path = str(tmp_path / "bars")
    table(spark, {"A": noise(700), "B": noise(90)}).write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        frame = feature_table(spark.read.parquet(path), core=100)
        got = frame.orderBy("product_id", "start").collect()
        want = feature_table(spark.read.parquet(path), core=1000).orderBy("product_id", "start").collect()
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Bucket totals, bars, and bars without a key; the states read the exchange of the bars.
    assert plan.count("FileScan") == 3
    assert plan.count("ReusedExchange") >= 1
    assert len(got) == len(want) == 790
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or x == pytest.approx(y, rel=1e-6, abs=1e-9)
