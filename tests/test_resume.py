"""Features that go on from stored state equal those of one run."""

import pytest
from helpers import BAR, assert_close, column, noise, rows
from pyspark.sql import functions as F

import brute
from barloom.operators import indicators as ind
from barloom.plans.features import feature_table
from barloom.plans.resume import feature_state, load_state, save_state, top_up_features
from barloom.schema import INDICATOR_COLUMNS, KEYS


def table(spark, series):
    return spark.createDataFrame([r for name, bars in series.items() for r in rows(bars, name)], BAR)


def rows_of(frame):
    shown = [*KEYS, *[F.round(F.col(c), 6).alias(c) for c in INDICATOR_COLUMNS]]
    return sorted(map(tuple, frame.select(*shown).collect()), key=str)


def series():
    """A long series, one that begins late, a short one, and one with missing cells."""
    long, late, holes = noise(1500, 3), noise(700, 4)[420:], noise(900, 5)
    holes[600]["close"] = None
    holes[700]["high"] = None
    return {"A": long, "B": late, "C": noise(9, 6), "D": holes}


def cut(bars, edges):
    low, high = bars.agg(F.min("start"), F.max("start")).first()
    places = [low + int((high - low) * e) for e in edges]
    for a, b in zip([low, *places], [*places, high + 1]):
        yield bars.filter((F.col("start") >= a) & (F.col("start") < b))


@pytest.mark.parametrize("core", [None, 900])
def test_parts_from_state_equal_one_run(spark, tmp_path, core):
    bars = table(spark, series()).cache()
    state, got = None, []
    for i, part in enumerate(cut(bars, (0.002, 0.1, 0.5, 0.55))):
        got += rows_of(feature_table(part, core=core, before=state))
        save_state(feature_state(part, state), str(tmp_path / "state"))
        state = load_state(spark, str(tmp_path / "state"))
    assert sorted(got, key=str) == rows_of(feature_table(bars, core=core))
    assert state.tail.groupBy("product_id").count().agg(F.max("count")).first()[0] <= 400


def test_top_ups_repeat_and_fail_without_a_trace(spark, tmp_path):
    bars = table(spark, series()).cache()
    state, path, old = (str(tmp_path / name) for name in ("state", "features", "old"))
    first, second, third = cut(bars, (0.4, 0.8))
    assert top_up_features(spark, first, state, path) == {"added": first.count(), "late": 0}
    save_state(load_state(spark, state), old)
    assert top_up_features(spark, second, state, path)["added"] == second.count()
    # The same again adds nothing, also where the state did not get its place.
    assert top_up_features(spark, second, state, path) == {"added": 0, "late": second.count()}
    save_state(load_state(spark, old), state)
    assert top_up_features(spark, second, state, path)["added"] == second.count()
    assert top_up_features(spark, third.unionByName(second.limit(3)), state, path) == {"added": third.count(), "late": 3}
    assert top_up_features(spark, third.limit(0), state, path) == {"added": 0, "late": 0}
    assert rows_of(spark.read.parquet(path)) == rows_of(feature_table(bars))


def test_a_top_up_reads_state_and_new_bars_only(spark, tmp_path):
    bars = table(spark, {"A": noise(3000, 3)})
    old, new = cut(bars, (0.9,))
    old.write.parquet(str(tmp_path / "old"))
    new.write.parquet(str(tmp_path / "new"))
    save_state(feature_state(spark.read.parquet(str(tmp_path / "old"))), str(tmp_path / "state"))
    state = load_state(spark, str(tmp_path / "state"))
    fresh = spark.read.parquet(str(tmp_path / "new"))
    for made in (feature_table(fresh, before=state), feature_state(fresh, state).sums):
        files = {f.split("/")[-3] + "/" + f.split("/")[-2] for f in made.inputFiles()}
        assert {f.rsplit("/", 1)[1] for f in files} <= {"new", "tail", "sums"}
    assert state.tail.count() < 400 and state.sums.count() == 1


def test_rows_without_a_key_keep_their_row(spark):
    bars = table(spark, {"A": noise(600, 3)})
    old, new = cut(bars, (0.8,))
    state = feature_state(old)
    odd = new.limit(2).withColumn("start", F.lit(None).cast("long"))
    got = feature_table(new.unionByName(odd), before=state)
    assert got.count() == new.count() + 2
    assert got.filter("start is null and sma_14 is null").count() == 2


@pytest.mark.parametrize("n", [2, 5, 20, 200, 1000])
@pytest.mark.parametrize("core", [64, 512, None])
def test_the_smoother_of_the_close_is_carried_exactly(spark, n, core):
    closes = [b["close"] for b in noise(1400, 9)]
    item = ind.super_smoother(n=n, out="f")
    assert ind.whole_lookback([item]) == 0
    got = ind.add_indicators(table(spark, {"A": noise(1400, 9)}), item, core=core)
    assert_close(column(got, "f"), brute.smoother(closes, n), 1e-7)


def test_any_indicators_go_on_from_their_state(spark):
    items = [ind.super_smoother(n=300, out="f"), ind.ema(20), ind.rsi(2), ind.sma(30), ind.super_smoother("sma_30", 12, "g")]
    bars = table(spark, {"A": noise(1200, 7), "B": noise(40, 8)}).cache()
    old, new = cut(bars, (0.6,))
    names = [*KEYS, "f", "ema_20", "rsi_2", "sma_30", "g"]
    shown = lambda frame: sorted(
        [tuple(r) for r in frame.select(*names[:3], *[F.round(c, 6).alias(c) for c in names[3:]]).collect()], key=str
    )
    whole = shown(ind.add_indicators(bars, *items, core=600))
    state = ind.state_after(old, *items)
    assert shown(ind.add_indicators(old, *items, core=600)) + shown(
        ind.add_indicators(new, *items, core=600, before=state)
    ) == sorted(whole, key=lambda r: (r[2] >= new.agg(F.min("start")).first()[0], str(r)))
