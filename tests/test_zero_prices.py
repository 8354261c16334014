import math

import pytest
from pyspark.sql import functions as F

import brute
from barloom.operators import indicators as ind
from barloom.operators.chunks import State
from barloom.plans.features import feature_table
from barloom.verify.oracles import ORACLES
from barloom.verify.queries import QUERIES
from helpers import BAR, assert_close, noise, rows

NAN, INF = math.nan, math.inf


def odd(changes, n=420, seed=3):
    """Bars with other closes at some places."""
    bars = noise(n, seed)
    for at, close in changes.items():
        bars[at]["close"] = close
    return bars


SERIES = {
    "plain": odd({}),
    "once": odd({200: 0.0}, seed=4),
    "twice": odd({200: 0.0, 201: 0.0}),
    "first": odd({0: 0.0}),
    "first and later": odd({0: 0.0, 300: 0.0}),
    "last": odd({419: 0.0}),
    "below": odd({150: -2.0}),
    "alone": odd({120: None, 121: 0.0, 122: None}),
    "then none": odd({**dict.fromkeys(range(100, 420), None), 99: 0.0}),
    "only": odd({0: 0.0}, n=1),
    "short": odd({4: 0.0}, n=9),
}


def log(x):
    return None if x is None else -INF if x == 0 else NAN if x < 0 else math.log(x)


def strengths(closes, n=70):
    """``brute.ewm_rsi`` with the logs and quotients of floating-point arithmetic."""
    moves = [0.0 if m is None else m for m in brute.changes([log(c) for c in closes])]
    up = brute.ewm([m if m > 0 or m != m else 0.0 for m in moves], n)
    down = brute.ewm([-m if m < 0 or m != m else 0.0 for m in moves], n)
    return [100 - 100 / (1 + a / (b or 1e-10)) for a, b in zip(up, down)]


def k_line(closes):
    raw, found = [], strengths(closes)
    for i, value in enumerate(found):
        part = [v for v in brute.window(found, i, 50) if v == v]
        if value != value:
            raw.append(100.0)
        else:
            span = (max(part) - min(part)) or 1e-10
            raw.append(min(100.0, max(0.0, 100 * (value - min(part)) / span)))
    return brute.smoother(raw)


def table(spark, series=SERIES):
    data = [r for name, bars in series.items() for r in rows(bars, name)]
    return spark.createDataFrame(data[::-1], BAR).repartition(3)


@pytest.mark.parametrize("core", [32, 3_584])
def test_endless_moves_last(spark, core):
    got = feature_table(table(spark), core=core, bucket_bars=90, endless=True).orderBy("start").collect()
    assert len(got) == sum(len(bars) for bars in SERIES.values())
    for name, bars in SERIES.items():
        expected = k_line([b["close"] for b in bars])
        mine = [r for r in got if r.product_id == name]
        assert_close([r.es_stoch_rsi_k for r in mine], expected, 1e-7, name)
        assert_close([r.es_stoch_rsi_d for r in mine], brute.mean_so_far(expected, 6), 1e-7, name)


@pytest.mark.parametrize("n, core", [(2, 3_584), (70, 30)])
def test_endless_strength(spark, n, core):
    got = ind.add_indicators(table(spark), ind.ewm_rsi(n, "strength", endless=True), core=core)
    got = got.orderBy("start").collect()
    for name, bars in SERIES.items():
        found = [r.strength for r in got if r.product_id == name]
        expected = strengths([b["close"] for b in bars], n)
        assert [x != x for x in found] == [x != x for x in expected], name
        known = [(a, b) for a, b in zip(found, expected) if b == b]
        assert_close([a for a, _ in known], [b for _, b in known], 1e-7, name)


def test_a_mean_of_one_move_cannot_be_endless():
    with pytest.raises(ValueError, match="more than one"):
        ind.ewm_rsi(1, endless=True)


def test_endless_moves_last_beyond_a_state(spark):
    items = ind.standard_indicators(endless=True)
    bars = table(spark).cache()
    expected = {}
    for name, made in SERIES.items():
        line = k_line([b["close"] for b in made])
        expected |= {(name, b["start"]): value for b, value in zip(made, line)}
    state, found = None, {}
    at = [0, *(SERIES["plain"][i]["start"] for i in (5, 250)), 10**12]
    for begin, end, core in zip(at, at[1:], (None, 64, None)):
        part = bars.filter((F.col("start") >= begin) & (F.col("start") < end))
        got = ind.add_indicators(part, *items, before=state, core=core)
        found |= {(r.product_id, r.start): r.es_stoch_rsi_k for r in got.collect()}
        state = ind.state_after(part, *items, before=state)
        state = State(state.tail.localCheckpoint(), state.sums.localCheckpoint())
    assert found.keys() == expected.keys()
    assert_close([found[key] for key in expected], list(expected.values()), 1e-7)


def test_features_of_zero_values_equal_their_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    for name in ("once", "twice", "first", "last"):
        for i, bar in enumerate(SERIES[name]):
            bar["tick"] = bar["start"] + i % 800
    data = [(n, b["tick"], b["close"]) for n in ("once", "twice", "first", "last") for b in SERIES[n]]
    events = spark.createDataFrame(data, "event_type string, at long, value double")
    events.selectExpr("event_type", "timestamp_seconds(at)::timestamp_ntz AS ts", "value").coalesce(1).write.parquet(
        str(tmp_path / "events.parquet")
    )
    got = QUERIES["features_15m"](spark, str(tmp_path))
    found = {(r.product_id, r.start): r.asDict() for r in got.collect()}
    with duckdb.connect() as sql:
        sql.execute(f"CREATE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
        answer = sql.execute(ORACLES["features_15m"])
        names = [column[0] for column in answer.description]
        expected = [dict(zip(names, row)) for row in answer.fetchall()]
    assert len(found) == len(expected) == 4 * 420
    for row in expected:
        mine = found[row["product_id"], row["start"]]
        assert mine.keys() == row.keys()
        for name, value in row.items():
            assert mine[name] == value or mine[name] == pytest.approx(value, abs=2e-6), (row["product_id"], name)
