import math
import random

BAR = (
    "product_id string, granularity string, start long, open double, high double,"
    " low double, close double, volume double"
)


def noise(n, seed=1, price=100.0, gaps=True):
    """Bars with a random walk, uneven gaps and every value its own."""
    draw = random.Random(seed)
    bars, start = [], 1_700_000_100 - 1_700_000_100 % 900
    for _ in range(n):
        step = draw.gauss(0, 1)
        close = max(1.0, price + step)
        high = max(price, close) + draw.random()
        low = min(price, close) - draw.random()
        bars.append({"start": start, "open": price, "high": high, "low": low, "close": close})
        price = close
        start += 900 * (draw.choice([1, 1, 1, 2, 70]) if gaps else 1)
    return bars


def rows(bars, product="A", granularity="FIFTEEN_MINUTE"):
    return [
        (product, granularity, b["start"], b["open"], b["high"], b["low"], b["close"], 1.0)
        for b in bars
    ]


def flat(n, price=5.0):
    return [
        {"start": 900 * i, "open": price, "high": price, "low": price, "close": price}
        for i in range(n)
    ]


def ramp(n):
    return [
        {"start": 900 * i, "open": i + 1.0, "high": i + 2.0, "low": i + 1.0, "close": i + 2.0}
        for i in range(n)
    ]


def column(frame, name, product="A"):
    """One output column of one series, in time order."""
    picked = [r for r in frame.collect() if r["product_id"] == product]
    return [r[name] for r in sorted(picked, key=lambda r: r["start"])]


def assert_close(got, expected, tolerance=1e-9, what=""):
    assert len(got) == len(expected), what
    for i, (a, b) in enumerate(zip(got, expected)):
        same = (a is None and b is None) or (
            a is not None
            and b is not None
            and math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
        )
        assert same, f"{what}[{i}]: got {a}, expected {b}"
