"""Indicators of one series, bar by bar in plain Python: the yardstick for tests.

A bar is a dict with start, high, low, close; None is a missing value.
"""

import math

PI = 3.14159265359


def window(values, i, n):
    return values[max(0, i - n + 1) : i + 1]


def sma(values, n):
    out = []
    for i in range(len(values)):
        last = window(values, i, n)
        out.append(sum(last) / n if len(last) == n and None not in last else None)
    return out


def macd(closes, fast=12, slow=26, signal=9):
    raw = [
        a - b if a is not None and b is not None else None
        for a, b in zip(sma(closes, fast), sma(closes, slow), strict=True)
    ]
    mean = sma(raw, signal)
    warm = slow + signal - 2
    line = [v if i >= warm else None for i, v in enumerate(raw)]
    mean = [v if i >= warm else None for i, v in enumerate(mean)]
    gap = [a - b if a is not None and b is not None else None for a, b in zip(line, mean)]
    return line, mean, gap


def kijun(bars, period=200, kidiv=1):
    out = []
    for i in range(len(bars)):
        middles = []
        for n in (period + 1, int(period / kidiv) + 1):
            part = bars[max(0, i - n + 1) : i + 1]
            highs, lows = [b["high"] for b in part], [b["low"] for b in part]
            known = i >= period and None not in highs and None not in lows
            middles.append((max(highs) + min(lows)) / 2 if known else None)
        out.append(sum(middles) / 2 if None not in middles else None)
    return out


def position(values, n):
    out = []
    for i, value in enumerate(values):
        known = [v for v in window(values, i, n) if v is not None]
        if not known:
            out.append(None)
        elif max(known) == min(known):
            out.append(0.5)
        else:
            out.append(
                None if value is None else (value - min(known)) / (max(known) - min(known))
            )
    return out


def stochastic(values, n):
    out = []
    for i, value in enumerate(values):
        part = window(values, i, n)
        span = (max(part) - min(part)) or 1e-10
        out.append(min(100.0, max(0.0, 100 * (value - min(part)) / span)))
    return out


def changes(closes):
    pairs = zip([None, *closes[:-1]], closes)
    return [None if a is None or b is None else b - a for a, b in pairs]


def wilder(values, n):
    """values[0] is not used; None from the first missing value on."""
    out, state, seed = [], None, []
    broken = False
    for i, value in enumerate(values):
        if i >= 1 and value is None:
            broken = True
        if broken or i == 0:
            out.append(None)
            continue
        if i <= n:
            seed.append(value)
            state = sum(seed) / n if i == n else None
        else:
            state = (state * (n - 1) + value) / n
        out.append(state)
    return out


def rsi(closes, n=14):
    moves = changes(closes)
    up = wilder([None if m is None else max(m, 0.0) for m in moves], n)
    down = wilder([None if m is None else max(-m, 0.0) for m in moves], n)
    return [
        None if a is None else (0.0 if a + b == 0 else 100 * a / (a + b))
        for a, b in zip(up, down)
    ]


def true_range(bars):
    out = [None]
    for before, bar in zip(bars, bars[1:]):
        if None in (bar["high"], bar["low"], before["close"]):
            out.append(None)
        else:
            c = before["close"]
            out.append(max(bar["high"] - bar["low"], abs(bar["high"] - c), abs(bar["low"] - c)))
    return out


def atr(bars, n=14):
    return wilder(true_range(bars), n)


def ema(closes, n=20):
    out, state = [], None
    for i, value in enumerate(closes):
        if None in closes[: i + 1]:
            out.append(None)
            continue
        if i == n - 1:
            state = sum(closes[:n]) / n
        elif i >= n:
            state += 2 / (n + 1) * (value - state)
        out.append(state)
    return out


def ewm(values, n):
    out = [values[0]]
    for value in values[1:]:
        out.append((1 - 1 / n) * out[-1] + value / n)
    return out


def ewm_rsi(closes, n=70):
    logs = [math.log(c) if c is not None and c > 0 else None for c in closes]
    moves = changes(logs)
    up = ewm([m if m is not None and m > 0 else 0.0 for m in moves], n)
    down = ewm([-m if m is not None and m < 0 else 0.0 for m in moves], n)
    return [100 - 100 / (1 + a / (b or 1e-10)) for a, b in zip(up, down)]


def smoother(values, n=20):
    a1 = math.exp(-PI * math.sqrt(2) / n)
    c2, c3 = 2 * a1 * math.cos(math.sqrt(2) * PI / n), -(a1**2)
    c1 = (1 - c2 - c3) / 2
    out = []
    for i, value in enumerate(values):
        if i == 0:
            out.append(value)
        else:
            older = c3 * out[-2] if i > 1 else 0.0
            out.append(c1 * (value + values[i - 1]) + c2 * out[-1] + older)
    return out


def k_line(closes):
    return smoother(stochastic(ewm_rsi(closes), 50), 20)


def mean_so_far(values, n):
    return [sum(window(values, i, n)) / len(window(values, i, n)) for i in range(len(values))]


def lagged(values, k):
    return ([None] * k + values)[: len(values)]


def features(bars):
    closes = [b["close"] for b in bars]
    strength = rsi(closes)
    line, mean, gap = macd(closes)
    k = k_line(closes)
    return {
        "rsi": strength,
        "rsi_lag1": lagged(strength, 1),
        "rsi_lag2": lagged(strength, 2),
        "rsi_lag3": lagged(strength, 3),
        "rsi_pct": position(strength, 365),
        "macd": line,
        "macd_signal": mean,
        "macd_histogram": gap,
        "atr": atr(bars),
        "sma_14": sma(closes, 14),
        "sma_50": sma(closes, 50),
        "sma_138": sma(closes, 138),
        "kijun_v2_200_1": kijun(bars),
        "es_stoch_rsi_k": k,
        "es_stoch_rsi_d": mean_so_far(k, 6),
    }
