"""Technical indicators as window expressions over chunked series.

``add_indicators(bars, sma(14), rsi(), ...)`` computes any number of them in
one pass: one shuffle to chunks and one sort, shared by every window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from barloom.operators.chunks import (
    BUCKET_BARS,
    CHUNK_BARS,
    PLACED,
    Decay,
    First,
    OFFSET,
    State,
    bars_ago,
    block_before,
    block_length,
    chunk_bars,
    core_bars,
    decay_phases,
    index_bars,
    number,
    over_block,
    over_last,
    over_so_far,
    series_state,
)
from barloom.operators.rolling import (
    Phases,
    complete,
    last_gap,
    rolling_max,
    rolling_min,
    rolling_sum,
    side_by_side,
)

# ---- fixed values -----------------------------------------------------------
# The smoother's circle constant (cut after eleven places) and the stand-in for
# a zero divisor.
SMOOTHER_PI = 3.14159265359
TINY = 1e-10
# -----------------------------------------------------------------------------

_CHANGE = "(close - _prev_close)"
_LOG_CHANGE = "(ln(close) - ln(_prev_close))"
# The same with the logs of floating-point arithmetic, and the ways in which it is not finite.
_INFINITY = "double('Infinity')"
_ANY_LOG = "CASE WHEN {0} = 0 THEN -" + _INFINITY + " WHEN {0} < 0 THEN double('NaN') ELSE ln({0}) END"
_ANY_LOG_CHANGE = f"({_ANY_LOG.format('close')} - {_ANY_LOG.format('_prev_close')})"
_ENDLESS = {
    "log_rise": First("log_rise", f"{_ANY_LOG_CHANGE} = {_INFINITY}"),
    "log_fall": First("log_fall", f"{_ANY_LOG_CHANGE} = -{_INFINITY}"),
    "log_lost": First("log_lost", f"isnan({_ANY_LOG_CHANGE})"),
}
_NO_CLOSE = "close is null"
_NO_RANGE = "high is null or low is null"
_TRUE_RANGE = (
    "if(high is null or low is null or _prev_close is null, null,"
    " greatest(high - low, abs(high - _prev_close), abs(low - _prev_close)))"
)
# Recursive indicators end with the first bar that lacks an input. The true
# range uses the close before, so a missing close ends it one bar later.
_CLOSE_KNOWN = "(_null_close_at is null or start < _null_close_at)"
_RANGE_KNOWN = (
    "((_null_range_at is null or start < _null_range_at)"
    " and (_null_close_at is null or start <= _null_close_at))"
)


@dataclass(frozen=True)
class Indicator:
    """Output columns, how many earlier bars they see, and how to compute them.

    ``phases`` are applied in turn; phases that depend on the number of rows in a
    chunk are a function of it. ``lookback`` counts from the columns that the
    indicator ``needs``, which may be made by indicators listed before and look
    back themselves.
    """

    outputs: tuple[str, ...]
    phases: Phases | Callable[[int], Phases]
    lookback: int = 0
    decays: tuple[Decay, ...] = ()
    needs: tuple[str, ...] = ()
    firsts: tuple[First, ...] = ()

    def steps(self, rows: int) -> Phases:
        return self.phases(rows) if callable(self.phases) else self.phases


#: Columns of a frame in the making that an expression can ask for.
_PLACES = ("_pos", "_prev_close", "_null_close_at", "_null_range_at")


def add_indicators(
    bars: DataFrame,
    *indicators: Indicator,
    core: int | None = None,
    bucket_bars: int = BUCKET_BARS,
    before: State | None = None,
    whole: bool = False,
) -> DataFrame:
    """All input columns and rows, plus the outputs of the indicators in order.

    An indicator listed twice is computed once; two different ones for the same
    column are an error. Names of further input columns must not begin with an
    underscore. ``core`` is the number of bars per chunk; by default it grows with
    the longest look-back. With a state ``before``, made by ``state_after`` for the same
    indicators, the bars go on where it ends. ``whole`` says that the caller keeps all
    columns (see ``chunk_bars``).
    """
    reserved = [name for name in bars.columns if name.startswith("_")]
    if reserved:
        raise ValueError(f"columns that begin with an underscore are reserved: {reserved}")
    lookback = whole_lookback(indicators)
    core = core or max(CHUNK_BARS, 2 * lookback)
    steps: dict[int, dict[str, str]] = {}
    made: dict[str, tuple[int, str]] = {}
    for item in indicators:
        at = 1 + max((made[name][0] for name in item.needs if name in made), default=-1)
        for phase in item.steps(core + lookback):
            # Even steps only project, odd ones hold the windows: what indicators
            # of different depth do between two windows shares a window operator.
            at += (at % 2 == 0) == any(" OVER (" in sql for sql in phase.values())
            for name, sql in phase.items():
                if name in bars.columns or made.get(name, (at, sql))[1] != sql:
                    raise ValueError(f"column {name} is made in two ways")
                if name not in made:
                    steps.setdefault(at, {})[name] = sql
                    made[name] = at, sql
            at += 1
    decays = {d.name: d for item in indicators for d in item.decays}
    firsts = {f.name: f for item in indicators for f in item.firsts}
    # Only what is computed from is read: most indicators need no high and low.
    used = [sql for step in steps.values() for sql in step.values()]
    used += [d.term for d in decays.values()] + [f.met for f in firsts.values()]
    outputs = list(dict.fromkeys(name for item in indicators for name in item.outputs))
    ties = ["close", *(name for name in ("high", "low") if any(name in sql for sql in used))]
    windows = bool(decays or firsts) or any(" OVER (" in sql for sql in used)
    if windows:
        sums, marks = list(decays.values()), list(firsts.values())
        frame = chunk_bars(bars, lookback, sums, core, bucket_bars, ties, before, whole, marks)
    elif any(place in sql for sql in used for place in _PLACES):
        frame = index_bars(bars, bucket_bars, ties, before)
        frame = frame if before is None else frame.filter("_pos >= _stored")
    else:
        frame = bars
    for _, step in sorted(steps.items()):
        frame = frame.selectExpr("*", *[f"{sql} AS {name}" for name, sql in step.items()])
    if frame is bars or not (windows or any(place in sql for sql in used for place in _PLACES)):
        return frame.select(*bars.columns, *outputs)
    measured = (core_bars(frame) if windows else frame).select(*bars.columns, *outputs)
    # Bars without a key go around the windows: they keep their row, without values.
    kinds = dict(measured.select(*outputs).dtypes)
    blank = [f"cast(null as {kinds[name]}) AS {name}" for name in outputs]
    return measured.unionByName(bars.filter(f"not ({PLACED})").selectExpr("*", *blank))


def whole_lookback(indicators: Sequence[Indicator]) -> int:
    """How many earlier bars the indicators see, their own frames on top of what their inputs see."""
    seen: dict[str, int] = {}
    for item in indicators:
        total = item.lookback + max((seen.get(name, 0) for name in item.needs), default=0)
        seen.update(dict.fromkeys(item.outputs, total))
    return max(seen.values(), default=0)


def state_after(
    bars: DataFrame, *indicators: Indicator, bucket_bars: int = BUCKET_BARS, before: State | None = None
) -> State:
    """What ``add_indicators`` needs to go on after ``bars``, which follow ``before`` if given."""
    decays = {d.name: d for item in indicators for d in item.decays}
    firsts = {f.name: f for item in indicators for f in item.firsts}
    lookback = whole_lookback(indicators)
    return series_state(bars, list(decays.values()), lookback, bucket_bars, before=before, firsts=list(firsts.values()))


def _named(name: str, given: tuple[int, ...], usual: tuple[int, ...]) -> str:
    """A column's name; other periods than the usual ones are part of it."""
    return name if given == usual else "_".join([name, *map(str, given)])


# --- building blocks ---------------------------------------------------------


def _gain(move: str) -> str:
    """Upward part of a move; an unknown move counts as none."""
    return f"if({move} > 0, {move}, 0D)"


def _loss(move: str) -> str:
    return f"if({move} < 0, -{move}, 0D)"


def change(out: str = "change") -> Indicator:
    """Close minus the close before."""
    return Indicator((out,), [{out: _CHANGE}])


def gain(out: str = "gain") -> Indicator:
    """Upward part of the change, else 0."""
    return Indicator((out,), [{out: _gain(_CHANGE)}])


def loss(out: str = "loss") -> Indicator:
    """Downward part of the change as a positive number, else 0."""
    return Indicator((out,), [{out: _loss(_CHANGE)}])


def true_range(out: str = "true_range") -> Indicator:
    """Largest of high-low and the distances of both to the close before."""
    return Indicator((out,), [{out: _TRUE_RANGE}])


def log_price(out: str = "log_price") -> Indicator:
    """Natural log of the close; null for zero or less."""
    return Indicator((out,), [{out: "ln(close)"}])


def clip(source: str, low: float, high: float, out: str) -> Indicator:
    """Source held inside [low, high]; a null stays null."""
    held = f"least({number(high)}, greatest({number(low)}, {source}))"
    return Indicator((out,), [{out: f"if({source} is null, null, {held})"}], needs=(source,))


def lag_of(source: str, k: int, out: str | None = None) -> Indicator:
    """Source k bars ago."""
    out = out or f"{source}_lag{k}"
    return Indicator((out,), [{out: bars_ago(source, k)}], lookback=k, needs=(source,))


# --- bounded indicators ------------------------------------------------------


def sma(n: int = 14, out: str | None = None) -> Indicator:
    """Mean of the last n closes; null while any of them is missing."""
    out = out or f"sma_{n}"
    total = f"_{out}_sum"
    phases = side_by_side(rolling_sum("close", n, total), [{"_gap_close": last_gap(_NO_CLOSE)}])
    value = f"if({complete('_gap_close', n)}, {total} / {n}, null)"
    return Indicator((out,), [*phases, {out: value}], lookback=n - 1)


def macd(fast: int = 12, slow: int = 26, signal: int = 9, out: str | None = None) -> Indicator:
    """Difference of two simple means of the close, its simple mean, and their gap.

    All three start together, on the first bar where the signal is defined.
    """
    out = out or _named("macd", (fast, slow, signal), (12, 26, 9))
    long = max(fast, slow)
    span = long + signal - 1
    quick, slowly, raw_line, total = (f"_{out}_{x}" for x in ("fast", "slow", "raw", "sum"))
    phases = side_by_side(
        rolling_sum("close", fast, quick),
        rolling_sum("close", slow, slowly),
        [{"_gap_close": last_gap(_NO_CLOSE)}],
    )
    raw = f"{quick} / {fast} - {slowly} / {slow}"
    phases.append({raw_line: f"if({complete('_gap_close', long)}, {raw}, null)"})
    phases += rolling_sum(raw_line, signal, total)
    mean = f"if({complete('_gap_close', span)}, {total} / {signal}, null)"
    warm = f"_pos >= {span - 1}"
    outputs = (out, f"{out}_signal", f"{out}_histogram")
    values = (raw_line, mean, f"{raw_line} - {mean}")
    phases.append({name: f"if({warm}, {value}, null)" for name, value in zip(outputs, values)})
    return Indicator(outputs, phases, lookback=span - 1)


def kijun(period: int = 200, kidiv: int = 1, out: str | None = None) -> Indicator:
    """Mean of two midpoints of high and low: over period+1 and period//kidiv+1 bars."""
    out = out or f"kijun_v2_{period}_{kidiv}"
    base, turn = period + 1, int(period / kidiv) + 1
    parts: list[Phases] = [[{"_gap_range": last_gap(_NO_RANGE)}]]
    for n in sorted({base, turn}):
        parts.append(rolling_max("high", n, f"_{out}_hi{n}"))
        parts.append(rolling_min("low", n, f"_{out}_lo{n}"))
    middle = {n: f"(_{out}_hi{n} + _{out}_lo{n}) / 2" for n in (base, turn)}
    value = (
        f"if({complete('_gap_range', base)}, ({middle[base]} + {middle[turn]}) / 2, null)"
    )
    return Indicator((out,), [*side_by_side(*parts), {out: value}], lookback=period)


def minmax_position(source: str = "rsi", n: int = 365, out: str | None = None) -> Indicator:
    """Where the value lies between the lowest and highest of the last n values.

    0.5 while they are equal; null while there is no value at all or, in a
    frame with some spread, where the current value is missing.
    """
    out = out or f"{source}_pct"
    low, high = f"_{out}_lo", f"_{out}_hi"
    phases = side_by_side(rolling_min(source, n, low), rolling_max(source, n, high))
    value = (
        f"CASE WHEN {low} = {high} THEN 0.5D"
        f" WHEN {low} < {high} THEN ({source} - {low}) / ({high} - {low}) END"
    )
    return Indicator((out,), [*phases, {out: value}], lookback=n - 1, needs=(source,))


def stochastic(source: str, n: int, out: str) -> Indicator:
    """Position within the low-high band of the last n values, held to 0..100."""
    low, high = f"_{out}_lo", f"_{out}_hi"
    phases = side_by_side(rolling_min(source, n, low), rolling_max(source, n, high))
    span = f"if({high} = {low}, {number(TINY)}, {high} - {low})"
    raw = f"100 * ({source} - {low}) / {span}"
    value = f"if({source} is null, null, least(100D, greatest(0D, {raw})))"
    return Indicator((out,), [*phases, {out: value}], lookback=n - 1, needs=(source,))


# --- recursive indicators ----------------------------------------------------


def _wilder(name: str, value: str, n: int) -> Decay:
    """Mean of the values at bars 1..n, after which a new value counts 1/n.

    The seed mean is written as terms that have decayed to exactly 1/n at bar n.
    """
    a = (n - 1) / n
    seed = f"power({number(a)}, least(_pos - {n}, 0))"
    return Decay(name, a, f"if(_pos >= 1, {value} / {n} * {seed}, 0D)")


def _recursive(
    out: str, decays: tuple[Decay, ...], value: str, firsts: tuple[First, ...] = ()
) -> Indicator:
    """A value made of recursions, which it reads by their names after an underscore."""

    def phases(rows: int) -> Phases:
        parts = [decay_phases(d, rows, f"_{d.name}") for d in decays]
        return [*side_by_side(*parts), {out: value}]

    return Indicator((out,), phases, decays=decays, firsts=firsts)


def rsi(n: int = 14, out: str | None = None) -> Indicator:
    """Wilder's relative strength: share of gains in the smoothed moves, 0 to 100."""
    out = out or _named("rsi", (n,), (14,))
    up = _wilder(f"rsi{n}_up", _gain(_CHANGE), n)
    down = _wilder(f"rsi{n}_down", _loss(_CHANGE), n)
    moves = f"(_{up.name} + _{down.name})"
    share = f"if({moves} = 0, 0D, 100 * _{up.name} / {moves})"
    return _recursive(out, (up, down), f"if(_pos >= {n} and {_CLOSE_KNOWN}, {share}, null)")


def atr(n: int = 14, out: str | None = None) -> Indicator:
    """Wilder's mean of the true range."""
    out = out or _named("atr", (n,), (14,))
    mean = _wilder(f"atr{n}_mean", _TRUE_RANGE, n)
    return _recursive(out, (mean,), f"if(_pos >= {n} and {_RANGE_KNOWN}, _{mean.name}, null)")


def ema(n: int = 20, out: str | None = None) -> Indicator:
    """Exponential mean, seeded with the simple mean of the first n closes."""
    out = out or f"ema_{n}"
    a = (n - 1) / (n + 1)
    seed = f"close / {n} * power({number(a)}, _pos - {n - 1})"
    mean = Decay(f"ema{n}_mean", a, f"if(_pos < {n}, {seed}, close * {number(2 / (n + 1))})")
    return _recursive(out, (mean,), f"if(_pos >= {n - 1} and {_CLOSE_KNOWN}, _{mean.name}, null)")


def ewm_rsi(n: int = 70, out: str | None = None, endless: bool = False) -> Indicator:
    """Relative strength of the log price from the first bar on.

    Both means start at the first value and weigh a new one 1/n; an unknown
    move counts as none; a zero mean loss is replaced by a tiny one.

    The log of a price of zero or less is unknown. With ``endless`` it is minus infinity for zero
    and NaN below, as in floating-point arithmetic: the mean loss is infinite from
    a fall to zero on, the mean gain from a rise from zero on, and the strength NaN once both are.
    """
    out = out or _named("ewm_rsi", (n,), (70,))
    weight = f"if(_pos = 0, 1D, {number(1 / n)})"
    up = Decay(f"ewm{n}_up", 1 - 1 / n, f"{_gain(_LOG_CHANGE)} * {weight}")
    down = Decay(f"ewm{n}_down", 1 - 1 / n, f"{_loss(_LOG_CHANGE)} * {weight}")
    gains, losses, firsts = f"_{up.name}", f"_{down.name}", ()
    if endless:
        if n <= 1:
            raise ValueError("with endless moves the mean needs more than one of them")
        # The finite parts go on as they are; what is infinite or NaN stays so and is added.
        gains = f"({gains} + {_from_first('log_rise')})"
        losses = f"({losses} + {_from_first('log_fall')})"
        firsts = tuple(_ENDLESS.values())
    ratio = f"{gains} / if({losses} = 0, {number(TINY)}, {losses})"
    return _recursive(out, (up, down), f"100 - 100 / (1 + {ratio})", firsts)


def _from_first(name: str) -> str:
    """Infinity from the first such move on, NaN from the first lost one on, 0 before."""
    lost, moved = (_ENDLESS[key].column for key in ("log_lost", name))
    return f"CASE WHEN _pos >= {lost} THEN double('NaN') WHEN _pos >= {moved} THEN {_INFINITY} ELSE 0D END"


def super_smoother(
    source: str = "close", n: int = 20, out: str | None = None
) -> Indicator:
    """Two-pole low-pass filter of the mean of the source and the source before.

    Of the close it is a recursion whose state, two numbers, is carried from chunk to
    chunk exactly, so no period copies bars. Another source may itself need windows,
    so there is nothing to carry before the chunks are made:

    The filter weighs an input q bars back by ``r**q * sin((q+1)*theta)/sin(theta)``,
    so its output is made of two running sums, and so is its output for the bar
    before. The weights shrink by r per bar: what lies further back than the
    halo weighs under 1e-30, far below the rounding of a double, so a chunk
    needs no state from the chunk before. The first bar of a series enters
    whole instead of by its share; a missing value counts as 0. In a chunk that is too long for the weights
    the sums run over blocks, and the two sums of the block before are added.
    """
    out = out or _named("super_smoother", (n,), (20,))
    theta = math.sqrt(2) * SMOOTHER_PI / n
    r = math.exp(-SMOOTHER_PI * math.sqrt(2) / n)
    share = (1 - 2 * r * math.cos(theta) + r * r) / 2
    if source == "close":
        fresh = f"{number(share)} * (coalesce(close, 0D) + coalesce(_prev_close, 0D))"
        poles = Decay(f"smooth{n}", r, f"if(_pos = 0, coalesce(close, 0D), {fresh})", theta)
        return _recursive(out, (poles,), f"if({_CLOSE_KNOWN}, _{poles.name} / {number(math.sin(theta))}, null)")
    memory = math.ceil(72 / -math.log(r))
    cos_sum, sin_sum, opening = f"_{out}_cos", f"_{out}_sin", f"_{out}_opening"
    turn = number(theta)

    def wave(age: str, cos_part: str, sin_part: str) -> str:
        def both(call: str) -> str:
            """A factor of the bar's own output plus that of the output before."""
            return f"({call}(({age} + 1) * {turn}) + {call}({age} * {turn}) / {number(r)})"

        scale = f"power({number(r)}, {age})"
        return f"{number(share)} * {scale} * ({both('sin')} * {cos_part} - {both('cos')} * {sin_part})"

    def fed(call: str, age: str) -> str:
        return f"sum(coalesce({source}, 0D) / power({number(r)}, {age}) * {call}({age} * {turn}))"

    rest = f"power({number(r)}, _pos) * sin((_pos + 1) * {turn}) * {opening}"
    start = f"if(_opens, {number(1 - share)} * {rest}, 0D)"

    def phases(rows: int) -> Phases:
        length = block_length(r, rows)
        first = {opening: f"coalesce({over_so_far(f'first({source})')}, 0D)"}
        if length is None:
            age, earlier = "_age", "0D"
            sums = {cos_sum: over_so_far(fed("cos", age)), sin_sum: over_so_far(fed("sin", age))}
            between: Phases = []
        else:
            age = f"({OFFSET} % {length} - {length // 2})"
            sums = {
                cos_sum: over_block(fed("cos", age), length),
                sin_sum: over_block(fed("sin", age), length),
            }
            ends = {f"{name}_before": block_before(name, length) for name in (cos_sum, sin_sum)}
            between = [ends]
            earlier = f"coalesce({wave(f'({age} + {length})', *ends)}, 0D)"
        value = f"({wave(age, cos_sum, sin_sum)} + {earlier} + {start}) / {number(math.sin(theta))}"
        return [first | sums, *between, {out: value}]

    return Indicator((out,), phases, lookback=memory, needs=(source,))


def es_stoch_rsi_k(
    smooth: int = 20,
    rsi_length: int = 70,
    stoch_length: int = 50,
    out: str | None = None,
    endless: bool = False,
) -> Indicator:
    """Stochastic of the log-price RSI, put through the super smoother.

    ``endless`` is that of ``ewm_rsi``. NaN orders above all numbers, so a strength that is NaN
    lies at 100.
    """
    out = out or _named("es_stoch_rsi_k", (smooth, rsi_length, stoch_length), (20, 70, 50))
    strength = ewm_rsi(rsi_length, f"_{out}_rsi", endless)
    band = stochastic(f"_{out}_rsi", stoch_length, f"_{out}_raw")
    smoothed = super_smoother(f"_{out}_raw", smooth, out)

    def phases(rows: int) -> Phases:
        return [*strength.steps(rows), *band.steps(rows), *smoothed.steps(rows)]

    return Indicator(
        (out,),
        phases,
        lookback=band.lookback + smoothed.lookback + 1,
        decays=strength.decays,
        firsts=strength.firsts,
    )


def es_stoch_rsi_d(n: int = 6, k: Indicator | None = None, out: str | None = None) -> Indicator:
    """Mean of the last n values of ``k`` (fewer at the start); list it after ``k``."""
    out = out or _named("es_stoch_rsi_d", (n,), (6,))
    source = (k or es_stoch_rsi_k()).outputs[0]
    value = over_last(f"avg({source})", n)
    return Indicator((out,), [{out: value}], lookback=n - 1, needs=(source,))


def standard_indicators(endless: bool = False) -> list[Indicator]:
    """The indicator columns of the feature table, in its order; ``endless`` is that of ``ewm_rsi``."""
    return [
        rsi(14),
        lag_of("rsi", 1),
        lag_of("rsi", 2),
        lag_of("rsi", 3),
        minmax_position("rsi", 365),
        macd(12, 26, 9),
        atr(14),
        sma(14),
        sma(50),
        sma(138),
        kijun(200, 1),
        es_stoch_rsi_k(endless=endless),
        es_stoch_rsi_d(),
    ]
