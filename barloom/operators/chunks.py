"""Cutting series into chunks, so that no task ever holds a whole series.

A window partitioned by series alone puts a series on one core; the biggest
series would then decide the run time. Instead every bar gets its exact
position in its series and the series is cut every ``core`` bars. A chunk also
receives copies of the last ``lookback`` bars before it (its halo), which is all
a bounded frame can see. Windows then run per (series, chunk).

Recursions ``y = a*y_before + u`` look back without bound. Unrolled, the state
entering a chunk is a sum of powers of ``a`` times what earlier chunks hold on
their own, so each chunk is first aggregated to one row (plain ``groupBy``),
and that row is added, scaled, to the chunks after it. ``a**(core*k)`` is zero
in double precision after a few chunks, which bounds how far a row is sent.

A run may also begin where an earlier one ended, from a ``State``: the last bars of
each series, and what the recursions hold before them. The chunks are then
counted from those bars, and that state is what enters the first one.

Expressions are SQL text: one ``selectExpr`` per step keeps the number of
driver calls small however many indicators are asked for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import floor_div_sql, grid_sql
from barloom.schema import KEYS, SERIES

# Grid slots per position bucket: one bucket row stands for up to this many bars.
BUCKET_BARS = 65_536
# Bars per chunk without its halo. With the halo of the standard indicators a chunk
# stays under 4,096 rows, up to which Spark's window operator keeps its rows in a
# plain memory buffer (spark.sql.windowExec.buffer.in.memory.threshold).
CHUNK_BARS = 3_584

# exp(-x) is 0.0 in double precision beyond _VANISHED, exp(x) overflows beyond 709.
_VANISHED = 746.0
_LARGEST_EXPONENT = 650.0
# Half the exponent that a block of a fast decay spans: the whole is beyond _VANISHED.
_BLOCK_EXPONENT = 600.0
# Bars since the first one of the chunk, halo included.
OFFSET = "(_age + _half - 1)"

_KEYS = ", ".join(SERIES)
# A bar that lacks its series or its start has no position.
PLACED = " and ".join(f"{name} is not null" for name in KEYS)
_CHUNK = f"PARTITION BY {_KEYS}, _chunk ORDER BY _pos"


@dataclass(frozen=True)
class Decay:
    """The recursion ``y = a*y_before + term`` with ``y = 0`` before the first bar.

    ``term`` is SQL over the bar's columns, ``pos`` and ``prev_close``; where it
    is null it adds nothing. With an ``angle`` the multiplier is the complex number of
    size ``a`` and that angle, so the state is a point of the plane, which each bar
    shrinks and turns: a filter of two poles. Its value is then
    ``sum(term * a**q * sin((q + 1) * angle))`` over the bars q back.
    """

    name: str
    a: float
    term: str
    angle: float = 0.0

    @property
    def held(self) -> tuple[str, ...]:
        """The numbers of its state."""
        return (f"{self.name}_cos", f"{self.name}_sin") if self.angle else (self.name,)

    def left_behind(self, bars: str) -> dict[str, str]:
        """What a bar's term comes to after so many further bars."""
        value = f"{self.term} * power({number(self.a)}, {bars})"
        if not self.angle:
            return {self.name: value}
        cos, sin = self.held
        turned = f"(({bars}) * {number(self.angle)})"
        return {cos: f"{value} * cos{turned}", sin: f"{value} * sin{turned}"}

    def carried(self, bars: str, prefix: str = "") -> dict[str, str]:
        """The state in the columns ``prefix`` + ``held`` after so many further bars."""
        scale = f"power({number(self.a)}, {bars})"
        if not self.angle:
            return {self.name: f"{prefix}{self.name} * {scale}"}
        cos, sin = self.held
        turned = f"(({bars}) * {number(self.angle)})"
        x, y = f"{prefix}{cos}", f"{prefix}{sin}"
        return {
            cos: f"{scale} * ({x} * cos{turned} - {y} * sin{turned})",
            sin: f"{scale} * ({x} * sin{turned} + {y} * cos{turned})",
        }


@dataclass(frozen=True)
class First:
    """The position of the first bar of a series where ``met`` holds, null if there is none.

    ``met`` is SQL over the bar's columns, ``pos`` and ``prev_close``. It is one number per
    series, so bars compare ``_pos`` with it instead of looking back.
    """

    name: str
    met: str

    @property
    def column(self) -> str:
        return f"_first_{self.name}"

    @property
    def found(self) -> str:
        """The aggregate that finds it."""
        return f"min(if({self.met}, _pos, null)) AS {self.column}"


@dataclass(frozen=True)
class State:
    """Where the computation of a table of series stands.

    ``tail`` has the last bars of each series, as many as the indicators look back on.
    ``sums`` has a row per series: ``_until`` (last start), ``_stored`` and ``_past`` (bars of the
    series, and those before the tail), ``_past_close`` (the close before the tail),
    ``_past_null_close`` and ``_past_null_range`` (first starts without a close, or a high or
    low), ``_y_`` + the numbers of every recursion just before the tail, and the columns of
    every ``First``.
    """

    tail: DataFrame
    sums: DataFrame


def number(value: float) -> str:
    """A float as a SQL double literal (without the D it would be a decimal)."""
    return f"{value!r}D"


def over_last(call: str, n: int) -> str:
    """``call`` over the current bar and the ``n - 1`` bars before it."""
    return f"{call} OVER ({_CHUNK} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def over_so_far(call: str) -> str:
    """``call`` over all bars of the chunk up to the current one."""
    return f"{call} OVER ({_CHUNK} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def block_length(a: float, rows: int) -> int | None:
    """Bars per block of a chunk of so many rows, or None if it needs no blocks.

    Weights run from a**(-n/2) to a**(n/2) over n bars and must fit a double. A
    chunk that is too long for that is cut into blocks so long that nothing is
    left of one after the next.
    """
    if -math.log(a) * rows / 2 <= _LARGEST_EXPONENT:
        return None
    return max(1, math.floor(2 * _BLOCK_EXPONENT / -math.log(a)))


def over_block(call: str, length: int) -> str:
    """``call`` over the bars so far of the current block of the chunk."""
    spec = f"PARTITION BY {_KEYS}, _chunk, {OFFSET} div {length}L ORDER BY _pos"
    return f"{call} OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def block_before(value: str, length: int) -> str:
    """Value at the end of the block before; null in the first block."""
    ended = f"if({OFFSET} % {length} = {length - 1}, {value}, null)"
    return f"last({ended}, true) OVER ({_CHUNK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def bars_ago(source: str, k: int) -> str:
    """Value of a column k bars earlier."""
    return f"lag({source}, {k}) OVER ({_CHUNK})" if k else source


def index_bars(
    bars: DataFrame,
    bucket_bars: int = BUCKET_BARS,
    ties: Sequence[str] = ("close", "high", "low"),
    before: State | None = None,
) -> DataFrame:
    """Add each bar's 0-based position in its series, and its neighbourhood.

    New columns: ``_pos``, ``_prev_close``, ``_total`` (bars of the series),
    ``_null_close_at`` and ``_null_range_at`` (start of the first bar so far
    without a close, without a high or low). Bars without a key are left out. Keys (series, start) are
    expected to be unique, as in every table this package writes; repeated ones
    count as bars of their own, in the order of the ``ties`` columns.

    Time buckets are counted first (partial aggregation, one row per bucket),
    running totals over buckets give each bucket's first position, and bars are
    numbered inside their bucket. The running totals are the one place that
    orders a whole series, and the calendar bounds it: a century of any series
    has at most 48,000 buckets.

    With a state ``before``, the bars follow those of its series (none is older than the
    last stored one), the tail comes along, and ``_stored`` and ``_past`` are added.
    """
    columns = bars.columns
    if before is not None:
        bars = bars.unionByName(before.tail, allowMissingColumns=True)
    bucket = floor_div_sql("start", f"({grid_sql('granularity')} * {bucket_bars}L)")
    keyed = bars.filter(PLACED).selectExpr("*", f"{bucket} AS _bucket")
    until = f"PARTITION BY {_KEYS} ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND"
    seams = (
        keyed.groupBy(*SERIES, "_bucket")
        .agg(
            F.expr("count(1) AS _n"),
            F.expr("max_by(close, start) AS _last"),
            F.expr("min(if(close is null, start, null)) AS _no_close"),
            F.expr("min(if(high is null or low is null, start, null)) AS _no_range"),
        )
        .selectExpr(
            *SERIES,
            "_bucket",
            f"coalesce(sum(_n) OVER ({until} 1 PRECEDING), 0L) AS _base",
            f"sum(_n) OVER (PARTITION BY {_KEYS}) AS _total",
            f"lag(_last) OVER (PARTITION BY {_KEYS} ORDER BY _bucket) AS _seam",
            f"min(_no_close) OVER ({until} CURRENT ROW) AS _null_close_at",
            f"min(_no_range) OVER ({until} CURRENT ROW) AS _null_range_at",
        )
    )
    if before is not None:
        known = ["_stored", "_past", "_past_close", "_past_null_close", "_past_null_range"]
        seams = seams.join(before.sums.select(*SERIES, *known), [*SERIES], "left").selectExpr(
            *SERIES,
            "_bucket",
            "_base + coalesce(_past, 0L) AS _base",
            "_total + coalesce(_past, 0L) AS _total",
            "if(_base = 0, _past_close, _seam) AS _seam",
            "least(_null_close_at, _past_null_close) AS _null_close_at",
            "least(_null_range_at, _past_null_range) AS _null_range_at",
            "coalesce(_stored, 0L) AS _stored",
            "coalesce(_past, 0L) AS _past",
        )
    order = ", ".join(["start", *ties])
    numbered = f"OVER (PARTITION BY {_KEYS}, _bucket ORDER BY {order})"
    return (
        keyed.join(seams, [*SERIES, "_bucket"], "left")
        .selectExpr("*", f"row_number() {numbered} AS _nth", f"lag(close) {numbered} AS _before")
        .selectExpr(
            *columns,
            "_base + _nth - 1 AS _pos",
            "if(_nth = 1, _seam, _before) AS _prev_close",
            "_total",
            "_null_close_at",
            "_null_range_at",
            *(["_stored", "_past"] if before is not None else []),
        )
    )


def _on_grid(position: str, core: int, before: State | None) -> str:
    """Where a position lies on the grid of chunks.

    After a state the first new bar begins chunk 1, so the tail is all of chunk 1's halo.
    """
    return position if before is None else f"({position} - _stored + {core}L)"


def series_state(
    bars: DataFrame,
    decays: Sequence[Decay],
    lookback: int,
    bucket_bars: int = BUCKET_BARS,
    ties: Sequence[str] = ("close", "high", "low"),
    before: State | None = None,
    firsts: Sequence[First] = (),
) -> State:
    """The state after ``bars``, which follow the state ``before`` if there is one.

    Sums per series with partial aggregation; nothing is ordered but time buckets.
    """
    lookback = max(lookback, 1)
    indexed = index_bars(bars, bucket_bars, ties, before)
    if before is None:
        indexed = indexed.selectExpr("*", "0L AS _past")
    tail = indexed.filter(f"_pos >= _total - {lookback}")
    past = f"greatest(_total - {lookback}, 0L)"
    lasting = [decay for decay in decays if decay.a > 0]
    left = {k: v for d in lasting for k, v in d.left_behind(f"({past} - 1 - _pos)").items()}
    sums = indexed.groupBy(*SERIES).agg(
        F.expr("max(start) AS _until"),
        F.expr("max(_total) AS _stored"),
        F.expr(f"max({past}) AS _now_past"),
        F.expr("max(_past) AS _was_past"),
        F.expr(f"max(if(_pos = {past}, _prev_close, null)) AS _past_close"),
        F.expr("min(_null_close_at) AS _past_null_close"),
        F.expr("min(_null_range_at) AS _past_null_range"),
        *[F.expr(f"coalesce(sum(if(_pos < {past}, {v}, 0D)), 0D) AS _new_{k}") for k, v in left.items()],
        *[F.expr(f.found) for f in firsts],
    )
    names = ["_until", "_stored", "_now_past AS _past", "_past_close", "_past_null_close", "_past_null_range"]
    if before is None:
        added = [f"_new_{k} AS _y_{k}" for k in left] + [f.column for f in firsts]
    else:
        states = [f"_y_{k}" for k in left] + [f"{f.column} AS _was{f.column}" for f in firsts]
        sums = sums.join(before.sums.selectExpr(*SERIES, *states), [*SERIES], "left")
        kept = {k: v for d in lasting for k, v in d.carried("(_now_past - _was_past)", "_y_").items()}
        added = [f"_new_{k} + coalesce({v}, 0D) AS _y_{k}" for k, v in kept.items()]
        added += [f"least({f.column}, _was{f.column}) AS {f.column}" for f in firsts]
    return State(tail.select(*bars.columns), sums.selectExpr(*SERIES, *names, *added))


def _chunk_states(
    indexed: DataFrame,
    decays: Sequence[Decay],
    lookback: int,
    core: int,
    before: State | None = None,
    whole: bool = False,
    firsts: Sequence[First] = (),
) -> DataFrame:
    """State of every recursion just before each chunk's first row (halo included).

    Chunk k starts at bar ``k*core - lookback``; the bars from there up to the
    start of chunk k+1 are summed to what they leave behind at their end. A sum
    goes only to chunks that the series has. A state ``before`` enters chunk 1 as it is,
    and later ones by what chunk 1 leaves of it.

    With ``firsts`` every chunk gets a row, as each needs them; chunks that no sum enters get it
    from their own sums or, at the start of a series, from its first ones. A window over one row
    per chunk spreads them over a series.

    With ``whole`` the sums name every column of ``indexed``, so that this branch asks for the
    same exchange as the chunks and Spark computes it once.
    """
    slowest = min((-math.log(d.a) for d in decays), default=math.inf)
    reach = math.ceil(_VANISHED / (core * slowest)) + 1
    place, total = _on_grid("_pos", core, before), _on_grid("_total", core, before)
    owner = f"({place} + {lookback}) div {core}L"
    left = f"(({owner} + 1) * {core}L - {lookback + 1} - {place})"
    ahead = f"(max({total}) - 1) div {core}L - _owner"
    terms = {k: v for d in decays for k, v in d.left_behind(left).items()}
    columns = [f.column for f in firsts]
    series = f"OVER (PARTITION BY {_KEYS})"
    nearest = f"if(_owner = min(_owner) {series}, {0 if before is None else 1}L - _owner, 0L)" if firsts else "1L"
    own = (
        indexed.groupBy(*SERIES, F.expr(f"{owner} AS _owner"))
        .agg(
            F.expr(f"least({reach}L, {ahead}) AS _ahead"),
            *[F.expr(f"coalesce(sum({v}), 0D) AS {k}") for k, v in terms.items()],
            *[F.expr(f.found) for f in firsts],
            *([F.expr(f"count({', '.join(f'`{name}`' for name in indexed.columns)}) AS _full")] if whole else []),
        )
        .withColumns({"_nearest": F.expr(nearest), **{c: F.expr(f"min({c}) {series}") for c in columns}})
        .filter("_ahead >= _nearest and _full >= 0" if whole else "_ahead >= _nearest")
    )
    if before is not None:
        kept = {k: v for d in decays for k, v in d.carried(f"{core}L", "_y_").items()}
        known = [*[f"_y_{k}" for k in kept], *[f"{c} AS _was{c}" for c in columns]]
        own = own.join(before.sums.selectExpr(*SERIES, *known), [*SERIES], "left").selectExpr(
            *SERIES,
            "_owner",
            "_nearest",
            "_ahead",
            *[f"{k} + if(_owner = 1, coalesce({v}, 0D), 0D) AS {k}" for k, v in kept.items()],
            *[f"least({c}, _was{c}) AS {c}" for c in columns],
        )
    steps = {k: v for d in decays for k, v in d.carried(f"((_step - 1) * {core}L)").items()}
    if firsts:
        steps = {k: f"if(_step > 0, {v}, 0D)" for k, v in steps.items()}
    states = (
        own.selectExpr("*", "explode(sequence(_nearest, _ahead)) AS _step")
        .groupBy(*SERIES, F.expr("_owner + _step AS _chunk"))
        .agg(*[F.expr(f"sum({v}) AS _in_{k}") for k, v in steps.items()], *[F.expr(f"min({c}) AS {c}") for c in columns])
    )
    if before is None:
        return states
    if firsts:  # chunk 1 has a row already: it has the firsts, and no sums enter it but the state's
        entering = [f"_y_{k} AS _of_{k}" for k in steps]
        states = states.join(before.sums.selectExpr(*SERIES, *entering), [*SERIES], "left")
        values = [f"if(_chunk = 1, _of_{k}, _in_{k}) AS _in_{k}" for k in steps]
        return states.selectExpr(*SERIES, "_chunk", *values, *columns)
    entering = [f"_y_{k} AS _in_{k}" for k in steps]
    return states.unionByName(before.sums.selectExpr(*SERIES, "1L AS _chunk", *entering))


def chunk_bars(
    bars: DataFrame,
    lookback: int = 0,
    decays: Sequence[Decay] = (),
    core: int = CHUNK_BARS,
    bucket_bars: int = BUCKET_BARS,
    ties: Sequence[str] = ("close", "high", "low"),
    before: State | None = None,
    whole: bool = False,
    firsts: Sequence[First] = (),
) -> DataFrame:
    """Bars with ``_chunk`` and ``_age`` (bars since the middle of the chunk).

    ``_opens`` tells whether the chunk has the first bar of its series. Halo rows are copies: keep
    only ``core_bars`` of the result at the end, which also drops the tail of a state ``before``.
    ``whole`` says that all columns will be used: then bars are scanned and shuffled once for the
    chunks and the states that enter them, instead of once more with the columns that the states need.
    """
    if before is not None:
        lookback = max(lookback, 1)
    indexed = index_bars(bars, bucket_bars, ties, before)
    place, total = _on_grid("_pos", core, before), _on_grid("_total", core, before)
    first, last = f"{place} div {core}L", f"({place} + {lookback}) div {core}L"
    # A halo belongs to a chunk that has bars of its own.
    last = f"least({last}, ({total} - 1) div {core}L)"
    opens = "_chunk = 0"
    if before is not None:
        indexed = indexed.filter("_total > _stored")
        opens = "_chunk = 1 and _past = 0"
    begin = first if before is None else f"greatest({first}, 1L)"
    chunked = indexed.selectExpr("*", f"explode(sequence({begin}, {last})) AS _chunk")
    lasting = [decay for decay in decays if decay.a > 0]
    if lasting or firsts:
        states = _chunk_states(indexed, lasting, lookback, core, before, whole and before is None, firsts)
        chunked = chunked.join(states, [*SERIES, "_chunk"], "left")
    half = (core + lookback) // 2
    return chunked.selectExpr(
        "*",
        f"{place} - (_chunk * {core}L - {lookback}) - {half} AS _age",
        f"{half + 1} AS _half",
        f"_chunk = {first} AS _core",
        f"{opens} AS _opens",
    )


def core_bars(chunked: DataFrame) -> DataFrame:
    """Each placed bar once: drops the halo copies."""
    return chunked.filter("_core")


def decay_phases(decay: Decay, rows: int, out: str) -> list[dict[str, str]]:
    """``y`` of a recursion on a frame made by ``chunk_bars`` with chunks of so many rows.

    Inside a chunk the recursion is a running sum of ``term / a**age``, scaled
    back by ``a**age``. Ages count from the middle of the chunk to stay in range.
    A running sum only grows towards the newer, larger weights, so rounding
    does not build up with the chunk length. A decay too fast for the chunk sums
    up blocks of it, each with what the block before leaves.
    """
    if decay.angle:
        return _turning_phases(decay, rows, out)
    if decay.a == 0:
        return [{out: f"coalesce({decay.term}, 0D)"}]
    a = number(decay.a)
    state = f"power({a}, _age + _half) * coalesce(_in_{decay.name}, 0D)"
    length = block_length(decay.a, rows)
    if length is None:
        local = over_so_far(f"sum({decay.term} * power({a}, -_age))")
        return [{out: f"coalesce({local}, 0D) * power({a}, _age) + {state}"}]
    off = f"({OFFSET} % {length})"
    age = f"({off} - {length // 2})"
    local = over_block(f"sum({decay.term} * power({a}, -{age}))", length)
    own, before = f"{out}_block", f"{out}_before"
    return [
        {own: f"coalesce({local}, 0D) * power({a}, {age})"},
        {before: block_before(own, length)},
        {out: f"{own} + power({a}, {off} + 1) * coalesce({before}, 0D) + {state}"},
    ]


def _turning_phases(decay: Decay, rows: int, out: str) -> list[dict[str, str]]:
    """The value of a recursion with an angle: running sums of both parts of its state."""
    a, turn = number(decay.a), number(decay.angle)
    cos_in, sin_in = (f"coalesce(_in_{name}, 0D)" for name in decay.held)
    ahead = f"((_age + _half + 1) * {turn})"
    state = f"power({a}, _age + _half) * (sin{ahead} * {cos_in} + cos{ahead} * {sin_in})"
    sums = (f"{out}_cos", f"{out}_sin")

    def wave(age: str, cos_part: str, sin_part: str) -> str:
        turned = f"(({age} + 1) * {turn})"
        return f"power({a}, {age}) * (sin{turned} * {cos_part} - cos{turned} * {sin_part})"

    def fed(call: str, age: str) -> str:
        return f"sum({decay.term} * power({a}, -{age}) * {call}({age} * {turn}))"

    length = block_length(decay.a, rows)
    if length is None:
        running = {name: f"coalesce({over_so_far(fed(call, '_age'))}, 0D)" for name, call in zip(sums, ("cos", "sin"))}
        return [running, {out: f"{wave('_age', *sums)} + {state}"}]
    age = f"({OFFSET} % {length} - {length // 2})"
    running = {name: f"coalesce({over_block(fed(call, age), length)}, 0D)" for name, call in zip(sums, ("cos", "sin"))}
    ended = {f"{name}_before": block_before(name, length) for name in sums}
    earlier = wave(f"({age} + {length})", *ended)
    return [running, ended, {out: f"{wave(age, *sums)} + coalesce({earlier}, 0D) + {state}"}]
