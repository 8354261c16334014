"""The same results as plain SQL over the sample tables, for a second engine.

Bounded indicators are window queries over whole series, recursions are
recursive queries that walk a series bar by bar.
"""

from __future__ import annotations

from barloom.verify.queries import CUTOFF, HISTORY_END, NOW, OVERLAP_START

# ---- fixed values: seconds per bar and bars of a first load ----
PERIODS = {"FIFTEEN_MINUTE": 900, "ONE_HOUR": 3600, "FOUR_HOUR": 14400, "ONE_DAY": 86400}
TARGETS = {"FIFTEEN_MINUTE": 360000, "ONE_HOUR": 100000, "FOUR_HOUR": 25000, "ONE_DAY": 4100}
OHLCV = "open, high, low, close, volume"
NEW_YORK = "'America/New_York'"


def _epoch(ts: str) -> str:
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


def _bars(product: str, at: str, price: str, tick: str, table: str, granularity: str) -> str:
    width = PERIODS[granularity]
    return f"""SELECT {product} AS product_id, '{granularity}' AS granularity,
        {_epoch(at)} // {width} * {width} AS start,
        arg_min({price}, {tick}) AS open, max({price}) AS high, min({price}) AS low,
        arg_max({price}, {tick}) AS close, CAST(count(*) AS DOUBLE) AS volume
      FROM {table} GROUP BY 1, 2, 3"""


ORDER_BARS = _bars(
    "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey", "orders", "ONE_DAY"
)


def _event_bars(granularity: str = "FIFTEEN_MINUTE") -> str:
    return _bars("event_type", "ts", "value", "ts", "events", granularity)


EVENT_BARS = _event_bars()
# Every event on a grid of minutes, as one long series.
MINUTE_BARS = f"""SELECT 'ALL' AS product_id, 'FIFTEEN_MINUTE' AS granularity, {_epoch("ts")} // 60 * 60 AS start,
        arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
        CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 3"""
ALL_EVENT_BARS = " UNION ALL ".join(_event_bars(name) for name in PERIODS)


def _period(granularity: str = "granularity") -> str:
    arms = " ".join(f"WHEN '{name}' THEN {value}" for name, value in PERIODS.items())
    return f"(CASE {granularity} {arms} ELSE 86400 END)"


def _date(granularity: str = "granularity", start: str = "start") -> str:
    shown = f"({start} + CASE WHEN {granularity} = 'ONE_DAY' THEN 86400 ELSE 0 END)"
    wall = f"timezone({NEW_YORK}, to_timestamp({shown}))"
    return (
        f"(strftime({wall}, '%Y-%m-%d %H:%M:%S') ||"
        f" CASE WHEN epoch({wall}) - {shown} = -14400 THEN ' EDT' ELSE ' EST' END)"
    )


def _last_closed(granularity: str, now: str) -> str:
    wall = f"timezone({NEW_YORK}, to_timestamp({now}))"
    day = f"(CAST({wall} AS DATE) - CASE WHEN hour({wall}) < 20 THEN 1 ELSE 0 END)"
    daily = f"epoch(timezone({NEW_YORK}, CAST({day} AS TIMESTAMP) + INTERVAL 20 HOUR))"
    return (
        f"CAST(CASE WHEN {granularity} = 'ONE_DAY' THEN {daily}"
        f" WHEN {granularity} IN ('FIFTEEN_MINUTE', 'ONE_HOUR', 'FOUR_HOUR')"
        f" THEN {now} - {now} % {_period(granularity)} ELSE {now} END AS BIGINT)"
    )


# --- indicators --------------------------------------------------------------


def _indexed(bars: str) -> str:
    return f"""bars AS ({bars}),
    idx AS MATERIALIZED (
      SELECT *, row_number() OVER s - 1 AS pos, lag(close) OVER s AS prev,
        lag(high) OVER s AS prev_high
      FROM bars WINDOW s AS (PARTITION BY product_id ORDER BY start))"""


def _last(n: int) -> str:
    return f"OVER (PARTITION BY product_id ORDER BY start ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


RANGE = "greatest(high - low, abs(high - prev), abs(low - prev))"


def _sma(n: int) -> str:
    return f"CASE WHEN pos >= {n - 1} THEN avg(close) {_last(n)} END"


def _kijun(period: int, kidiv: int) -> str:
    def middle(n: int) -> str:
        return f"(max(high) {_last(n)} + min(low) {_last(n)}) / 2"

    return (
        f"CASE WHEN pos >= {period} THEN"
        f" ({middle(period + 1)} + {middle(period // kidiv + 1)}) / 2 END"
    )


def _stoch(source: str, n: int) -> str:
    low, high = f"min({source}) {_last(n)}", f"max({source}) {_last(n)}"
    raw = f"100 * ({source} - {low}) / CASE WHEN {high} = {low} THEN 1e-10 ELSE {high} - {low} END"
    return f"least(100.0, greatest(0.0, {raw}))"


def _minmax(source: str, n: int = 365) -> str:
    low, high = f"min({source}) {_last(n)}", f"max({source}) {_last(n)}"
    return (
        f"CASE WHEN {low} = {high} THEN 0.5"
        f" WHEN {low} < {high} THEN ({source} - {low}) / ({high} - {low}) END"
    )


def _wilder(state: str, value: str, n: int = 14) -> str:
    return (
        f"CASE WHEN i.pos < {n} THEN r.{state} + {value}"
        f" WHEN i.pos = {n} THEN (r.{state} + {value}) / {n}"
        f" ELSE ({n - 1} * r.{state} + {value}) / {n} END"
    )


_UP = "greatest(i.close - i.prev, 0.0)"
_DOWN = "greatest(i.prev - i.close, 0.0)"
_LOG_UP = "coalesce(greatest(ln(i.close) - ln(i.prev), 0.0), 0.0)"
_LOG_DOWN = "coalesce(greatest(ln(i.prev) - ln(i.close), 0.0), 0.0)"
_RANGE = "greatest(i.high - i.low, abs(i.high - i.prev), abs(i.low - i.prev))"

def _walk(wilder: int = 14, ema: int = 20, ewm: int = 70) -> str:
    """All recursions of the raw bars in one walk."""
    return f"""walk AS (
  SELECT product_id, pos, 0.0::DOUBLE AS up, 0.0::DOUBLE AS down, 0.0::DOUBLE AS tr,
    close / {ema} AS ema, 0.0::DOUBLE AS lup, 0.0::DOUBLE AS ldown
  FROM idx WHERE pos = 0
  UNION ALL
  SELECT i.product_id, i.pos, {_wilder("up", _UP, wilder)}, {_wilder("down", _DOWN, wilder)},
    {_wilder("tr", _RANGE, wilder)},
    CASE WHEN i.pos < {ema} THEN r.ema + i.close / {ema}
      ELSE r.ema + 2.0::DOUBLE / {ema + 1} * (i.close - r.ema) END,
    (1 - 1.0::DOUBLE / {ewm}) * r.lup + {_LOG_UP} / {ewm},
    (1 - 1.0::DOUBLE / {ewm}) * r.ldown + {_LOG_DOWN} / {ewm}
  FROM walk r JOIN idx i ON i.product_id = r.product_id AND i.pos = r.pos + 1),
measured AS MATERIALIZED (
  SELECT idx.*,
    CASE WHEN pos >= {wilder} THEN CASE WHEN up + down = 0 THEN 0 ELSE 100 * up / (up + down) END END
      AS rsi,
    CASE WHEN pos >= {wilder} THEN tr END AS atr,
    CASE WHEN pos >= {ema - 1} THEN ema END AS ema_{ema},
    100 - 100 / (1 + lup / CASE WHEN ldown = 0 THEN 1e-10 ELSE ldown END) AS ewm_rsi
  FROM idx JOIN walk USING (product_id, pos))"""


WALK = _walk()


def _smooth(source: str, table: str, n: int = 20) -> str:
    a = f"exp(-3.14159265359 * sqrt(2.0) / {n})"
    c2 = f"(2 * {a} * cos(sqrt(2.0) * 3.14159265359 / {n}))"
    c3 = f"(-pow({a}, 2))"
    c1 = f"((1 - {c2} - {c3}) / 2)"
    return f"""fed AS MATERIALIZED (
      SELECT product_id, pos, start, {source} AS s, lag({source}) OVER
        (PARTITION BY product_id ORDER BY pos) AS before FROM {table}),
    smooth AS (
      SELECT product_id, pos, s AS f, 0.0::DOUBLE AS f1 FROM fed WHERE pos = 0
      UNION ALL
      SELECT i.product_id, i.pos,
        {c1} * (i.s + i.before) + {c2} * r.f + CASE WHEN i.pos > 1 THEN {c3} * r.f1 ELSE 0 END,
        r.f
      FROM smooth r JOIN fed i ON i.product_id = r.product_id AND i.pos = r.pos + 1)"""


EHLERS = (
    f"banded AS (SELECT *, {_stoch('ewm_rsi', 50)} AS band FROM measured),"
    + _smooth("band", "banded")
)

MACD = f"""averaged AS (SELECT *, CASE WHEN pos >= 25 THEN avg(close) {_last(12)}
      - avg(close) {_last(26)} END AS raw FROM idx),
    crossed AS (SELECT *, CASE WHEN pos >= 33 THEN raw END AS macd,
      CASE WHEN pos >= 33 THEN avg(raw) {_last(9)} END AS macd_signal FROM averaged)"""


def _rounded(**columns: str | tuple[str, int]) -> str:
    parts = []
    for name, value in columns.items():
        sql, places = value if isinstance(value, tuple) else (value, 6)
        parts.append(f"round({sql}, {places}) AS {name}")
    return ", ".join(parts)


def _show(bars: str, columns: str, table: str = "idx", *ctes: str) -> str:
    return (
        "WITH RECURSIVE "
        + ", ".join([_indexed(bars), *ctes])
        + f" SELECT product_id, granularity, start, {columns} FROM {table}"
    )


def _lag(source: str, k: int) -> str:
    return f"lag({source}, {k}) OVER (PARTITION BY product_id ORDER BY start)"


CALENDAR = """CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
  CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour,
  CASE WHEN granularity IN ('FIFTEEN_MINUTE', 'ONE_HOUR') THEN CAST(minute(t) AS INTEGER) END
  AS minute"""
AS_TIME = "make_timestamp(start * 1000000) AS t"


def _features(bars: str) -> str:
    columns = _rounded(
        open="open",
        high="high",
        low="low",
        close="close",
        volume="volume",
        rsi="rsi",
        rsi_lag1=_lag("rsi", 1),
        rsi_lag2=_lag("rsi", 2),
        rsi_lag3=_lag("rsi", 3),
        rsi_pct=_minmax("rsi"),
        macd="macd",
        macd_signal="macd_signal",
        macd_histogram="macd - macd_signal",
        atr=("atr", 4),
        sma_14=_sma(14),
        sma_50=_sma(50),
        sma_138=_sma(138),
        kijun_v2_200_1=_kijun(200, 1),
        es_stoch_rsi_k="f",
        es_stoch_rsi_d=f"avg(f) {_last(6)}",
    )
    joined = f"""joined AS (SELECT measured.*, macd, macd_signal, f, {AS_TIME}
      FROM measured
      JOIN (SELECT product_id, pos, macd, macd_signal FROM crossed) USING (product_id, pos)
      JOIN smooth USING (product_id, pos))""".replace("start *", "measured.start *")
    return _show(bars, f"{CALENDAR}, {columns}", "joined", WALK, MACD, EHLERS, joined)


# --- tables of bars ----------------------------------------------------------

TICKS = f"""ticks AS (SELECT event_type AS product_id, 'FIFTEEN_MINUTE' AS granularity,
    CASE WHEN user_id >= 20 THEN CAST(user_id AS VARCHAR) END AS date,
    CASE WHEN value <= 90 THEN {_epoch("ts")} // 900 * 900 END AS start,
    value AS open, CASE WHEN value >= 5 THEN value END AS high,
    CASE WHEN user_id <> 7 THEN value END AS low, value * 2 AS close,
    CASE WHEN value <= 60 THEN CAST(user_id AS DOUBLE) END AS volume, event_id AS arrival
  FROM events)"""
CHECKED = ("date", "start", "open", "high", "low", "close", "volume")
NULLS = ", ".join(f"count(*) - count({name}) AS null_{name}" for name in CHECKED)
DUPLICATES = """SELECT product_id, granularity, count(*) FILTER (n > 1) AS duplicate_starts
  FROM (SELECT product_id, granularity, start, count(*) AS n FROM ticks GROUP BY ALL)
  GROUP BY ALL"""

DATED = f"SELECT product_id, granularity, {_date()} AS date, start, {OHLCV}"
MERGED = f"""WITH bars AS ({EVENT_BARS})
  {DATED} FROM bars WHERE start <= {HISTORY_END}
  UNION ALL
  SELECT product_id, granularity, {_date()}, start, open * 2, high * 2, low * 2, close * 2,
    volume * 2 FROM bars WHERE start > {HISTORY_END} AND start >= {OVERLAP_START}"""

PAGED = f"""bars AS ({EVENT_BARS}),
  edged AS (SELECT *, start // 306000 AS page FROM bars UNION ALL
    SELECT *, start // 306000 - 1 FROM bars WHERE start % 306000 = 0)
  SELECT product_id, granularity, start, {OHLCV}, page,
    CAST(row_number() OVER (PARTITION BY product_id, page ORDER BY start) - 1 AS INT) AS place FROM edged"""

GRANULARITIES = " UNION ALL ".join(
    f"SELECT '{name}' AS granularity, {PERIODS[name]}::BIGINT AS period_s,"
    f" {TARGETS[name]}::BIGINT AS target_bars"
    for name in PERIODS
)
CATALOG = f"""catalog AS (SELECT product_id, granularity, period_s, target_bars
    FROM (SELECT DISTINCT event_type AS product_id FROM events), ({GRANULARITIES}))"""
STORED = f"""bars AS ({ALL_EVENT_BARS}),
  stored AS (SELECT product_id, granularity, max(start) AS last_start FROM bars
    WHERE granularity <> 'FOUR_HOUR'
      AND start <= {HISTORY_END} + length(product_id) * 200000 GROUP BY ALL)"""
STORED_BARS = f"""bars AS ({ALL_EVENT_BARS}),
  stored_bars AS (SELECT * FROM bars WHERE granularity <> 'FOUR_HOUR'
    AND start <= {HISTORY_END} + length(product_id) * 200000)"""
PLAN = f"""planned AS (SELECT product_id, granularity, period_s, last_start,
    {_last_closed("granularity", str(NOW))} AS cutoff FROM catalog
    LEFT JOIN stored USING (product_id, granularity)),
  plan AS (SELECT *, CASE WHEN last_start IS NULL THEN 'no_history'
    WHEN last_start + period_s < cutoff THEN 'fetch' ELSE 'skip' END AS status FROM planned)"""


def _csv_scan() -> str:
    return f"""WITH bars AS ({ORDER_BARS}) SELECT product_id, granularity, {_date()} AS date,
      start, open, CASE WHEN volume <> 2 THEN high END AS high,
      CASE WHEN volume <> 3 THEN low END AS low,
      CASE WHEN volume <> 1 THEN close END AS close, volume FROM bars"""


def _plain(bars: str) -> str:
    return f"WITH bars AS ({bars}) SELECT product_id, granularity, start, {OHLCV} FROM bars"


def _dated(bars: str) -> str:
    return f"WITH bars AS ({bars}) {DATED} FROM bars"


ORACLES: dict[str, str] = {
    "candles_1d": _plain(ORDER_BARS),
    "candles_15m": _plain(EVENT_BARS),
    "calendar_parts": f"""WITH bars AS ({ALL_EVENT_BARS})
      SELECT product_id, granularity, start, start AS epoch, {CALENDAR}
      FROM (SELECT *, {AS_TIME} FROM bars)""",
    "display_date": f"""WITH bars AS ({ORDER_BARS} UNION ALL {EVENT_BARS})
      SELECT product_id, granularity, start, {_date()} AS date FROM bars""",
    "candle_projection": _dated(ORDER_BARS),
    "series_name": f"""WITH bars AS ({ALL_EVENT_BARS} UNION ALL {ORDER_BARS})
      SELECT product_id, granularity,
        replace(replace(product_id, '-', '_'), '/', '_') || '_' || lower(granularity) AS name,
        CAST({_period()} AS BIGINT) AS period_s, count(*) AS bars FROM bars GROUP BY ALL""",
    "coerce": """SELECT o_orderkey, o_orderkey AS start, o_totalprice AS open,
        CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low,
        CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS DOUBLE) END AS close,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey * 10.0::DOUBLE END AS volume FROM orders""",
    "log_price": _show(ORDER_BARS, _rounded(log_price="ln(close)")),
    "clip": _show(ORDER_BARS, _rounded(held="least(300000.0, greatest(100000.0, close))")),
    "change_gain_loss": _show(
        ORDER_BARS,
        _rounded(
            change="close - prev",
            gain="CASE WHEN close > prev THEN close - prev ELSE 0.0 END",
            loss="CASE WHEN close < prev THEN prev - close ELSE 0.0 END",
        ),
    ),
    "true_range": _show(
        ORDER_BARS, _rounded(true_range=f"CASE WHEN prev IS NOT NULL THEN {RANGE} END")
    ),
    "lags": _show(ORDER_BARS, _rounded(**{f"close_lag{k}": _lag("close", k) for k in (1, 2, 3)})),
    "sma": _show(ORDER_BARS, _rounded(**{f"sma_{n}": _sma(n) for n in (14, 50, 138)})),
    "sma_15m": _show(EVENT_BARS, _rounded(**{f"sma_{n}": _sma(n) for n in (14, 50, 138)})),
    "macd": _show(
        ORDER_BARS,
        _rounded(macd="macd", macd_signal="macd_signal", macd_histogram="macd - macd_signal"),
        "crossed",
        MACD,
    ),
    "kijun": _show(ORDER_BARS, _rounded(kijun_v2_200_1=_kijun(200, 1))),
    "kijun_divided": _show(ORDER_BARS, _rounded(kijun_v2_60_3=_kijun(60, 3))),
    "kijun_short_series": _show(
        _event_bars("FOUR_HOUR"), _rounded(kijun_v2_200_1=_kijun(200, 1))
    ),
    "stoch": _show(ORDER_BARS, _rounded(stoch=_stoch("close", 50))),
    "minmax_position": _show(ORDER_BARS, _rounded(close_pct=_minmax("close"))),
    "rsi": _show(ORDER_BARS, _rounded(rsi="rsi"), "measured", WALK),
    "rsi_15m": _show(EVENT_BARS, _rounded(rsi="rsi"), "measured", WALK),
    "atr": _show(ORDER_BARS, _rounded(atr=("atr", 4)), "measured", WALK),
    "ema": _show(ORDER_BARS, _rounded(ema_20=("ema_20", 4)), "measured", WALK),
    "ewm_rsi": _show(ORDER_BARS, _rounded(ewm_rsi="ewm_rsi"), "measured", WALK),
    "super_smoother": _show(
        ORDER_BARS,
        _rounded(super_smoother=("f", 4)),
        "smooth JOIN idx USING (product_id, pos)",
        _smooth("close", "idx"),
    ),
    "es_stoch_rsi_k": _show(
        ORDER_BARS,
        _rounded(es_stoch_rsi_k="f"),
        "smooth JOIN idx USING (product_id, pos)",
        WALK,
        EHLERS,
    ),
    "es_stoch_rsi_d": _show(
        ORDER_BARS,
        _rounded(es_stoch_rsi_d=f"avg(f) {_last(6)}"),
        "smooth JOIN idx USING (product_id, pos)",
        WALK,
        EHLERS,
    ),
    "rsi_lags": _show(
        ORDER_BARS,
        _rounded(rsi="rsi", **{f"rsi_lag{k}": _lag("rsi", k) for k in (1, 2, 3)}),
        "measured",
        WALK,
    ),
    "rsi_pct": _show(
        ORDER_BARS, _rounded(rsi="rsi", rsi_pct=_minmax("rsi")), "measured", WALK
    ),
    "rsi_2": _show(ORDER_BARS, _rounded(rsi_2="rsi"), "measured", _walk(2)),
    "ema_3": _show(ORDER_BARS, _rounded(ema_3=("ema_3", 4)), "measured", _walk(ema=3)),
    "super_smoother_10": _show(
        ORDER_BARS,
        _rounded(super_smoother_10=("f", 4)),
        "smooth JOIN idx USING (product_id, pos)",
        _smooth("close", "idx", 10),
    ),
    "sma_lags_short_chunks": _show(
        ORDER_BARS,
        _rounded(sma_14=("sma", 4), sma_14_lag3=(_lag("sma", 3), 4)),
        "averaged",
        f"averaged AS (SELECT *, {_sma(14)} AS sma FROM idx)",
    ),
    "sma_position_short_chunks": _show(
        ORDER_BARS,
        _rounded(sma_50=("sma", 4), sma_50_pct=_minmax("sma", 20)),
        "averaged",
        f"averaged AS (SELECT *, {_sma(50)} AS sma FROM idx)",
    ),
    "macd_stoch_short_chunks": _show(
        ORDER_BARS, _rounded(wave=f"CASE WHEN macd IS NOT NULL THEN {_stoch('macd', 50)} END"), "crossed", MACD
    ),
    "long_series": _show(
        MINUTE_BARS,
        _rounded(rsi="rsi", atr="atr", ema_20="ema_20", sma_138=_sma(138)),
        "measured",
        WALK,
    ),
    "super_smoother_1000": _show(
        MINUTE_BARS,
        _rounded(super_smoother_1000=("f", 4)),
        "smooth JOIN idx USING (product_id, pos)",
        _smooth("close", "idx", 1000),
    ),
    "features_1d": _features(ORDER_BARS),
    "features_resumed": _features(ORDER_BARS),
    "features_15m": _features(EVENT_BARS),
    "features_short_chunks": _features(ORDER_BARS),
    "row_count": f"WITH {TICKS} SELECT product_id, granularity, count(*) AS total FROM ticks GROUP BY ALL",
    "null_counts": f"WITH {TICKS} SELECT product_id, granularity, {NULLS} FROM ticks GROUP BY ALL",
    "duplicate_keys": f"WITH {TICKS} {DUPLICATES}",
    "quality_report": f"""WITH {TICKS}, dup AS ({DUPLICATES})
      SELECT * FROM (SELECT product_id, granularity, 'INPUT' AS stage, count(*) AS total, {NULLS}
        FROM ticks GROUP BY ALL) JOIN dup USING (product_id, granularity)""",
    "row_conservation": f"""WITH bars AS ({ORDER_BARS}) SELECT product_id, granularity,
      count(*) AS rows_in, count(*) AS rows_out FROM bars GROUP BY ALL""",
    "union_bars": f"""WITH bars AS ({ALL_EVENT_BARS} UNION ALL {ORDER_BARS})
      SELECT product_id, granularity, count(*) AS bars, round(sum(volume), 2) AS volume
      FROM bars GROUP BY ALL""",
    "keep_first": f"""WITH {TICKS} SELECT product_id, granularity, start, date, {OHLCV} FROM (
      SELECT *, row_number() OVER (PARTITION BY product_id, granularity, start ORDER BY arrival)
        AS nth FROM ticks WHERE start IS NOT NULL) WHERE nth = 1""",
    "unkeyed": f"WITH {TICKS} SELECT * FROM ticks WHERE start IS NULL",
    "merge_keep_first": MERGED,
    "cut_off": f"""WITH bars AS ({ALL_EVENT_BARS}),
      cut AS (SELECT *, {_last_closed("granularity", str(NOW))} AS cutoff FROM bars)
      SELECT * FROM cut WHERE start <= cutoff""",
    "cut_off_closed": f"""WITH bars AS ({ALL_EVENT_BARS}),
      cut AS (SELECT *, {_last_closed("granularity", str(NOW))} AS cutoff FROM bars)
      SELECT * FROM cut WHERE start + {_period()} <= cutoff""",
    "merge_replace_open": f"""WITH bars AS ({EVENT_BARS}), newest AS (
        SELECT product_id, max(start) AS newest FROM bars WHERE start <= {HISTORY_END} GROUP BY 1),
      topped AS (SELECT product_id, granularity, start,
        {", ".join(f"CASE WHEN start >= newest THEN 2 ELSE 1 END * {c} AS {c}" for c in OHLCV.split(", "))}
        FROM bars JOIN newest USING (product_id) WHERE start <= {HISTORY_END} OR start >= {OVERLAP_START})
      {DATED} FROM topped""",
    "missing_bars": f"""WITH bars AS ({ALL_EVENT_BARS}), spans AS (
        SELECT product_id, granularity, min(start) AS first_start, max(start) AS last_start,
          count(DISTINCT start) AS bars, any_value({_period()}) AS period FROM bars GROUP BY ALL)
      SELECT product_id, granularity, first_start, last_start, bars,
        (last_start - first_start) // period + 1 - bars AS missing_bars FROM spans""",
    "bar_gaps": f"""WITH bars AS ({ALL_EVENT_BARS}), stepped AS (
        SELECT product_id, granularity, start, {_period()} AS period,
          lag(start) OVER (PARTITION BY product_id, granularity ORDER BY start) AS before FROM bars)
      SELECT product_id, granularity, before + period AS gap_start, start - period AS gap_end,
        (start - before) // period - 1 AS missing_bars FROM stepped WHERE start - before > period""",
    "ordered_bars": _plain(ORDER_BARS) + " ORDER BY 1, 2, 3",
    "last_bar": f"""WITH bars AS ({ALL_EVENT_BARS}) SELECT product_id, granularity, start, {OHLCV}
      FROM (SELECT *, row_number() OVER (PARTITION BY product_id, granularity ORDER BY start DESC)
        AS nth FROM bars) WHERE nth = 1""",
    "bar_span": f"""WITH bars AS ({ALL_EVENT_BARS}) SELECT product_id, granularity,
      min(start) AS first_start, max(start) AS last_start FROM bars GROUP BY ALL""",
    "last_closed": f"""SELECT event_id, now, granularity,
        {_last_closed("granularity", "now")} AS last_close
      FROM (SELECT event_id, {_epoch("ts")} AS now,
        unnest(['FIFTEEN_MINUTE', 'ONE_HOUR', 'FOUR_HOUR', 'ONE_DAY', 'ONE_WEEK']) AS granularity
        FROM events)""",
    "last_closed_days": f"""WITH bars AS ({ORDER_BARS}) SELECT product_id, granularity, start, now,
        {_last_closed("granularity", "now")} AS last_close
      FROM (SELECT product_id, granularity, start,
        unnest([start, start + 3599, start + 3600, start + 43200]) AS now FROM bars)""",
    "new_bars": f"""WITH bars AS ({ORDER_BARS}) SELECT product_id, granularity, start,
      start + 86400 < start + volume * 86400 AS has_new FROM bars""",
    "update_plan": f"""WITH {CATALOG}, {STORED}, {PLAN}
      SELECT product_id, granularity, last_start, cutoff, status,
        CASE WHEN status = 'fetch' THEN CAST(last_start + period_s AS VARCHAR) END
          AS request_start,
        CASE WHEN status = 'fetch' THEN CAST(cutoff AS VARCHAR) END AS request_end FROM plan""",
    "update_pages": f"""WITH {CATALOG}, {STORED}, {PLAN},
      paged AS (SELECT *, last_start + period_s AS first, unnest(range(
        CAST(ceil((cutoff - last_start - period_s) / (340.0 * period_s)) AS BIGINT))) AS request
        FROM plan WHERE status = 'fetch')
      SELECT product_id, granularity, CAST(request AS INTEGER) AS request,
        greatest(first, cutoff - (request + 1) * 340 * period_s) AS request_start,
        cutoff - request * 340 * period_s AS request_end FROM paged""",
    "backfill_plan": f"""WITH {CATALOG},
      ends AS (SELECT event_type AS product_id, {_epoch("max(ts)")} // 86400 * 86400 AS now
        FROM events GROUP BY 1),
      dated AS (SELECT *, {_last_closed("granularity", "now")} AS cutoff
        FROM catalog JOIN ends USING (product_id)),
      paged AS (SELECT *, unnest(range(CAST(ceil(target_bars / 340.0) AS BIGINT))) AS request
        FROM dated)
      SELECT product_id, granularity, CAST(request AS INTEGER) AS request,
        cutoff - (request + 1) * 340 * period_s AS request_start,
        cutoff - request * 340 * period_s AS request_end FROM paged""",
    "repair_plan": f"""WITH {CATALOG}, {STORED_BARS},
      spans AS (SELECT product_id, granularity, period_s, cutoff AS till,
          cutoff - least(target_bars, 1500) * period_s AS since
        FROM (SELECT *, {_last_closed("granularity", str(NOW))} AS cutoff FROM catalog)),
      kept AS (SELECT s.*, start FROM spans s JOIN stored_bars b
          ON s.product_id = b.product_id AND s.granularity = b.granularity AND start BETWEEN since AND till
        WHERE NOT (s.granularity = 'FIFTEEN_MINUTE' AND start BETWEEN {HISTORY_END} - 400000 AND {HISTORY_END} - 20000)),
      stepped AS (SELECT *, lag(start) OVER (PARTITION BY product_id, granularity ORDER BY start) AS before FROM kept),
      ends AS (SELECT s.product_id, s.granularity, s.period_s, s.since, s.till, min(start) AS first, max(start) AS last
        FROM spans s LEFT JOIN kept k ON s.product_id = k.product_id AND s.granularity = k.granularity GROUP BY ALL),
      holes AS (
        SELECT product_id, granularity, period_s, 'all' AS hole, since AS a, till AS b FROM ends WHERE first IS NULL
        UNION ALL SELECT product_id, granularity, period_s, 'start', since, first - period_s FROM ends WHERE first > since
        UNION ALL SELECT product_id, granularity, period_s, 'end', last + period_s, till FROM ends WHERE last + period_s <= till
        UNION ALL SELECT product_id, granularity, period_s, 'inside', before + period_s, start - period_s
          FROM stepped WHERE start - before > period_s),
      paged AS (SELECT *, unnest(range(greatest(1, CAST(ceil((b - a) / (340.0 * period_s)) AS BIGINT)))) AS request
        FROM holes WHERE a <= b)
      SELECT product_id, granularity, hole, a AS first_missing, CAST(request AS INTEGER) AS request,
        greatest(a, b - (request + 1) * 340 * period_s) AS request_start, b - request * 340 * period_s AS request_end
      FROM paged""",
    "series_catalog": f"WITH {CATALOG} SELECT * FROM catalog",
    "load_mode": f"""WITH {CATALOG}, {STORED} SELECT product_id, granularity, period_s,
      target_bars, CASE WHEN last_start IS NULL THEN 'initial' ELSE 'incremental' END AS load_mode
      FROM catalog LEFT JOIN stored USING (product_id, granularity)""",
    "pages_ingest": f"WITH {PAGED}",
    "page_files": f"WITH {PAGED}",
    "page_report": f"""WITH paged AS (WITH {PAGED}), pages AS (
        SELECT product_id, page, count(*) AS n FROM paged GROUP BY ALL), told AS (
        SELECT n, CASE page % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'empty' WHEN 2 THEN 'unreadable' ELSE 'good' END
          AS status FROM pages)
      SELECT status, count(*) AS pages, CAST(sum(CASE WHEN status = 'good' THEN n ELSE 0 END) AS BIGINT) AS bars
      FROM told GROUP BY status""",
    "initial_load_rejects": f"""WITH paged AS (WITH {PAGED})
      SELECT CASE WHEN start % 7200 <> 900 THEN product_id END AS product_id,
        CAST(start AS VARCHAR) || CASE WHEN start % 7200 = 0 THEN 'x' ELSE '' END AS start, count(*) AS bars
      FROM paged WHERE start % 7200 IN (0, 900) GROUP BY ALL""",
    "initial_load": _dated(EVENT_BARS)
    + f" WHERE start <= {_last_closed('granularity', str(CUTOFF))}",
    "incremental_append": MERGED,
    "csv_scan": _csv_scan(),
    "csv_rejects": f"""WITH bars AS ({ORDER_BARS})
      SELECT product_id, granularity, start, 'high' AS failed FROM bars WHERE volume = 2""",
    "csv_reject_counts": f"""WITH bars AS ({ORDER_BARS})
      SELECT product_id, granularity, 'high' AS column, count(*) AS records FROM bars
      WHERE volume = 2 GROUP BY 1, 2""",
    "csv_roundtrip": _dated(ORDER_BARS),
    "parquet_roundtrip": _plain(ORDER_BARS),
    "partitioned_roundtrip": f"""WITH bars AS ({ORDER_BARS}) SELECT product_id, granularity,
      start, {OHLCV}, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month
      FROM (SELECT *, {AS_TIME} FROM bars)""",
    "published_copy": _plain(ORDER_BARS),
    "published_numbers": _plain(ORDER_BARS).replace(
        "SELECT product_id, granularity, start, open", "SELECT '00' || product_id[1] AS product_id, granularity, start, open"
    ),
    "rewritten_history": MERGED,
    "latest_file": f"""WITH bars AS ({ORDER_BARS}), files AS (SELECT product_id, granularity,
        replace(product_id, '-', '_') || '_' || lower(granularity) || '_'
          || substr({_date()}, 1, 10) || '.csv' AS name FROM bars)
      SELECT product_id, granularity, 'data/' || max(name) AS path, max(name) AS name
      FROM files GROUP BY ALL""",
    "stream_merge": _dated(EVENT_BARS),
    "stream_counts": f"""WITH paged AS (WITH {PAGED}), told AS (
        SELECT 0 AS batch, * FROM paged WHERE page * 306000 < {HISTORY_END} UNION ALL SELECT 1, * FROM paged),
      added AS (
        SELECT batch, count(*) AS n FROM (
          SELECT min(batch) AS batch FROM told WHERE page % 5 IN (3, 4) GROUP BY product_id, granularity, start)
        GROUP BY batch)
      SELECT batch, count(DISTINCT (product_id, granularity, page)) AS pages,
        count(DISTINCT CASE WHEN page % 5 IN (0, 1) THEN (product_id, granularity, page) END) AS failed,
        count(*) FILTER (page % 5 > 1) AS arrived, count(*) FILTER (page % 5 = 2) AS rejected,
        coalesce(max(n), 0) AS added
      FROM told LEFT JOIN added USING (batch) GROUP BY batch""",
    "job_output": _features(ORDER_BARS),
    "job_from_stream": _show(
        EVENT_BARS,
        f"{OHLCV}, {_rounded(rsi='rsi', sma_14=_sma(14))}, CAST(start // 60 % 60 AS INT) AS minute",
        "measured",
        WALK,
    ),
}
ORACLES |= {f"stored_{name}": ORACLES[name] for name in ("update_plan", "load_mode")}
