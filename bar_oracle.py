"""SQL statements (DuckDB) that state what each registered query must return.

They are written from the meaning of each operator, not from its plan: where
the Spark side ranks rows, these take DISTINCT ON, an anti-join or a min.
"""

from __future__ import annotations

from datetime import date
from statistics import NormalDist

# Fixed values shared with the queries.
SYMBOL_LIST = " click, VIEW ,, purchase,refund ,"
EVENT_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
ACCEPTED = ("click", "view", "purchase")
FLAT_SYMBOL = "CLICK"
LOOKBACK_DAYS = 10
LOOKBACK_END = date(2024, 1, 25)
HORIZON = 7
SEASON = 7
MANY_OBS = 21
#: Days of orders that each of three deliveries covers, and of events.
DELIVERED = {1: ("1995-01-01", "1997-06-30"), 2: ("1997-03-10", "2000-02-20"), 3: ("1999-11-05", "2001-12-31")}
SPANS = (("2024-01-01", "2024-01-11"), ("2024-01-08", "2024-01-22"), ("2024-01-20", "2024-01-31"))
BLOCK_DAYS = 6
WEIGHTS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def r(expression: str, name: str | None = None) -> str:
    """A double to 6 places without negative zero."""
    return f"round({expression}, 6) + 0.0 AS {name or expression}"


PRICES = ", ".join(r(c) for c in ("open", "close", "low", "high"))
BAND = ", ".join(r(c) for c in ("forecast", "lower_bound", "upper_bound"))

TYPED = """
    SELECT 'U' || user_id AS symbol, CASE WHEN value <= 200 THEN CAST(ts AS DATE) END AS date,
           value - 0.5 AS open, CASE WHEN event_type <> 'error' THEN value END AS close,
           value - 1 AS low, value + 1 AS high, event_id AS volume
    FROM events"""
STAGE = f"SELECT * FROM ({TYPED}) WHERE date IS NOT NULL"
RAW = f"""
    SELECT DISTINCT ON (symbol, date) * FROM ({STAGE})
    ORDER BY symbol, date, open NULLS LAST, close NULLS LAST, low NULLS LAST,
             high NULLS LAST, volume NULLS LAST"""


def bars(symbol: str, ts: str = "ts") -> str:
    """Daily bars of events; open and close by joining the first and last tick back.

    Ticks of equal time are ordered by event_id.
    """
    return f"""
    SELECT b.symbol, b.date, f.value AS open, l.value AS close, b.low, b.high, b.volume
    FROM (SELECT {symbol} AS symbol, CAST({ts} AS DATE) AS date, min(row({ts}, event_id)) AS t0, max(row({ts}, event_id)) AS t1,
                 min(value) AS low, max(value) AS high, count(*) AS volume
          FROM events WHERE ts IS NOT NULL GROUP BY 1, 2) b
    JOIN (SELECT {symbol} AS symbol, row({ts}, event_id) AS t, value FROM events) f
      ON f.symbol = b.symbol AND f.t = b.t0
    JOIN (SELECT {symbol} AS symbol, row({ts}, event_id) AS t, value FROM events) l
      ON l.symbol = b.symbol AND l.t = b.t1"""


REFRESHED = f"""
    SELECT DISTINCT ON (symbol, date) symbol, date, price AS open, price AS close, price AS low, price AS high, volume
    FROM ({" UNION ALL ".join(f"""SELECT 'C' || (o_custkey % 40) AS symbol, CAST(o_orderdate AS DATE) AS date,
            o_totalprice + {k} AS price, o_orderkey AS volume, {k} AS delivery
        FROM orders WHERE o_orderdate BETWEEN '{first}' AND '{last}'""" for k, (first, last) in DELIVERED.items())})
    ORDER BY symbol, date, delivery DESC, price, volume"""


BY_TYPE = bars("upper(event_type)")
BY_USER = bars("'U' || user_id")
BY_USER_LATE = bars("'U' || user_id", "(ts + INTERVAL 6 HOUR)")
NAMES = f"""
    SELECT DISTINCT upper(trim(name)) AS symbol
    FROM (SELECT unnest(string_split('{SYMBOL_LIST}', ',')) AS name) WHERE trim(name) <> ''"""

# Observations: index x by date, the total n, neighbours one bar and one season back.
POINTS = f"""
    SELECT symbol, date, close AS y,
           CAST(row_number() OVER w AS DOUBLE) AS x,
           count(*) OVER (PARTITION BY symbol) AS total, last_date,
           lag(close, 1) OVER w AS y_prev, lag(close, {SEASON}) OVER w AS y_season
    FROM (SELECT *, max(date) OVER (PARTITION BY symbol) AS last_date FROM ({RAW}))
    WHERE close IS NOT NULL
    WINDOW w AS (PARTITION BY symbol ORDER BY date)"""


def last(held: int) -> str:
    """Forecasts start after the symbol's last bar, priced or not; a model that
    holds bars back starts after its last training bar."""
    return "max(date)" if held else "any_value(last_date)"


def trend_model(held: int = 0) -> str:
    return f"""
    SELECT symbol, count(*) AS n, {last(held)} AS last_ts, regr_slope(y, x) AS slope,
           regr_intercept(y, x) AS intercept, regr_avgx(y, x) AS x_mean, regr_sxx(y, x) AS sxx,
           sqrt(greatest((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x))
                         / nullif(count(*) - 2, 0), 0.0)) AS sigma
    FROM ({POINTS}) WHERE x <= total - {held}
    GROUP BY symbol HAVING count(*) >= 3"""


def drift_model(held: int = 0) -> str:
    return f"""
    SELECT symbol, count(*) AS n, {last(held)} AS last_ts, arg_max(y, x) AS last_y,
           (arg_max(y, x) - arg_min(y, x)) / nullif(count(*) - 1, 0) AS slope,
           stddev_samp(y - y_prev) AS sigma
    FROM ({POINTS}) WHERE x <= total - {held}
    GROUP BY symbol HAVING count(*) >= 3"""


def seasonal_model(held: int = 0) -> str:
    return f"""
    SELECT symbol, count(*) AS n, {last(held)} AS last_ts,
           list(y ORDER BY x)[-{SEASON}:] AS recent,
           sqrt(avg((y - y_season) * (y - y_season))) AS sigma
    FROM ({POINTS}) WHERE x <= total - {held}
    GROUP BY symbol HAVING count(*) >= {SEASON} + 1"""


def holt_model(held: int = 0) -> str:
    """The level and trend recursion, for every pair of weights."""
    weights = ", ".join(f"({w}::DOUBLE)" for w in WEIGHTS)
    return f"""
    SELECT symbol, n, last_ts, best.alpha AS alpha, best.beta AS beta, best.level AS level,
           best.trend AS trend, sqrt(greatest(best.sse / (n - 2), 0.0)) AS sigma
    FROM (
      WITH RECURSIVE p AS MATERIALIZED (
        SELECT symbol, date, y, x, y_prev, total - {held} AS total, last_date
        FROM ({POINTS}) WHERE x <= total - {held}),
      g(w) AS (VALUES {weights}),
      run AS (
        SELECT b.symbol, a.w AS alpha, s.w AS beta_star, 2 AS pos, b.y AS level,
               b.y - b.y_prev AS trend, 0.0::DOUBLE AS sse, b.total
        FROM p b, g a, g s WHERE b.x = 2 AND b.total >= 4
        UNION ALL
        SELECT run.symbol, alpha, beta_star, pos + 1,
               (level + trend) + alpha * (p.y - (level + trend)),
               trend + alpha * beta_star * (p.y - (level + trend)),
               sse + (p.y - (level + trend)) * (p.y - (level + trend)), run.total
        FROM run JOIN p ON p.symbol = run.symbol AND p.x = pos + 1
      )
      SELECT symbol, any_value(total) AS n,
             min(struct_pack(sse := sse, alpha := alpha, beta_star := beta_star,
                             level := level, trend := trend, beta := alpha * beta_star)) AS best
      FROM run WHERE pos = total GROUP BY symbol
    ) JOIN (SELECT symbol, {last(held)} AS last_ts FROM ({POINTS}) WHERE x <= total - {held}
            GROUP BY symbol) USING (symbol)"""


# Per method: forecast and standard error at step k.
METHODS = {
    "trend": (trend_model, "intercept + slope * (n + k)",
              "sigma * sqrt(1 + 1.0 / n + (n + k - x_mean) * (n + k - x_mean) / sxx)"),
    "drift": (drift_model, "last_y + k * slope", "sigma * sqrt(k * (1 + k / (n - 1.0)))"),
    "seasonal_naive": (seasonal_model, f"recent[(k - 1) % {SEASON} + 1]",
                       f"sigma * sqrt(floor((k - 1) / {SEASON}.0) + 1)"),
    "holt": (holt_model, "level + k * trend",
             "sigma * sqrt(1 + (k - 1) * (alpha * alpha + alpha * beta * k"
             " + beta * beta * k * (2 * k - 1) / 6.0))"),
}


def steps(model: str, point: str, spread: str, level: float = 0.95) -> str:
    z = NormalDist().inv_cdf(0.5 + level / 2)
    return f"""
    SELECT symbol, last_ts, k, {point} AS forecast,
           ({point}) - {z!r} * ({spread}) AS lower_bound,
           ({point}) + {z!r} * ({spread}) AS upper_bound
    FROM ({model}), (SELECT unnest(range(1, {HORIZON} + 1)) AS k)"""


def ahead(method: str, held: int = 0, level: float = 0.95) -> str:
    build, point, spread = METHODS[method]
    return steps(build(held), point, spread, level)


def predictions(rows: str) -> str:
    return (f"SELECT symbol AS series, CAST(last_ts + CAST(k AS INTEGER) AS TIMESTAMP) AS ts, "
            f"{BAND} FROM ({rows})")


def weekday_predictions() -> str:
    """Walk the calendar: the k-th weekday after the last date."""
    rows = ahead("trend", level=0.8)
    return f"""
    SELECT a.symbol AS series, CAST(c.day AS TIMESTAMP) AS ts, {BAND}
    FROM ({rows}) a
    JOIN (SELECT l.last_ts, CAST(l.last_ts + CAST(o AS INTEGER) AS DATE) AS day,
                 row_number() OVER (PARTITION BY l.last_ts ORDER BY o) AS k
          FROM (SELECT DISTINCT last_ts FROM ({trend_model()})) l,
               (SELECT unnest(range(1, 20)) AS o)
          WHERE isodow(l.last_ts + CAST(o AS INTEGER)) <= 5) c
      ON c.last_ts = a.last_ts AND c.k = a.k"""


def metrics(method: str) -> str:
    return f"""
    SELECT symbol AS series, count(*) AS n, {r('avg(abs(e))', 'mae')}, {r('avg(e * e)', 'mse')},
           {r('sqrt(avg(e * e))', 'rmse')},
           {r('avg(CASE WHEN y <> 0 THEN abs(e / y) END)', 'mape')},
           {r('avg(CASE WHEN abs(y) + abs(forecast) <> 0 THEN 2 * abs(e) / (abs(y) + abs(forecast)) END)',
              'smape')},
           {r('avg(CASE WHEN y BETWEEN lower_bound AND upper_bound THEN 1.0 ELSE 0.0 END)', 'coverage')}
    FROM (SELECT p.symbol, p.y, f.forecast, f.lower_bound, f.upper_bound, p.y - f.forecast AS e
          FROM ({POINTS}) p JOIN ({ahead(method, HORIZON)}) f
            ON f.symbol = p.symbol AND p.x = p.total - {HORIZON} + f.k)
    GROUP BY symbol"""


def final(held: int = 0) -> str:
    none = "CAST(NULL AS DOUBLE)"
    return f"""
    SELECT symbol, date, close AS actual, {none} AS forecast, {none} AS lower_bound,
           {none} AS upper_bound FROM ({RAW})
    UNION ALL
    SELECT symbol, CAST(last_ts + CAST(k AS INTEGER) AS DATE), {none}, forecast, lower_bound,
           upper_bound FROM ({ahead('trend', held)})"""


def mart(held: int = 0) -> str:
    """All history, and those forecasts whose key history does not hold."""
    none = "CAST(NULL AS DOUBLE)"
    return f"""
    SELECT symbol, date, close AS actual_price, {none} AS forecast_price, {none} AS lower_bound,
           {none} AS upper_bound, 'historical' AS record_type,
           symbol || '|' || CAST(date AS VARCHAR) AS pk_symbol_date, CAST(1 AS INTEGER) AS rn
    FROM ({RAW})
    UNION ALL
    SELECT symbol, CAST(last_ts + CAST(k AS INTEGER) AS DATE) AS day, {none}, forecast,
           lower_bound, upper_bound, 'forecast', symbol || '|' || CAST(day AS VARCHAR),
           CAST(1 AS INTEGER)
    FROM ({ahead('trend', held)}) f
    WHERE NOT EXISTS (SELECT 1 FROM ({RAW}) h
                      WHERE h.symbol = f.symbol AND h.date = f.last_ts + CAST(f.k AS INTEGER))"""


MART_PRICES = ", ".join(
    r(c) for c in ("actual_price", "forecast_price", "lower_bound", "upper_bound"))
MART = f"SELECT symbol, date, record_type, pk_symbol_date, rn, {MART_PRICES} FROM ({mart()})"

LATE = f"""
    SELECT m.symbol, m.date, m.record_type, m.forecast_price, h.max_hist_date
    FROM ({mart(HORIZON)}) m
    JOIN (SELECT symbol, max(date) AS max_hist_date FROM ({RAW}) GROUP BY symbol) h
      ON h.symbol = m.symbol
    WHERE m.record_type = 'forecast' AND m.date <= h.max_hist_date"""


def staged_forecast(strict: bool) -> str:
    more = "AND forecast IS NOT NULL" if strict else ""
    return f"""
    SELECT DISTINCT symbol, date, {BAND}, symbol || '|' || CAST(date AS VARCHAR) AS pk_symbol_date
    FROM ({final()}) WHERE actual IS NULL AND date IS NOT NULL {more}"""


def report(table: str, late: str | None, accepted: bool) -> str:
    parts = [
        f"SELECT 'not_null' AS \"check\", 'symbol' AS \"column\", count(*) AS n_failing"
        f" FROM ({table}) WHERE symbol IS NULL",
        f"SELECT 'not_null', 'date', count(*) FROM ({table}) WHERE date IS NULL",
        f"SELECT 'unique', 'pk_symbol_date', count(*) FROM (SELECT pk_symbol_date FROM ({table})"
        f" WHERE pk_symbol_date IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    ]
    if accepted:
        parts.append(f"SELECT 'accepted_values', 'record_type', count(*) FROM ({table})"
                     f" WHERE record_type NOT IN ('historical', 'forecast')")
    if late:
        parts.append(f"SELECT 'forecast_future', 'date', count(*) FROM ({late})")
    whole = " UNION ALL ".join(parts)
    return f'SELECT "check", "column", n_failing, n_failing = 0 AS passed FROM ({whole})'


STAGED_KEYS = f"SELECT *, symbol || '|' || CAST(date AS VARCHAR) AS pk_symbol_date FROM ({STAGE})"
DUPLICATES = f"SELECT symbol, date, count(*) AS c FROM ({STAGE}) GROUP BY ALL HAVING count(*) > 1"

T1, T2 = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-02-02 00:00:00'"


def version(rows: str, start: str, end: str) -> str:
    return f"""
    SELECT symbol, date, {PRICES}, volume,
           md5(symbol || '|' || CAST(date AS VARCHAR) || '|' || CAST({start} AS VARCHAR)) AS scd_id,
           {start} AS valid_from, CAST({end} AS TIMESTAMP) AS valid_to
    FROM ({rows})"""


def versions() -> str:
    """Each group of versions found by its own semi- or anti-join."""
    same = "b.symbol = a.symbol AND b.date = a.date"
    differ = "(b.close IS DISTINCT FROM a.close OR b.volume IS DISTINCT FROM a.volume)"
    old_changed = f"SELECT * FROM ({BY_USER}) a WHERE EXISTS (SELECT 1 FROM ({BY_USER_LATE}) b WHERE {same} AND {differ})"
    old_kept = f"SELECT * FROM ({BY_USER}) a WHERE NOT EXISTS (SELECT 1 FROM ({BY_USER_LATE}) b WHERE {same} AND {differ})"
    new = f"SELECT * FROM ({BY_USER_LATE}) a WHERE NOT EXISTS (SELECT 1 FROM ({BY_USER}) b WHERE {same} AND NOT {differ})"
    return " UNION ALL ".join([
        version(old_changed, T1, T2), version(old_kept, T1, "NULL"), version(new, T2, "NULL")])


CLASSES = f"""
    SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.date, b.date) AS date,
           CASE WHEN b.symbol IS NULL THEN 'absent' WHEN a.symbol IS NULL THEN 'insert'
                WHEN a.close IS DISTINCT FROM b.close OR a.volume IS DISTINCT FROM b.volume
                THEN 'change' ELSE 'same' END AS kind
    FROM ({BY_USER}) a FULL JOIN ({BY_USER_LATE}) b ON a.symbol = b.symbol AND a.date = b.date"""


def statements() -> dict[str, str]:
    bar_rows = f"SELECT symbol, date, {PRICES}, volume FROM "
    staged = bar_rows + f"({STAGE})"
    raw = bar_rows + f"({RAW})"
    listed = bar_rows + f"({BY_TYPE}) WHERE symbol IN ({NAMES})"
    train = f"SELECT date, {r('close')}, symbol FROM ({RAW})"
    return {
        "read_bars": bar_rows + f"({BY_TYPE})",
        "read_bars_csv": staged,
        "read_bars_json": staged,
        "daily_bars": bar_rows + f"({BY_TYPE})",
        "lookback": f"{bar_rows}({RAW}) JOIN (SELECT symbol, max(date) AS last_date FROM ({RAW})"
                    f" GROUP BY symbol) USING (symbol) WHERE date > last_date - {LOOKBACK_DAYS}",
        "lookback_as_of": f"{raw} WHERE date <= DATE '{LOOKBACK_END}'"
                          f" AND date > DATE '{LOOKBACK_END}' - {LOOKBACK_DAYS}",
        "symbol_universe": listed,
        "symbol_universe_literal": listed,
        "read_bars_named": listed,
        "missing_symbols": f"SELECT symbol FROM ({NAMES}) EXCEPT SELECT upper(event_type) FROM events",
        "wide_to_long": f"""
            SELECT s.symbol, d.date, {PRICES}, volume
            FROM (SELECT DISTINCT date FROM ({BY_TYPE})) d
            CROSS JOIN (SELECT DISTINCT symbol FROM ({BY_TYPE})) s
            LEFT JOIN ({BY_TYPE}) b ON b.symbol = s.symbol AND b.date = d.date""",
        "wide_flatten": f"""
            SELECT d.date, {PRICES}, volume FROM (SELECT DISTINCT date FROM ({BY_TYPE})) d
            LEFT JOIN (SELECT * FROM ({BY_TYPE}) WHERE symbol = '{FLAT_SYMBOL}') b
              ON b.date = d.date""",
        "ensure_tables": staged,
        "insert_columns": f"""
            SELECT symbol, date, CAST(NULL AS DOUBLE) AS open, {r('close')},
                   CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high,
                   CAST(NULL AS BIGINT) AS volume FROM ({RAW})""",
        "write_guard": f"SELECT count(*) AS rows_written, count(*) AS rows_stored FROM ({STAGE})",
        "full_refresh": raw,
        "refresh_touched": bar_rows + f"({REFRESHED})",
        "table_replace": train,
        "daily_run_mart": MART,
        "schema_contract": bar_rows + f"({TYPED})",
        "normalize_bars": staged,
        "clean_counts": f"SELECT symbol, count(*) AS rows_before, count(DISTINCT date) AS rows_after"
                        f" FROM ({TYPED}) GROUP BY symbol",
        "ingest_counts": f"SELECT symbol, count(*) AS rows_before, count(DISTINCT date) AS rows_after"
                         f" FROM ({TYPED}) GROUP BY symbol",
        "stage_dedup": raw,
        "dup_keys": DUPLICATES,
        "dup_key_count": f"SELECT count(*) AS dupes FROM ({DUPLICATES})",
        "dup_sample": f"""
            SELECT *, symbol || '|' || CAST(date AS VARCHAR) || ' -> ' || c || ' rows' AS line
            FROM ({DUPLICATES}) ORDER BY c DESC, symbol NULLS LAST, date NULLS LAST LIMIT 10""",
        "row_stats": f"SELECT count(*) AS total_rows,"
                     f" count(DISTINCT symbol || '|' || CAST(date AS VARCHAR)) AS distinct_pairs"
                     f" FROM ({TYPED})",
        "train_view": train,
        "stg_market_data": f"""
            SELECT DISTINCT symbol, date, {PRICES}, CAST(volume AS DOUBLE) + 0.0 AS volume,
                   symbol || '|' || CAST(date AS VARCHAR) AS pk_symbol_date FROM ({RAW})""",
        "stg_market_data_view": f"""
            SELECT DISTINCT symbol, date, {PRICES}, CAST(volume AS DOUBLE) + 0.0 AS volume,
                   symbol || '|' || CAST(date AS VARCHAR) AS pk_symbol_date FROM ({RAW})""",
        "stg_market_forecast_view": staged_forecast(False),
        "stg_market_forecast": staged_forecast(False),
        "stg_market_forecast_strict": staged_forecast(True),
        "final_union": f"SELECT symbol, date, {r('actual')}, {BAND} FROM ({final()})",
        "clean_series": f"SELECT symbol, CAST(last_ts + CAST(k AS INTEGER) AS DATE) AS date, {BAND}"
                        f" FROM ({ahead('trend')})",
        "mart_stock_analysis": MART,
        "trend_read": f"SELECT symbol, date, record_type, {MART_PRICES} FROM ({mart()})",
        "last_hist_date": f"SELECT symbol, max(date) AS max_hist_date FROM ({RAW}) GROUP BY symbol",
        "trend_params": f"SELECT symbol AS series, n AS n_obs, last_ts, {r('slope')},"
                        f" {r('intercept')}, {r('sigma')}, 'trend' AS method FROM ({trend_model()})",
        "trend_params_merged": f"SELECT symbol AS series, n AS n_obs, last_ts, {r('slope')},"
                               f" {r('intercept')}, {r('sigma')}, 'trend' AS method FROM ({trend_model()})",
        "skipped_series": f"SELECT symbol AS series, count(close) AS n_obs, 'too_few_obs' AS reason"
                          f" FROM ({RAW}) GROUP BY symbol HAVING count(close) < {MANY_OBS}",
        "forecast_trend": predictions(ahead("trend")),
        "forecast_trend_weekday": weekday_predictions(),
        "forecast_drift": predictions(ahead("drift")),
        "forecast_seasonal_naive": predictions(ahead("seasonal_naive")),
        "forecast_holt": predictions(ahead("holt")),
        "backtest_metrics": metrics("trend"),
        "backtest_drift": metrics("drift"),
        "backtest_seasonal_naive": metrics("seasonal_naive"),
        "backtest_holt": metrics("holt"),
        "dq_not_null": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS n_failing FROM ({TYPED}) WHERE {c} IS NULL"
            for c in ("symbol", "date", "close")),
        "dq_unique": f"SELECT pk_symbol_date, count(*) AS n_records FROM ({STAGED_KEYS})"
                     f" GROUP BY 1 HAVING count(*) > 1",
        "dq_accepted_values": "SELECT event_type, count(*) AS n_records FROM events"
                              f" WHERE event_type NOT IN {ACCEPTED} GROUP BY event_type",
        "dq_forecast_future": f"SELECT symbol, date, record_type, {r('forecast_price')},"
                              f" max_hist_date FROM ({LATE})",
        "dq_report": report(mart(HORIZON), LATE, accepted=True),
        "dq_report_stage": report(STAGED_KEYS, None, accepted=False),
        "dq_report_staged": report(f"SELECT DISTINCT * FROM ({STAGED_KEYS})", None, accepted=False),
        "snapshot_initial": version(BY_USER, T1, "NULL"),
        "snapshot_changes": CLASSES,
        "snapshot_apply": versions(),
        "snapshot_table": versions(),
        "snapshot_after_failure": versions(),
        "snapshot_compacted": versions(),
    }
