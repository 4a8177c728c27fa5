"""The registered queries once more, as SQL text for an independent engine.

Stand-in inputs are shared building blocks (common table expressions); bodies are written
from the meaning of each query, not from its Spark form.
"""

from __future__ import annotations

import re

# Building blocks: name -> (names it needs, text).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date,
            arg_min(value, ts) AS open_price, max(value) AS high_price, min(value) AS low_price,
            arg_max(value, ts) AS close_price, count(*) AS volume
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    ),
    "staging": (
        ("bars",),
        """SELECT ticker, trade_date AS snapshot_date, open_price AS open, high_price AS high,
            low_price AS low, close_price AS close, volume FROM bars""",
    ),
    "edge": ((), "SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events"),
    "tickers": (
        (),
        """SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name,
            c_mktsegment AS sector, c_mktsegment AS industry, cap AS market_cap,
            CASE WHEN cap IS NULL OR cap = 0 THEN 'Not Provided'
                 WHEN cap <= 250e6 THEN 'Micro Cap' WHEN cap <= 2e9 THEN 'Small Cap'
                 WHEN cap <= 10e9 THEN 'Mid Cap' WHEN cap <= 200e9 THEN 'Large Cap'
                 ELSE 'Mega Cap' END AS market_cap_description,
            r_name AS exchange, n_name AS country
        FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal * 25000000 END AS cap FROM customer)
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    ),
    "longbars": (
        (),
        """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
              / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close_price
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    ),
    "longrank": (
        ("longbars",),
        """SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS age_rank
        FROM longbars""",
    ),
    "longfeed": (
        ("longrank",),
        """SELECT ticker, close_price AS current_price, CAST(trade_date AS TIMESTAMP) AS last_updated_ts
        FROM longrank WHERE age_rank = 1""",
    ),
    "longbase": (
        ("longrank",),
        """SELECT ticker, arg_max(close_price, trade_date) AS close_price_last_day,
            {mean:CASE WHEN trade_date > as_of - 90 THEN close_price END} AS close_price_avg_last_90_days,
            {mean:CASE WHEN trade_date > as_of - 365 THEN close_price END} AS close_price_avg_last_365_days
        FROM longrank, (SELECT max(trade_date) AS as_of FROM longrank WHERE age_rank > 1)
        WHERE age_rank > 1 GROUP BY ticker""",
    ),
    "moves": (
        ("longfeed", "longbase"),
        """SELECT ticker, current_price, last_updated_ts, {moves}
        FROM longfeed JOIN longbase USING (ticker)""",
    ),
    "base": (
        ("bars", "edge"),
        """SELECT ticker, trade_date, close_price AS last_price, open_price, high_price, low_price,
            volume, CAST(NULL AS TIMESTAMP) AS last_updated_ts
        FROM bars, edge WHERE trade_date < hi
        QUALIFY trade_date = max(trade_date) OVER (PARTITION BY ticker)""",
    ),
    "feed": (
        ("edge",),
        """SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date,
            value AS last_price, value AS open_price, value AS high_price, value AS low_price,
            CAST(1 AS BIGINT) AS volume, ts AS last_updated_ts
        FROM events, edge WHERE CAST(ts AS DATE) = hi""",
    ),
    "snap": (
        ("feed",),
        """SELECT * FROM feed
        QUALIFY last_updated_ts = max(last_updated_ts) OVER (PARTITION BY ticker, trade_date)""",
    ),
    "upserted": (("base", "snap"), "SELECT * FROM base UNION ALL SELECT * FROM snap"),
    "today": (
        ("bars", "edge"),
        """SELECT ticker, trade_date, close_price AS last_price, open_price, volume
        FROM bars JOIN edge ON trade_date = hi""",
    ),
    "enriched": (
        ("today",),
        """SELECT ticker, open_price, last_price, volume,
            round((last_price - open_price) / open_price * 100, 2) + 0.0 AS pct_change,
            last_price * volume AS dollar_volume
        FROM today WHERE open_price > 0 AND volume > 0""",
    ),
    "ends": (
        ("bars", "edge"),
        """SELECT f.ticker, f.close_price AS earliest_close, l.close_price AS latest_close
        FROM edge JOIN bars f ON f.trade_date = lo
        JOIN bars l ON l.trade_date = hi AND l.ticker = f.ticker""",
    ),
    "gains": (
        ("ends", "tickers"),
        """SELECT tickers.*, latest_close,
            (latest_close - earliest_close) / nullif(earliest_close, 0) * 100 AS pct
        FROM ends JOIN tickers USING (ticker)""",
    ),
}


def _move(price: str, name: str, baseline: str) -> str:
    return (
        f"round({price} - {baseline}, 2) + 0.0 AS {name}, "
        f"round(100 * ({price} - {baseline}) / nullif({baseline}, 0), 2) + 0.0 AS {name}_pct"
    )


_MOVES = ", ".join(
    _move("current_price", name, baseline)
    for name, baseline in (
        ("m_price_change_last_day", "close_price_last_day"),
        ("m_price_change_last_90_days", "close_price_avg_last_90_days"),
        ("m_price_change_last_365_days", "close_price_avg_last_365_days"),
    )
)

_NO_MOVES = ", ".join(
    f"CAST(NULL AS DOUBLE) AS m_price_change_last_{span}{suffix}"
    for span in ("day", "90_days", "365_days")
    for suffix in ("", "_pct")
)

# Key -> (building blocks the body uses, body).
BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "cumulative_prices": (
        ("bars",),
        """SELECT ticker, list(close_price ORDER BY trade_date) AS price_history,
            max(trade_date) AS last_updated FROM bars GROUP BY ticker""",
    ),
    "dim_daily": (
        ("bars",),
        """SELECT ticker, list(close_price ORDER BY trade_date) AS price_history,
            arg_max(close_price, trade_date) AS latest_price, min(close_price) AS historic_low,
            max(close_price) AS historic_high, max(trade_date) AS last_updated
        FROM bars GROUP BY ticker""",
    ),
    "staging_to_fact": (("bars",), "SELECT * FROM bars WHERE trade_date = DATE '2024-01-15'"),
    "staging_to_fact_all": (("bars",), "SELECT * FROM bars"),
    "staging_dedup": (("staging",), "SELECT * FROM staging"),
    "fact_load_day": (("bars",), "SELECT * FROM bars"),
    "append_staging": (("staging",), "SELECT * FROM staging"),
    "ctas_details": (("tickers",), "SELECT * FROM tickers"),
    "csv_daily_roundtrip": (("staging",), "SELECT * FROM staging WHERE snapshot_date = DATE '2024-01-15'"),
    "csv_quarantine": (
        ("staging",),
        """SELECT coalesce(CASE WHEN day(snapshot_date) <> 7 THEN ticker END, '') AS ticker,
            CASE WHEN day(snapshot_date) IN (20, 21) THEN 'malformed line' WHEN day(snapshot_date) = 7 THEN 'no ticker'
                WHEN day(snapshot_date) = 13 THEN 'unreadable date' ELSE 'accepted' END AS reason,
            count(*) AS lines
        FROM staging GROUP BY ALL""",
    ),
    "csv_history_roundtrip": (("staging",), "SELECT * FROM staging"),
    "csv_details_roundtrip": (("tickers",), "SELECT * FROM tickers"),
    "typed_cast": (
        ("staging",),
        """SELECT ticker, CASE WHEN day(snapshot_date) <> 13 THEN snapshot_date END AS snapshot_date,
            CASE WHEN day(snapshot_date) <> 20 THEN open END AS open, high, low,
            CASE WHEN day(snapshot_date) <> 7 THEN close END AS close,
            CASE WHEN volume <> 4 THEN volume END AS volume
        FROM staging""",
    ),
    "normalize_ticker": (
        (),
        """SELECT CAST(c_custkey AS VARCHAR) AS ticker, replace(c_name, '#', '.') AS canonical
        FROM customer""",
    ),
    "wide_to_long_bars": (("staging",), "SELECT * FROM staging"),
    "wide_to_current_day": (
        ("feed",),
        """SELECT ticker, trade_date, arg_max(last_price, last_updated_ts) AS last_price,
            arg_min(last_price, last_updated_ts) AS open_price, max(last_price) AS high_price,
            min(last_price) AS low_price, count(*) AS volume,
            minute + INTERVAL 5 HOUR AS last_updated_ts
        FROM (SELECT *, date_trunc('minute', last_updated_ts) AS minute FROM feed)
        GROUP BY ticker, trade_date, minute
        QUALIFY minute = max(minute) OVER (PARTITION BY ticker)""",
    ),
    "drop_incomplete_bars": (
        ("staging",),
        "SELECT * FROM staging WHERE day(snapshot_date) NOT IN (9, 10)",
    ),
    "union_bars": (("staging",), "SELECT * FROM staging"),
    "json_bars_explode": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS ticker, arg_max(value, ts) AS current_price,
            max(ts) AS last_updated_ts
        FROM events GROUP BY user_id, CAST(ts AS DATE), hour(ts)""",
    ),
    "non_finite_fields": (
        ("staging",),
        """SELECT ticker, snapshot_date, CASE WHEN day(snapshot_date) NOT IN (5, 6) THEN open END AS open,
            CASE WHEN day(snapshot_date) <> 6 THEN high END AS high, low,
            CASE WHEN day(snapshot_date) NOT IN (8, 11) THEN close END AS close,
            CASE WHEN day(snapshot_date) <> 12 THEN volume END AS volume
        FROM staging""",
    ),
    "latest_of_ties": (
        ("feed",),
        """SELECT ticker, trade_date, max(date_trunc('hour', last_updated_ts)) AS last_updated_ts
        FROM feed GROUP BY ticker, trade_date""",
    ),
    "json_details_flatten": (
        ("tickers",),
        "SELECT * REPLACE (CASE sector WHEN 'HOUSEHOLD' THEN '' ELSE sector END AS sector) FROM tickers",
    ),
    "values_relation": (
        ("base",),
        """SELECT * FROM base UNION ALL
        SELECT * FROM (VALUES
            ('3', DATE '2024-01-30', 10.5::DOUBLE, 10.0::DOUBLE, 11.25::DOUBLE, 9.75::DOUBLE,
             300::BIGINT, TIMESTAMP '2024-01-30 15:30:00'),
            ('BRK.B', DATE '2024-01-30', 401.2, 400.0, 402.0, 399.9, 1200,
             TIMESTAMP '2024-01-30 15:31:00.25'),
            ('BF.B', DATE '2024-01-30', 55.0, NULL, NULL, NULL, 0, NULL))""",
    ),
    "page_list_items": (
        (),
        """SELECT DISTINCT page_id,
            unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) AS item
        FROM pages""",
    ),
    "page_table_symbols": (
        (),
        """SELECT c_custkey // 500 AS page_id, CAST(c_custkey AS VARCHAR) AS ticker FROM customer""",
    ),
    # summer time by its rule: from the second Sunday of March to the first of November
    "session_exchange": (
        (),
        """WITH years AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, year(ts) AS y FROM events),
        turns AS (SELECT *, make_date(y, 3, 8) + CAST((7 - isodow(make_date(y, 3, 8))) AS INTEGER) AS summer,
            make_date(y, 11, 1) + CAST((7 - isodow(make_date(y, 11, 1))) AS INTEGER) AS winter FROM years),
        clocks AS (SELECT event_id, ts, CASE WHEN ts >= summer + INTERVAL 7 HOUR AND ts < winter + INTERVAL 6 HOUR
            THEN ts - INTERVAL 4 HOUR ELSE ts - INTERVAL 5 HOUR END AS local FROM turns),
        minutes AS (SELECT *, hour(local) * 60 + minute(local) - 570 AS session_minute, strftime(local, '%m-%d') AS day FROM clocks)
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text, CAST(session_minute AS INTEGER) AS session_minute
        FROM minutes WHERE isodow(local) <= 5 AND day NOT IN ('01-01', '07-04', '12-25')
            AND session_minute >= 0 AND session_minute < CASE WHEN day = '12-24' THEN 210 ELSE 390 END""",
    ),
    "session_utc": (
        (),
        """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
            CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
        FROM events WHERE isodow(ts) <= 5 AND hour(ts) BETWEEN 13 AND 21""",
    ),
    "exchange_time_utc": (
        (),
        """SELECT event_id, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ts_utc
        FROM events""",
    ),
    "latest_bar_per_ticker": (
        ("bars",),
        "SELECT * FROM bars QUALIFY trade_date = max(trade_date) OVER (PARTITION BY ticker)",
    ),
    "init_current_day": (("base",), "SELECT * FROM base"),
    "latest_snapshot": (("snap",), "SELECT * FROM snap"),
    "session_snapshot": (
        ("bars",),
        """SELECT b.ticker, b.trade_date, b.close_price AS last_price, b.open_price, b.high_price,
            b.low_price, b.volume, u.last_updated_ts
        FROM bars b JOIN (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date,
                max(ts) AS last_updated_ts FROM events GROUP BY user_id, CAST(ts AS DATE)) u
            USING (ticker, trade_date)""",
    ),
    "merge_update_only": (
        ("base", "snap"),
        """SELECT b.ticker, b.trade_date,
            CASE WHEN p.ticker IS NULL THEN b.last_price ELSE p.last_price END AS last_price,
            b.open_price, b.high_price, b.low_price, b.volume, p.last_updated_ts
        FROM base b LEFT JOIN snap p ON p.ticker = b.ticker""",
    ),
    "merge_upsert": (("upserted",), "SELECT * FROM upserted"),
    "merge_upsert_bucketed": (("upserted",), "SELECT * FROM upserted"),
    "stream_current_day": (("upserted",), "SELECT * FROM upserted"),
    "stream_current_day_metrics": (
        ("longbase", "moves", "tickers"),
        """SELECT moves.* EXCLUDE (last_updated_ts), last_updated_ts AS last_updated_datetime,
            close_price_last_day, close_price_avg_last_90_days, close_price_avg_last_365_days,
            coalesce(market_cap_description, 'Not Provided') AS market_cap_description
        FROM moves JOIN longbase USING (ticker) LEFT JOIN tickers USING (ticker)""",
    ),
    "current_day_enriched": (("enriched",), "SELECT * FROM enriched"),
    "top_gainers": (("enriched",), "SELECT * FROM enriched ORDER BY pct_change DESC, ticker LIMIT 10"),
    "top_losers": (("enriched",), "SELECT * FROM enriched ORDER BY pct_change, ticker LIMIT 10"),
    "gainers_today": (
        ("today",),
        "SELECT count(*) AS gainers FROM today WHERE last_price > open_price",
    ),
    "dollar_volume_total": (
        ("today",),
        """SELECT CAST(sum(CAST(last_price AS DECIMAL(22,10)) * CAST(volume AS DECIMAL(15,0))) AS DOUBLE)
            AS dollar_volume FROM today""",
    ),
    "trailing_baselines": (
        ("longbars",),
        """SELECT ticker, arg_max(close_price, trade_date) AS close_price_last_day,
            {mean:CASE WHEN trade_date > as_of - 90 THEN close_price END} AS close_price_avg_last_90_days,
            {mean:CASE WHEN trade_date > as_of - 365 THEN close_price END} AS close_price_avg_last_365_days
        FROM longbars, (SELECT max(trade_date) AS as_of FROM longbars) GROUP BY ticker""",
    ),
    "baselines_asof": (
        ("longbars",),
        """SELECT as_of, ticker, arg_max(close_price, trade_date) AS close_price_last_day,
            {mean:CASE WHEN trade_date > as_of - 90 THEN close_price END} AS close_price_avg_last_90_days,
            {mean:CASE WHEN trade_date > as_of - 365 THEN close_price END} AS close_price_avg_last_365_days
        FROM longbars, (VALUES (DATE '1993-12-31'), (DATE '1995-06-17'), (DATE '1998-12-31')) days(as_of)
        WHERE trade_date <= as_of GROUP BY as_of, ticker""",
    ),
    "trailing_baselines_short": (
        ("bars", "edge"),
        """SELECT ticker, arg_max(close_price, trade_date) AS close_price_last_day,
            {mean:CASE WHEN trade_date > hi - 7 THEN close_price END} AS close_price_avg_last_7_days,
            {mean:CASE WHEN trade_date > hi - 30 THEN close_price END} AS close_price_avg_last_30_days
        FROM bars, edge GROUP BY ticker""",
    ),
    "rolling_averages": (
        ("longbars",),
        """SELECT ticker, trade_date,
            round(CAST(sum(CAST(close_price AS DECIMAL(30,12))) OVER quarter AS DOUBLE)
                / count(*) OVER quarter, 4) AS avg_90d,
            round(CAST(sum(CAST(close_price AS DECIMAL(30,12))) OVER year AS DOUBLE)
                / count(*) OVER year, 4) AS avg_365d
        FROM longbars WINDOW
            quarter AS (PARTITION BY ticker ORDER BY trade_date
                RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW),
            year AS (PARTITION BY ticker ORDER BY trade_date
                RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW)""",
    ),
    "init_metrics_table": (
        ("longbase", "tickers"),
        f"""SELECT longbase.*, CAST(NULL AS DOUBLE) AS current_price, {_NO_MOVES},
            coalesce(market_cap_description, 'Not Provided') AS market_cap_description,
            CAST(NULL AS TIMESTAMP) AS last_updated_datetime
        FROM longbase LEFT JOIN tickers USING (ticker)""",
    ),
    "price_change_metrics": (("moves",), "SELECT * FROM moves"),
    "filtered_moves": (
        ("moves", "tickers"),
        """SELECT m.ticker, current_price, m_price_change_last_day_pct AS pct
        FROM moves m JOIN tickers t ON t.ticker = m.ticker
        WHERE m_price_change_last_day_pct > 0 AND t.sector IN ('BUILDING', 'MACHINERY')
            AND t.market_cap_description IN ('Mega Cap', 'Large Cap')
        ORDER BY pct DESC, m.ticker LIMIT 50""",
    ),
    "first_last_close": (("ends",), "SELECT * FROM ends"),
    "sector_performance": (
        ("gains",),
        "SELECT sector, round(avg(pct), 2) + 0.0 AS avg_return_pct FROM gains GROUP BY sector",
    ),
    "stock_ranking": (
        ("gains",),
        """SELECT ticker, company_name, sector, round(latest_close, 2) AS latest_close,
            round(pct, 2) + 0.0 AS total_return_pct
        FROM gains ORDER BY total_return_pct DESC NULLS LAST, ticker LIMIT 50""",
    ),
    "filtered_ranking": (
        ("gains",),
        """SELECT ticker, company_name, sector, round(latest_close, 2) AS latest_close,
            round(pct, 2) + 0.0 AS total_return_pct
        FROM gains
        WHERE sector IN ('BUILDING', 'MACHINERY')
            AND market_cap_description IN ('Mega Cap', 'Large Cap')
        ORDER BY total_return_pct DESC NULLS LAST, ticker LIMIT 50""",
    ),
    "market_trend": (
        ("bars",),
        "SELECT trade_date, {mean:close_price} AS avg_close FROM bars GROUP BY trade_date",
    ),
    "top_volume": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS ticker, count(*) AS total_volume FROM events
        GROUP BY user_id ORDER BY total_volume DESC, ticker LIMIT 20""",
    ),
    "market_cap_class": (("tickers",), "SELECT ticker, market_cap, market_cap_description FROM tickers"),
    "market_cap_distribution": (
        ("tickers",),
        "SELECT market_cap_description, count(*) AS cnt FROM tickers GROUP BY market_cap_description",
    ),
    "dq_null_checks": (
        ("bars",),
        """SELECT bool_and(ticker IS NOT NULL) AS ticker_ok, bool_and(close_price IS NOT NULL) AS close_ok,
            bool_and(trade_date IS NOT NULL) AS date_ok FROM bars""",
    ),
    "dq_row_counts": (
        ("bars", "base"),
        """SELECT unnest(['raw.staging', 'stg.fact', 'marts.cumulative', 'marts.dim_daily',
                'marts.dim_ticker', 'marts.current_day']) AS tbl,
            unnest([n, n, users, users, (SELECT count(*) FROM customer), (SELECT count(*) FROM base)]) AS cnt
        FROM (SELECT count(*) AS n, count(DISTINCT ticker) AS users FROM bars)""",
    ),
    "dq_dim_matches_fact": (
        (),
        """SELECT n AS dim_rows, n AS tickers, true AS matches
        FROM (SELECT count(DISTINCT user_id) AS n FROM events)""",
    ),
    "dq_report": (
        (),
        """SELECT unnest(['ticker not null', 'close_price not null', 'trade_date not null',
                'dim rows match tickers']) AS check_name, true AS passed,
            unnest([0, 0, 0, n]) AS observed, unnest([0, 0, 0, n]) AS expected
        FROM (SELECT count(DISTINCT user_id) AS n FROM events)""",
    ),
    "current_day_sanity": (
        ("feed",),
        """SELECT count(DISTINCT ticker) AS n,
            strftime(max(last_updated_ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_ts,
            count(DISTINCT ticker) >= 100 AS passed FROM feed""",
    ),
    "load_profile": (
        ("staging",),
        """SELECT count(*) AS row_count, min(snapshot_date) AS first_date,
            max(snapshot_date) AS last_date, count(DISTINCT ticker) AS tickers FROM staging""",
    ),
}
BODIES["daily_batch"] = BODIES["dim_daily_incremental"] = BODIES["dim_daily"]
_CHOSEN = (
    "SELECT ticker FROM tickers WHERE sector IN ('BUILDING', 'MACHINERY')"
    " AND market_cap_description IN ('Mega Cap', 'Large Cap')"
)
BODIES |= {
    "filtered_trend": (
        ("bars", "tickers"),
        f"""SELECT trade_date, {{mean:close_price}} AS avg_close FROM bars
        WHERE ticker IN ({_CHOSEN}) GROUP BY trade_date""",
    ),
    "filtered_volume": (
        ("bars", "tickers"),
        f"""SELECT ticker, CAST(sum(volume) AS BIGINT) AS total_volume FROM bars
        WHERE ticker IN ({_CHOSEN}) GROUP BY ticker ORDER BY total_volume DESC, ticker LIMIT 20""",
    ),
    "filtered_distribution": (
        ("tickers",),
        f"""SELECT market_cap_description, count(*) AS cnt FROM tickers
        WHERE ticker IN ({_CHOSEN}) GROUP BY market_cap_description""",
    ),
    "dq_report_spoiled": (
        ("bars", "edge"),
        """SELECT unnest(['ticker not null', 'close_price not null', 'trade_date not null',
                'dim rows match tickers']) AS check_name,
            unnest([true, gaps = 0, true, present = n]) AS passed,
            unnest([0, gaps, 0, present]) AS observed, unnest([0, 0, 0, n]) AS expected
        FROM (SELECT count(*) FILTER (WHERE day(trade_date) = 9) AS gaps, count(DISTINCT ticker) AS n,
                count(DISTINCT ticker) FILTER (WHERE trade_date = hi) AS present FROM bars, edge)""",
    ),
    "dq_dim_lacks_tickers": (
        ("bars", "edge"),
        """SELECT present AS dim_rows, n AS tickers, present = n AS matches
        FROM (SELECT count(DISTINCT ticker) AS n,
                count(DISTINCT ticker) FILTER (WHERE trade_date = hi) AS present FROM bars, edge)""",
    ),
}
for _short, _span in {"last": "day", "90d": "90_days", "365d": "365_days"}.items():
    for _side, _test, _order in (("above", "> 0", "DESC"), ("below", "< 0", "ASC")):
        BODIES[f"top_{_side}_{_short}"] = (
            ("moves",),
            f"""SELECT ticker, current_price, m_price_change_last_{_span}_pct AS pct FROM moves
            WHERE m_price_change_last_{_span}_pct {_test} ORDER BY pct {_order}, ticker LIMIT 50""",
        )


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(BLOCKS[name][0], seen)
            seen.append(name)
    return seen


# Exact sums at a precision that covers the prices: sums of doubles, which depend on the order of
# rows, differ where a mean falls on a rounding boundary.
_MEAN = r"round(CAST(sum(CAST(\1 AS DECIMAL(30,12))) AS DOUBLE) / count(\1), 4)"


def _written_out(text: str) -> str:
    return re.sub(r"\{mean:([^}]*)\}", _MEAN, text.replace("{moves}", _MOVES))


#: Other ways to the same rows.
SAME_ROWS = {"dim_daily_caught_up": "dim_daily", "merge_update_bucketed": "merge_update_only", "stream_keyed_state": "merge_upsert"}
BODIES.update({key: BODIES[of] for key, of in SAME_ROWS.items()})


def statements() -> dict[str, str]:
    out = {}
    for key, (uses, body) in BODIES.items():
        blocks = [f"{n} AS ({_written_out(BLOCKS[n][1])})" for n in _needed(uses, [])]
        out[key] = (f"WITH {', '.join(blocks)} " if blocks else "") + _written_out(body)
    return out
