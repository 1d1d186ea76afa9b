"""The same queries as SQL for an independent engine.

``TABLES`` are common table expressions over the trading tables; ``QUERIES``
hold one body per query. ``statement`` puts the tables a body mentions, and
those they mention in turn, in front of it.
"""

from __future__ import annotations

import re

STAMP = "TIMESTAMP '2002-01-01 21:15:00'"
PRICES = ("open", "high", "low", "close")
LEVELS = (5, 10, 15, 20, 25, 30)
FACTORS = {5: "0.95", 10: "0.90", 15: "0.85", 20: "0.80", 25: "0.75", 30: "0.70"}
SHOWN = (
    "Supplier#000000003",
    "Supplier#000000001",
    "Supplier#000000008",
    "Supplier#999999999",
    "Supplier#000000005",
)


def apart(value: str, base: str) -> str:
    """Rounded difference."""
    return f"round({value} - {base}, 2)"


def apart_pct(value: str, base: str, whole: str) -> str:
    """Rounded difference in percent of ``whole``."""
    return f"round(({value} - {base}) / nullif({whole}, 0) * 100, 2)"


def exact(value: str, places: int = 6) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(28,{places}))) AS DOUBLE)"


def to(value: str, places: int) -> str:
    scale = f"CAST(1e{places} AS DOUBLE)"
    return f"(round(({value}) * {scale}) / {scale})"


def latest_ratio(value: str) -> str:
    return (
        f"CASE WHEN {value} = 0 THEN {value} ELSE {value} * CASE "
        "WHEN n.close IS NOT NULL AND n.close_eur IS NOT NULL "
        "THEN n.close_eur / nullif(n.close, 0) ELSE CAST(0.85 AS DOUBLE) END END"
    )


def pivoted(value: str, source: str, target: str) -> str:
    return (
        f"CASE WHEN {source} IS NOT NULL AND {target} IS NOT NULL "
        f"THEN ({value}) * {source} / {target} ELSE {value} END"
    )


def rate_of(currency: str) -> str:
    return f"(SELECT rate_to_eur FROM pivot_rates WHERE currency = '{currency}')"


_wide_levels = ", ".join(
    f"high_52week * CAST({f} AS DOUBLE) AS decrease_{n}_price"
    for n, f in FACTORS.items()
)
_level_names = ", ".join(f"decrease_{n}_price" for n in LEVELS)
_bar_order = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"
)


def _snapshot(as_of: str, high: str = "high") -> str:
    return f"""
      SELECT symbol_id, {as_of} AS calculation_date,
             max({high}) AS high_52week, min(low) AS low_52week,
             min(date) FILTER (WHERE {high} = hi) AS high_date,
             min(date) FILTER (WHERE low = lo) AS low_date
      FROM (SELECT *, max({high}) OVER (PARTITION BY symbol_id) AS hi,
                   min(low) OVER (PARTITION BY symbol_id) AS lo
            FROM etf_data
            WHERE date BETWEEN {as_of} - 365 AND {as_of})
      GROUP BY symbol_id"""


_newest = "(SELECT max(date) FROM etf_data)"


def _batch_eur(fill_base: bool) -> str:
    """EUR columns of landed bars ``b`` by the rate of their day."""
    native = "b.{c}" if fill_base else "CAST(NULL AS DOUBLE)"
    return ", ".join(
        f"CASE WHEN s.currency = 'EUR' THEN {native.format(c=c)} "
        f"WHEN b.{c} <> 0 THEN {to(f'b.{c} * r.exchange_rate', 2)} END AS {c}_eur"
        for c in PRICES
    )


_batch_joins = """
      LEFT JOIN symbols s ON s.id = b.symbol_id
      LEFT JOIN currency_rates r ON r.from_currency = s.currency
           AND r.to_currency = 'EUR' AND r.rate_date = b.date"""


def _merge(
    table: str, batch: str, keys: list[str], values: list[str], order: list[str]
) -> str:
    """Rows of ``table`` after an upsert of ``batch`` (one row per key)."""
    on = " AND ".join(f"t.{k} = b.{k}" for k in keys)
    text = "concat_ws('|', " + ", ".join(f"CAST(b.{k} AS VARCHAR)" for k in keys) + ")"
    ranked = ", ".join([f"substr(md5({text}), 1, 3)", *(f"b.{k}" for k in keys)])
    kept = {
        "id": "t.id",
        "created_at": "t.created_at",
        **{k: f"t.{k}" for k in keys},
        **{
            v: f"CASE WHEN b.{keys[0]} IS NULL THEN t.{v} ELSE b.{v} END" for v in values
        },
    }
    added = {
        "id": f"(SELECT max(id) FROM {table}) + row_number() OVER (ORDER BY {ranked})",
        "created_at": STAMP,
        **{k: f"b.{k}" for k in keys},
        **{v: f"b.{v}" for v in values},
    }
    names = ["id", *order, "created_at"]
    first = ", ".join(f"{kept[c]} AS {c}" for c in names)
    second = ", ".join(f"{added[c]} AS {c}" for c in names)
    return f"""
      SELECT {first} FROM {table} t LEFT JOIN {batch} b ON {on}
      UNION ALL
      SELECT {second} FROM {batch} b
      WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {on})"""


_bar_values = [*PRICES, "volume", *(f"{c}_eur" for c in PRICES)]
_bar_columns = ", ".join(["symbol_id", "date", *PRICES, "volume"])


def _last_versions(source: str) -> str:
    """Last version of each day's bar, of active symbols."""
    return f"""
      SELECT * FROM {source} WHERE symbol_id IN (SELECT id FROM symbols WHERE is_active)
      QUALIFY row_number() OVER (PARTITION BY symbol_id, date ORDER BY seq DESC) = 1"""


def _report(source: str) -> str:
    """Batch gate over bars ``source``."""
    fields = [*PRICES, "volume"]
    missing = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}" for c in fields
    )
    negative = ", ".join(
        f"count(*) FILTER (WHERE {c} < 0) AS negative_{c}" for c in PRICES
    )
    messages = [
        f"CASE WHEN missing_{c} > 0 THEN 'Missing ' || missing_{c} || "
        f"' values in {c.title()}' END"
        for c in fields
    ]
    messages += [
        f"CASE WHEN negative_{c} > 0 THEN 'Found ' || negative_{c} || "
        f"' negative prices in {c.title()}' END"
        for c in PRICES
    ]
    messages.append(
        "CASE WHEN extreme_moves > 0 THEN 'Found ' || extreme_moves || "
        "' extreme price movements (>50%)' END"
    )
    messages.append(
        "CASE WHEN zero_volume_bars > bars * 0.5 THEN "
        "'High number of zero volume days: ' || zero_volume_bars END"
    )
    listed = f"concat_ws('; ', {', '.join(messages)})"
    return f"""
      SELECT *, {listed} AS issues, {listed} = '' AS is_valid
      FROM (SELECT symbol_id, count(*) AS bars, {missing}, {negative},
              count(*) FILTER (WHERE abs(close / nullif(previous, 0) - 1) > 0.5
                OR (previous = 0 AND close <> 0)) AS extreme_moves,
              count(*) FILTER (WHERE volume = 0) AS zero_volume_bars
            FROM (SELECT *, lag(close) OVER (PARTITION BY symbol_id ORDER BY date)
                    AS previous FROM {source})
            GROUP BY symbol_id)"""


_eur_chain = ", ".join(
    f"coalesce(p.{c}_eur, CASE WHEN p.native_currency <> 'EUR' THEN "
    f"coalesce({to(f'p.{c} * d.exchange_rate', 2)}, "
    f"{to(f'p.{c} * l.exchange_rate', 2)}) END, p.{c}) AS {c}_eur"
    for c in PRICES
)

_described = "s.ticker, s.name AS etf_name, s.isin, s.exchange, s.currency AS native_currency"

_required = ("isin", "ticker", "name", "asset_type", "exchange", "currency")
_missing_list = ", ".join(
    f"CASE WHEN coalesce({c}, '') = '' THEN 'Missing or empty required field: {c}' END"
    for c in _required
)
_content_list = """
  CASE WHEN NOT regexp_full_match(isin, '[A-Z]{2}[A-Z0-9]{9}[0-9]') THEN
         'ISIN must be 12 characters: 2 letters + 9 alphanumeric + 1 check digit'
       WHEN left(isin, 2) NOT IN ('IE', 'US') THEN
         'ISIN must start with ''IE'' (UCITS) or ''US'' (US-listed)' END,
  CASE WHEN asset_type NOT IN ('ETF', 'STOCK') THEN
         'Invalid asset_type. Must be one of: [''ETF'', ''STOCK'']' END,
  CASE WHEN exchange NOT IN ('LSE', 'NYSE', 'NASDAQ') THEN
         'Invalid exchange. Must be one of: [''LSE'', ''NYSE'', ''NASDAQ'']' END,
  CASE WHEN left(isin, 2) = 'IE' AND exchange <> 'LSE' THEN
         'Irish ISINs (UCITS) must use LSE exchange'
       WHEN left(isin, 2) = 'US' AND exchange NOT IN ('NYSE', 'NASDAQ') THEN
         'US ISINs must use NYSE or NASDAQ exchange' END,
  CASE WHEN currency NOT IN ('USD', 'GBP', 'EUR') THEN
         'Invalid currency. Must be one of: [''USD'', ''GBP'', ''EUR'']' END"""


TABLES = {
    "nation_currency": """
      SELECT n_nationkey, CASE r_name WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'GBP'
             WHEN 'MIDDLE EAST' THEN 'CHF' ELSE 'USD' END AS currency
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "symbols": """
      SELECT s_suppkey AS id,
             CASE WHEN s_suppkey % 2 = 0 THEN 'IE' ELSE 'US' END
               || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')
               || CAST(s_suppkey % 10 AS VARCHAR) AS isin,
             s_name AS ticker, 'Fund ' || s_name AS name,
             CASE WHEN s_suppkey % 5 = 4 THEN 'STOCK' ELSE 'ETF' END AS asset_type,
             CASE WHEN s_suppkey % 2 = 0 THEN 'LSE' WHEN s_suppkey % 4 = 1 THEN 'NYSE'
                  ELSE 'NASDAQ' END AS exchange,
             currency, TIMESTAMP '2021-12-01 00:00:00' AS created_at,
             s_suppkey % 7 <> 6 AS is_active
      FROM supplier JOIN nation_currency ON s_nationkey = n_nationkey""",
    "currency_rates": f"""
      SELECT CASE WHEN currency = 'USD' THEN 200000 ELSE 100000 END
               + CAST(day - DATE '1970-01-01' AS BIGINT) AS id,
             currency AS from_currency, 'EUR' AS to_currency, day AS rate_date,
             CASE WHEN day(day) = 13 THEN CAST(0 AS DOUBLE) ELSE
               {to("total / n / CAST(250000 AS DOUBLE)", 6)} END AS exchange_rate,
             CAST(day AS TIMESTAMP) + INTERVAL 1275 MINUTE AS created_at
      FROM (SELECT currency, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
                   {exact("o_totalprice", 2)} AS total
            FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation_currency ON c_nationkey = n_nationkey
            WHERE currency IN ('USD', 'GBP') GROUP BY 1, 2)""",
    "folded": f"""
      SELECT l_suppkey AS symbol_id, CAST(l_shipdate AS DATE) AS date,
             first(px ORDER BY {_bar_order}) AS open, max(px) AS high, min(px) AS low,
             last(px ORDER BY {_bar_order}) AS close,
             CAST(sum(l_quantity) AS BIGINT) AS volume
      FROM (SELECT *, CAST(60 AS DOUBLE) + l_extendedprice / CAST(2000 AS DOUBLE) AS px
            FROM lineitem)
      GROUP BY 1, 2""",
    "etf_data": f"""
      SELECT b.symbol_id * 100000 + CAST(b.date - DATE '1970-01-01' AS BIGINT) AS id,
             b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {", ".join(f"CASE WHEN day(b.date) % 3 = 0 THEN e.{c}_eur END AS {c}_eur" for c in PRICES)},
             CAST(b.date AS TIMESTAMP) + INTERVAL 1275 MINUTE AS created_at
      FROM folded b JOIN (SELECT b.symbol_id, b.date, {_batch_eur(False)}
                          FROM folded b {_batch_joins}) e
        ON e.symbol_id = b.symbol_id AND e.date = b.date""",
    "both_snapshots": f"""
      {_snapshot(_newest)} UNION ALL {_snapshot(f"({_newest} - 30)")}""",
    "metrics": """
      SELECT symbol_id * 100000 + CAST(calculation_date - DATE '1970-01-01' AS BIGINT) AS id,
             *, CAST(calculation_date AS TIMESTAMP) + INTERVAL 1275 MINUTE AS created_at
      FROM both_snapshots""",
    "thresholds": f"""
      SELECT id, symbol_id, calculation_date, high_52week AS high_52week_price,
             {_wide_levels}, created_at FROM metrics""",
    "holdings": f"""
      SELECT o_custkey AS holder, l_suppkey AS symbol_id,
             CASE any_value(c_nationkey) % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'Australia'
               WHEN 2 THEN 'Germany' ELSE 'France' END AS country,
             CAST(sum(l_quantity) AS BIGINT) AS units,
             {exact("l_quantity * (CAST(60 AS DOUBLE) + l_extendedprice / CAST(2000 AS DOUBLE))")}
               AS cost
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    # landed files
    "landed": f"""
      SELECT symbol_id, date, open, high, low, close * CAST(1.01 AS DOUBLE) AS close,
             volume, 1 AS seq FROM etf_data WHERE date > {_newest} - 10
      UNION ALL
      SELECT symbol_id, date + 5, open, high, low, close, volume, 1
      FROM etf_data WHERE date > {_newest} - 5
      UNION ALL
      SELECT symbol_id, date, open, high, low, close * CAST(1.02 AS DOUBLE), volume, 2
      FROM etf_data WHERE date = {_newest}""",
    "landed_once": f"""
      SELECT b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {_batch_eur(False)}
      FROM (SELECT * FROM landed
            QUALIFY row_number() OVER (PARTITION BY symbol_id, date ORDER BY seq DESC) = 1) b
      {_batch_joins}""",
    "landed_rates": """
      WITH top AS (SELECT max(rate_date) AS day FROM currency_rates),
           r AS (SELECT * FROM currency_rates, top)
      SELECT from_currency, to_currency, rate_date,
             exchange_rate * CAST(1.01 AS DOUBLE) AS exchange_rate, 1 AS seq
      FROM r WHERE rate_date > day - 10
      UNION ALL
      SELECT from_currency, to_currency, rate_date + 5, exchange_rate, 1
      FROM r WHERE rate_date > day - 5
      UNION ALL
      SELECT from_currency, to_currency, rate_date,
             exchange_rate * CAST(1.02 AS DOUBLE), 2
      FROM r WHERE rate_date = day""",
    "landed_rates_once": """
      SELECT * FROM landed_rates QUALIFY row_number() OVER (
        PARTITION BY from_currency, to_currency, rate_date ORDER BY seq DESC) = 1""",
    "computed": f"""
      {_snapshot(_newest, "high * CAST(1.01 AS DOUBLE)")}
      UNION ALL {_snapshot(f"({_newest} - 7)")}""",
    "computed_levels": f"""
      SELECT symbol_id, calculation_date, high_52week AS high_52week_price, {_wide_levels}
      FROM computed""",
    "new_symbols": """
      SELECT 'US9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
               || CAST(c_custkey % 10 AS VARCHAR) AS isin,
             c_name AS ticker, 'Fund ' || c_name AS name, 'ETF' AS asset_type,
             'NYSE' AS exchange, 'USD' AS currency FROM customer""",
    "symbol_file": """
      SELECT CASE WHEN id % 11 = 3 THEN lower(isin)
                  WHEN id % 11 = 5 THEN 'DE' || substr(isin, 3)
                  WHEN id % 11 = 7 THEN NULL ELSE isin END AS isin,
             ticker, CASE WHEN id % 13 = 4 THEN '' ELSE name END AS name,
             CASE WHEN id % 17 = 2 THEN 'BOND' ELSE asset_type END AS asset_type,
             CASE WHEN id % 19 = 6 THEN 'XETRA' WHEN id % 7 = 5 THEN 'LSE'
                  ELSE exchange END AS exchange, currency, 1 AS seq
      FROM symbols
      UNION ALL
      SELECT isin, ticker || '.X', name, asset_type, exchange, currency, 2
      FROM symbols WHERE id % 10 = 0""",
    "checked_file": f"""
      SELECT isin, ticker, seq,
             CASE WHEN concat_ws('; ', {_missing_list}) <> ''
                  THEN concat_ws('; ', {_missing_list})
                  ELSE concat_ws('; ', {_content_list}) END AS errors
      FROM symbol_file""",
    "file_values": """
      SELECT field, value, count(*) AS occurrences FROM (
        SELECT 'isin' AS field, isin AS value FROM symbol_file
        UNION ALL SELECT 'name', name FROM symbol_file
        UNION ALL SELECT 'ticker', ticker FROM symbol_file)
      GROUP BY ALL HAVING count(*) > 1""",
    "file_once": """
      SELECT isin, arg_max({'t': ticker, 'n': name, 'a': asset_type, 'e': exchange,
                            'c': currency}, seq) AS f
      FROM symbol_file GROUP BY isin""",
    # staging and marts
    "staged": f"""
      SELECT e.id, e.symbol_id, {_described}, e.* EXCLUDE (id, symbol_id)
      FROM etf_data e JOIN symbols s ON e.symbol_id = s.id AND s.is_active""",
    "staged_fx": "SELECT * FROM currency_rates WHERE exchange_rate > 0",
    "last_fx": """
      SELECT from_currency, to_currency, max(rate_date) AS rate_date,
             arg_max(exchange_rate, rate_date) AS exchange_rate
      FROM staged_fx GROUP BY ALL""",
    "eur_prices": f"""
      SELECT p.id, p.symbol_id, p.ticker, p.etf_name, p.isin, p.exchange,
             p.native_currency, p.date, p.open, p.high, p.low, p.close, p.volume,
             {_eur_chain}
      FROM staged p
      LEFT JOIN staged_fx d ON d.from_currency = p.native_currency
           AND d.rate_date = p.date AND d.to_currency = 'EUR'
      LEFT JOIN last_fx l ON l.from_currency = p.native_currency
           AND l.to_currency = 'EUR'""",
    "history": f"""
      SELECT * EXCLUDE (id, symbol_id),
             {apart("close", "open")} AS daily_change,
             {apart_pct("close", "open", "open")} AS daily_change_pct,
             {apart("close_eur", "open_eur")} AS daily_change_eur,
             {apart_pct("close_eur", "open_eur", "open_eur")} AS daily_change_eur_pct,
             round(avg(close_eur) OVER seven, 2) AS close_eur_7d_avg
      FROM eur_prices WINDOW seven AS (
        PARTITION BY ticker ORDER BY date ROWS 6 PRECEDING)""",
    "last_price": """
      SELECT ticker, date AS latest_price_date, close AS latest_close,
             close_eur AS latest_close_eur, daily_change_eur_pct
      FROM history QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""",
    "last_metrics": """
      SELECT * FROM metrics QUALIFY row_number() OVER (
        PARTITION BY symbol_id ORDER BY calculation_date DESC) = 1""",
    "last_thresholds": """
      SELECT * FROM thresholds QUALIFY row_number() OVER (
        PARTITION BY symbol_id ORDER BY calculation_date DESC) = 1""",
    "week52": f"""
      SELECT {_described}, m.high_52week, m.low_52week, m.high_date, m.low_date,
             m.calculation_date,
             {apart("high_52week", "low_52week")} AS range_52week,
             {apart_pct("high_52week", "low_52week", "low_52week")} AS range_52week_pct,
             latest_price_date, latest_close, latest_close_eur, daily_change_eur_pct,
             {apart("high_52week", "latest_close")} AS distance_from_high,
             {apart_pct("high_52week", "latest_close", "high_52week")}
               AS pct_below_52w_high,
             {apart("latest_close", "low_52week")} AS distance_from_low,
             {apart_pct("latest_close", "low_52week", "low_52week")}
               AS pct_above_52w_low
      FROM last_metrics m JOIN symbols s ON s.id = m.symbol_id AND s.is_active
      LEFT JOIN last_price p ON p.ticker = s.ticker""",
    "level_rows": f"""
      SELECT symbol_id, calculation_date, high_52week_price, pct_below, threshold_price
      FROM last_thresholds,
      LATERAL (VALUES {", ".join(f"({n}, decrease_{n}_price)" for n in LEVELS)})
        AS v(pct_below, threshold_price)""",
    "ladder": f"""
      SELECT s.ticker, s.name AS etf_name, s.exchange, s.currency AS native_currency,
             u.calculation_date, u.high_52week_price, u.pct_below, u.threshold_price,
             coalesce(latest_close <= threshold_price, false) AS is_at_or_below_threshold,
             {apart("latest_close", "threshold_price")} AS gap_to_threshold,
             {apart_pct("latest_close", "threshold_price", "threshold_price")}
               AS gap_to_threshold_pct,
             latest_close, latest_close_eur
      FROM level_rows u JOIN symbols s ON s.id = u.symbol_id AND s.is_active
      LEFT JOIN last_price p ON p.ticker = s.ticker""",
    "fx_mart": """
      SELECT from_currency, to_currency, rate_date, exchange_rate
      FROM staged_fx WHERE to_currency = 'EUR'""",
    "pivot_rates": """
      SELECT 'EUR' AS currency, CAST(1 AS DOUBLE) AS rate_to_eur
      UNION ALL
      SELECT from_currency, arg_max(exchange_rate, rate_date) FROM fx_mart GROUP BY 1""",
    "newest_bar": """
      SELECT symbol_id, date, close, close_eur FROM etf_data
      QUALIFY row_number() OVER (PARTITION BY symbol_id ORDER BY date DESC) = 1""",
    # portfolio
    "returns": """
      SELECT ticker, date, (close_eur - previous) / previous AS daily_return
      FROM (SELECT *, lag(close_eur) OVER (PARTITION BY ticker ORDER BY date) AS previous
            FROM history)
      WHERE previous > 0 AND close_eur <> 0""",
    "falls": """
      SELECT ticker, date, close_eur, peak,
             (close_eur - peak) / nullif(peak, 0) AS drawdown
      FROM (SELECT ticker, date, close_eur, max(close_eur) OVER (
              PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak
            FROM history WHERE close_eur IS NOT NULL)""",
    "deepest": """
      SELECT t.ticker, coalesce(w.drawdown, CAST(0 AS DOUBLE)) AS max_drawdown,
             w.date AS drawdown_date, CAST(year(w.date) AS INTEGER) AS drawdown_year
      FROM (SELECT DISTINCT ticker FROM falls) t
      LEFT JOIN (SELECT * FROM falls WHERE drawdown < 0 QUALIFY row_number() OVER (
                   PARTITION BY ticker ORDER BY drawdown, date) = 1) w USING (ticker)""",
    "vols": """
      SELECT ticker, count(*) AS returns,
             stddev_pop(daily_return) * sqrt(CAST(252 AS DOUBLE)) AS volatility
      FROM returns GROUP BY ticker""",
    "growth_rates": f"""
      SELECT *, CASE WHEN first_price > 0 AND last_price <> 0 AND years > 0 THEN
               greatest(0, least(0.30, pow(last_price / first_price, 1 / years) - 1))
             ELSE 0.10 END AS cagr
      FROM (SELECT ticker, arg_min(close_eur, date) AS first_price,
                   arg_max(close_eur, date) AS last_price, min(date) AS first_date,
                   max(date) AS last_date,
                   (max(date) - min(date)) / CAST(365.25 AS DOUBLE) AS years
            FROM history GROUP BY ticker)""",
    "ticker_amounts": f"""
      SELECT ticker, {pivoted("CAST(10000 AS DOUBLE)", "rate_to_eur", rate_of("EUR"))} AS amount_eur,
             {pivoted("CAST(10000 AS DOUBLE)", "rate_to_eur", rate_of("USD"))} AS amount_usd
      FROM (SELECT ticker, any_value(native_currency) AS currency FROM history GROUP BY 1)
      LEFT JOIN pivot_rates USING (currency)""",
    "priced": f"""
      SELECT h.*, s.ticker, s.currency AS native_currency, w.latest_close,
             w.latest_close_eur, p.rate_to_eur AS source_rate,
             CASE WHEN country IN ('Germany', 'France') THEN {rate_of("EUR")}
                  ELSE {rate_of("USD")} END AS target_rate
      FROM holdings h JOIN symbols s ON s.id = h.symbol_id
      LEFT JOIN week52 w ON w.ticker = s.ticker
      LEFT JOIN pivot_rates p ON p.currency = s.currency""",
    # run logs
    "log_entries": """
      SELECT user_id AS run_id, event_type AS step,
             strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
             strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS end_time,
             value AS duration, event_type <> 'error' AS success,
             CASE WHEN event_type = 'error' THEN props END AS error
      FROM events QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    # two arrivals of the stream, each gated on its own
    "arrival_1": "SELECT * FROM landed WHERE seq = 1",
    "arrival_2": "SELECT * FROM landed WHERE seq = 2",
    "once_1": _last_versions("arrival_1"),
    "once_2": _last_versions("arrival_2"),
    "gate_1": _report("once_1"),
    "gate_2": _report("once_2"),
    "gated": f"""
      SELECT * FROM once_1 WHERE symbol_id IN (SELECT symbol_id FROM gate_1 WHERE is_valid)
      UNION ALL
      SELECT * FROM once_2 WHERE symbol_id IN (SELECT symbol_id FROM gate_2 WHERE is_valid)""",
    "gated_once": f"""
      SELECT b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {_batch_eur(False)}
      FROM (SELECT * FROM gated
            QUALIFY row_number() OVER (PARTITION BY symbol_id, date ORDER BY seq DESC) = 1) b
      {_batch_joins}""",
}

_holdings_home = {
    "native": "units * latest_close",
    "eur": "units * latest_close_eur",
}


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, count(*) AS row_count FROM {source}"
        for shown, source in tables.items()
    )


def _nulls(table: str, source: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {source}"
        for c in columns
    ]


_NOT_NULL = {
    ("symbols", "symbols"): [
        "id", "isin", "ticker", "name", "asset_type", "exchange", "currency"],
    ("currency_rates", "currency_rates"): [
        "id", "from_currency", "to_currency", "rate_date", "exchange_rate"],
    ("etf_data", "etf_data"): ["id", "symbol_id", "date", "close"],
    ("fifty_two_week_metrics", "metrics"): ["id", "symbol_id", "calculation_date"],
    ("decrease_thresholds", "thresholds"): ["id", "symbol_id", "calculation_date"],
    ("stg_etf_data", "staged"): ["id", "symbol_id", "ticker", "date", "close"],
    ("stg_currency_rates", "staged_fx"): [
        "id", "from_currency", "to_currency", "rate_date", "exchange_rate"],
    ("mart_price_history", "history"): ["ticker", "date", "close", "close_eur"],
    ("mart_52week_metrics", "week52"): ["ticker", "high_52week", "low_52week"],
    ("mart_entry_thresholds", "ladder"): ["ticker", "pct_below", "threshold_price"],
}
_RAW = list(_NOT_NULL)[:5]


def _repeats(table: str, source: str, columns: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{columns}' AS key_columns, "
        f"count(*) AS failures FROM (SELECT 1 FROM {source} GROUP BY {columns} "
        "HAVING count(*) > 1)"
    )


def _freshness() -> str:
    parts = [
        f"SELECT '{shown}' AS table_name, max(created_at) AS newest FROM {source}"
        for shown, source in _RAW
    ]
    age = (
        f"date_diff('second', newest, CAST({_newest} AS TIMESTAMP) + INTERVAL 34 HOUR)"
        " / CAST(3600 AS DOUBLE)"
    )
    return f"""
      SELECT table_name, newest, age_hours, CASE WHEN age_hours > 24 THEN 'error'
        WHEN age_hours > 12 THEN 'warn' ELSE 'pass' END AS status
      FROM (SELECT *, {age} AS age_hours FROM ({" UNION ALL ".join(parts)}))"""


def _history_cut(condition: str) -> str:
    return f"SELECT ticker, date, close, close_eur FROM history WHERE {condition}"


_top = "(SELECT max(date) FROM history)"


def _growth(target: str, end: str = _top) -> str:
    """The amount in the target currency, times each price over the first one of three years."""
    return f"""
      SELECT ticker, date, greatest(0, amount_{target.lower()} * (coalesce(price, 0) / coalesce(
               first_value(price) OVER (PARTITION BY ticker ORDER BY date), 1))) AS value
      FROM (SELECT ticker, date, coalesce(nullif(close_eur, 0), nullif(close, 0)) AS price
            FROM history WHERE date BETWEEN {end} - INTERVAL 36 MONTH AND {end})
      JOIN ticker_amounts USING (ticker)"""


def _projected(starts: str, first: str, months: int) -> str:
    return f"""
      SELECT ticker, scenario, CAST(m AS BIGINT) AS month,
             CAST(date_trunc('month', {first}) + to_months(CAST(m AS INTEGER)) AS DATE)
               + CAST(day({first}) - 1 AS INTEGER) AS date,
             {to("start_value * pow(1 + rate / 12, m)", 2)} AS value
      FROM (SELECT ticker, unnest(['conservative', 'moderate', 'aggressive', 'historical'])
                     AS scenario,
                   unnest([CAST(0.07 AS DOUBLE), 0.10, 0.12, cagr]) AS rate
            FROM growth_rates) JOIN ({starts}) USING (ticker), range({months + 1}) AS r(m)"""


def _reached(eur: bool) -> str:
    price = "close_eur" if eur else "close"
    level = latest_ratio("l.threshold_price") if eur else "l.threshold_price"
    return f"""
      WITH v AS (SELECT l.symbol_id, l.pct_below, {level} AS threshold_price
                 FROM level_rows l JOIN newest_bar n USING (symbol_id))
      SELECT v.symbol_id, min(e.{price}) AS min_price, v.pct_below, v.threshold_price,
             min(e.date) FILTER (WHERE e.{price} <= v.threshold_price) AS reached_date,
             coalesce(min(e.{price}) <= v.threshold_price, false) AS is_reached
      FROM v JOIN etf_data e USING (symbol_id)
      GROUP BY v.symbol_id, v.pct_below, v.threshold_price"""


QUERIES = {
    "raw_bars": "SELECT * FROM etf_data",
    "load_raw_tables": _counts(
        {
            "symbols": "symbols",
            "currency_rates": "currency_rates",
            "etf_data": "etf_data",
            "fifty_two_week_metrics": "metrics",
            "decrease_thresholds": "thresholds",
            "holdings": "holdings",
        }
    ),
    "scan_symbols_csv": """
      SELECT isin, ticker, name, asset_type, exchange, currency FROM symbols""",
    "scan_bars": f"SELECT {_bar_columns} FROM etf_data WHERE date >= DATE '1998-01-01'",
    "scan_fx": """
      SELECT from_currency, to_currency, rate_date, exchange_rate FROM currency_rates
      WHERE to_currency = 'EUR'
        AND rate_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    "publish_marts": _counts(
        {
            "mart_price_history": "history",
            "mart_52week_metrics": "week52",
            "mart_entry_thresholds": "ladder",
            "mart_fx_rates": "fx_mart",
        }
    ),
    "upsert_prices": _merge(
        "etf_data", "landed_once", ["symbol_id", "date"], _bar_values,
        ["symbol_id", "date", *_bar_values],
    ),
    "upsert_fx": _merge(
        "currency_rates", "landed_rates_once",
        ["from_currency", "to_currency", "rate_date"], ["exchange_rate"],
        ["from_currency", "to_currency", "rate_date", "exchange_rate"],
    ),
    "upsert_metrics": _merge(
        "metrics", "computed", ["symbol_id", "calculation_date"],
        ["high_52week", "low_52week", "high_date", "low_date"],
        ["symbol_id", "calculation_date", "high_52week", "low_52week", "high_date",
         "low_date"],
    ),
    "upsert_thresholds": _merge(
        "thresholds", "computed_levels", ["symbol_id", "calculation_date"],
        ["high_52week_price", *(f"decrease_{n}_price" for n in LEVELS)],
        ["symbol_id", "calculation_date", "high_52week_price",
         *(f"decrease_{n}_price" for n in LEVELS)],
    ),
    "assign_symbol_ids": f"""
      SELECT * FROM symbols UNION ALL
      SELECT (SELECT max(id) FROM symbols)
               + row_number() OVER (ORDER BY substr(md5(isin), 1, 3), isin),
             isin, ticker, name, asset_type, exchange, currency, {STAMP}, true
      FROM new_symbols""",
    "reload_symbols": f"""
      SELECT row_number() OVER (ORDER BY substr(md5(isin), 1, 3), isin) AS id, *,
             {STAMP} AS created_at, true AS is_active FROM new_symbols""",
    "rejected_symbol_file": """
      SELECT 'duplicate ' || field AS kind, value AS item,
             CAST(occurrences AS VARCHAR) AS detail FROM file_values
      UNION ALL
      SELECT 'invalid', isin, unnest(string_split(errors, '; ')) FROM checked_file
      WHERE errors <> ''""",
    "update_eur_prices": f"""
      SELECT b.id, b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {", ".join(f"CASE WHEN s.is_active AND s.currency <> 'EUR' THEN CASE WHEN b.{c} <> 0 THEN {to(f'b.{c} * r.exchange_rate', 2)} END ELSE b.{c}_eur END AS {c}_eur" for c in PRICES)},
             b.created_at
      FROM etf_data b {_batch_joins}""",
    "update_eur_keyed": f"""
      SELECT t.id, t.symbol_id, t.date, t.open, t.high, t.low, t.close, t.volume,
             {", ".join(f"CASE WHEN c.symbol_id IS NULL THEN t.{c}_eur ELSE c.{c}_eur END AS {c}_eur" for c in PRICES)},
             t.created_at
      FROM etf_data t LEFT JOIN (
        SELECT b.symbol_id, b.date, {_batch_eur(True)}
        FROM (SELECT * FROM landed WHERE seq = 1) b {_batch_joins}) c
        ON c.symbol_id = t.symbol_id AND c.date = t.date""",
    "update_eur_native": f"""
      SELECT b.id, b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {", ".join(f"CASE WHEN s.id IS NOT NULL AND (b.open_eur IS NULL OR b.high_eur IS NULL OR b.low_eur IS NULL OR b.close_eur IS NULL) THEN b.{c} ELSE b.{c}_eur END AS {c}_eur" for c in PRICES)},
             b.created_at
      FROM etf_data b LEFT JOIN symbols s
        ON s.id = b.symbol_id AND s.is_active AND s.currency = 'EUR'""",
    "export_symbol_docs": f"""
      SELECT s.id, s.ticker, s.currency AS native_currency, coalesce(n, 0) AS prices,
             m.high_52week AS high52week, m.low_date,
             (SELECT count(*) FROM level_rows l WHERE l.symbol_id = s.id) AS levels,
             {STAMP} AS last_updated
      FROM symbols s LEFT JOIN last_metrics m ON m.symbol_id = s.id
      LEFT JOIN (SELECT symbol_id, count(*) AS n FROM etf_data GROUP BY 1) c
        ON c.symbol_id = s.id
      WHERE s.is_active""",
    "scan_symbol_docs": f"""
      SELECT s.ticker, e.* EXCLUDE (id, symbol_id, created_at)
      FROM etf_data e JOIN symbols s ON s.id = e.symbol_id AND s.is_active""",
    "export_symbol_list": """
      SELECT ticker, name, isin, currency AS nativeCurrency FROM symbols
      WHERE is_active""",
    "run_log_steps": "SELECT * FROM log_entries",
    "run_summary": """
      SELECT run_id, count(*) AS total, count(*) FILTER (WHERE success) AS successful,
             count(*) FILTER (WHERE NOT success) AS failed,
             CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS duration,
             bool_and(success) AS overall_success, bool_or(success) AS any_success
      FROM log_entries GROUP BY run_id""",
    "stg_prices": "SELECT * FROM staged",
    "stg_fx": "SELECT * FROM staged_fx",
    "int_prices_eur": "SELECT * FROM eur_prices",
    "mart_price_history": "SELECT * FROM history",
    "mart_52week": "SELECT * FROM week52",
    "mart_thresholds": "SELECT * FROM ladder",
    "mart_fx_rates": "SELECT * FROM fx_mart",
    "latest_fx": "SELECT * FROM last_fx",
    "latest_price": "SELECT * FROM last_price",
    "unpivot_thresholds": "SELECT * FROM level_rows",
    "metrics_52week": _snapshot(_newest),
    "entry_levels": f"""
      SELECT symbol_id, calculation_date, high_52week_price, {_level_names}
      FROM thresholds""",
    "export_metrics": """
      SELECT symbol_id, high_52week AS high52week, low_52week AS low52week,
             high_date AS highDate, low_date AS lowDate,
             calculation_date AS calculationDate FROM last_metrics""",
    "export_thresholds": """
      SELECT symbol_id, pct_below AS percentage, threshold_price AS thresholdPrice,
             calculation_date AS calculationDate FROM level_rows
      WHERE threshold_price <> 0""",
    "active_symbols": """
      SELECT id, isin, ticker, name, asset_type, exchange, currency FROM symbols
      WHERE is_active""",
    "symbol_by_isin": """
      SELECT * EXCLUDE (created_at) FROM symbols WHERE isin = 'US0000000011'""",
    "symbol_status": """
      SELECT id, name, ticker, currency,
             CASE WHEN is_active THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
      FROM symbols""",
    "symbol_search": """
      SELECT ticker, name, isin FROM symbols
      WHERE contains(lower(ticker || ' ' || name), '#00000000')""",
    "ordered_tickers": f"""
      SELECT ticker, rank FROM (VALUES {", ".join(f"('{t}', CAST({i} AS BIGINT))" for i, t in enumerate(SHOWN, 1))})
        AS v(ticker, rank)
      WHERE ticker IN (SELECT ticker FROM symbols)""",
    "metric_history": """
      SELECT name, calculation_date, high_52week, low_52week, high_date, low_date
      FROM metrics m JOIN symbols s ON s.id = m.symbol_id""",
    "threshold_history": """
      SELECT name, calculation_date, high_52week_price, decrease_10_price,
             decrease_20_price, decrease_30_price
      FROM thresholds m JOIN symbols s ON s.id = m.symbol_id""",
    "bars_in_range": f"""
      SELECT {_bar_columns}, open_eur, high_eur, low_eur, close_eur FROM etf_data
      WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
    "fx_lookup": """
      SELECT q.*, CASE WHEN q.from_currency = 'EUR' THEN CAST(1 AS DOUBLE)
                       ELSE r.exchange_rate END AS exchange_rate
      FROM (SELECT DISTINCT native_currency AS from_currency, 'EUR' AS to_currency,
                   date AS rate_date FROM staged) q
      LEFT JOIN currency_rates r USING (from_currency, to_currency, rate_date)""",
    "convert_batch": f"""
      SELECT b.symbol_id, b.date, b.open, b.high, b.low, b.close, b.volume,
             {_batch_eur(True)}
      FROM etf_data b {_batch_joins}""",
    "identity_fx": """
      SELECT 'EUR' AS from_currency, 'EUR' AS to_currency,
             CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)
               AS rate_date, CAST(1 AS DOUBLE) AS exchange_rate
      FROM etf_data""",
    "fx_pivot": "SELECT * FROM pivot_rates",
    "fx_pivot_implied": """
      SELECT native_currency AS currency, close_eur / close AS rate_to_eur
      FROM history WHERE close IS NOT NULL AND close_eur IS NOT NULL
      QUALIFY row_number() OVER (
        PARTITION BY native_currency ORDER BY date DESC, ticker DESC) = 1
      UNION ALL
      SELECT 'EUR', CAST(1 AS DOUBLE)
      WHERE NOT EXISTS (SELECT 1 FROM history WHERE native_currency = 'EUR')""",
    "convert_currency": "SELECT w.ticker, "
    + ", ".join(
        f"{pivoted('w.latest_close', 'p.rate_to_eur', rate_of(c))} AS in_{c.lower()}"
        for c in ("EUR", "USD", "GBP", "SEK")
    )
    + " FROM week52 w LEFT JOIN pivot_rates p ON p.currency = w.native_currency",
    "convert_latest_ratio": f"""
      SELECT t.symbol_id, t.high_52week_price,
             {latest_ratio("t.high_52week_price")} AS high_eur
      FROM last_thresholds t LEFT JOIN newest_bar n USING (symbol_id)""",
    "format_money": """
      SELECT ticker,
             coalesce(CASE native_currency WHEN 'USD' THEN '$' WHEN 'GBP' THEN '£'
               WHEN 'EUR' THEN '€' ELSE '' END || format('{:,.2f}', latest_close), '—')
               AS price_text,
             coalesce(CASE native_currency WHEN 'USD' THEN '$' WHEN 'GBP' THEN '£'
               WHEN 'EUR' THEN '€' ELSE native_currency END
               || format('{:.2f}', high_52week), 'N/A') AS high_text,
             coalesce('€' || format('{:,.2f}', latest_close_eur), '—') AS eur_text,
             printf('%+.2f%%', daily_change_eur_pct) AS change_text,
             strftime(latest_price_date, '%b %d, %Y') AS date_text
      FROM week52""",
    "rows_per_symbol": """
      SELECT s.id, name, ticker, currency, count(e.id) AS record_count
      FROM symbols s LEFT JOIN etf_data e ON s.id = e.symbol_id GROUP BY ALL""",
    "orphan_bars": """
      SELECT e.symbol_id, count(*) AS orphaned
      FROM (SELECT CASE WHEN symbol_id % 7 = 0 THEN symbol_id + 1000000 ELSE symbol_id END
              AS symbol_id FROM etf_data) e
      LEFT JOIN symbols s ON e.symbol_id = s.id WHERE s.id IS NULL GROUP BY 1""",
    "unconverted_sample": """
      SELECT e.id, symbol_id, date, close, close_eur, ticker, currency
      FROM etf_data e JOIN symbols s ON s.id = e.symbol_id
      WHERE open_eur IS NULL ORDER BY e.id LIMIT 5""",
    "eur_coverage": """
      SELECT s.id, name, ticker, currency, count(e.id) AS total_records,
             count(open_eur) AS with_eur_records,
             count(*) FILTER (WHERE open_eur IS NULL) AS null_eur_records
      FROM symbols s LEFT JOIN etf_data e ON s.id = e.symbol_id GROUP BY ALL""",
    "eur_coverage_total": """
      SELECT count(*) AS total, count(open_eur) AS with_eur,
             count(*) - count(open_eur) AS without_eur FROM etf_data""",
    "fx_pair_counts": """
      SELECT from_currency, to_currency, count(*) AS rates FROM currency_rates
      GROUP BY ALL""",
    "history_span": """
      SELECT name, count(*) AS data_points, min(date) AS earliest_date,
             max(date) AS latest_date
      FROM etf_data e JOIN symbols s ON s.id = e.symbol_id GROUP BY name""",
    "latest_date": """
      SELECT symbol_id, max(date) AS latest_date FROM etf_data GROUP BY 1""",
    "symbol_state": """
      SELECT symbol_id, min(date) AS first_date, max(date) AS latest_date,
             arg_max(close, date) AS last_close, max(close) AS peak_close,
             count(*) AS rows, max(id) AS max_id
      FROM etf_data GROUP BY 1""",
    "incremental_bars": """
      SELECT l.* FROM landed l
      LEFT JOIN (SELECT symbol_id, max(date) AS mark FROM etf_data GROUP BY 1) m
        USING (symbol_id)
      WHERE CASE WHEN mark IS NULL THEN date >= DATE '2021-12-01' ELSE date > mark END""",
    "reconcile_symbols": """
      WITH j AS (SELECT coalesce(f.isin, s.isin) AS isin, f.f, f.f IS NULL AS no_file,
                        s.id IS NULL AS no_db,
                        s.ticker AS t, s.name AS n, s.asset_type AS a, s.exchange AS e,
                        s.currency AS c
                 FROM file_once f FULL JOIN symbols s ON f.isin = s.isin)
      SELECT isin, 'missing_in_db' AS field, CAST(NULL AS VARCHAR) AS file_value,
             CAST(NULL AS VARCHAR) AS stored_value FROM j WHERE no_db
      UNION ALL SELECT isin, 'extra_in_db', NULL, NULL FROM j WHERE no_file
      UNION ALL SELECT isin, 'ticker', f.t, t FROM j
        WHERE NOT no_db AND NOT no_file AND f.t IS DISTINCT FROM t
      UNION ALL SELECT isin, 'name', f.n, n FROM j
        WHERE NOT no_db AND NOT no_file AND f.n IS DISTINCT FROM n
      UNION ALL SELECT isin, 'asset_type', f.a, a FROM j
        WHERE NOT no_db AND NOT no_file AND f.a IS DISTINCT FROM a
      UNION ALL SELECT isin, 'exchange', f.e, e FROM j
        WHERE NOT no_db AND NOT no_file AND f.e IS DISTINCT FROM e
      UNION ALL SELECT isin, 'currency', f.c, c FROM j
        WHERE NOT no_db AND NOT no_file AND f.c IS DISTINCT FROM c""",
    "isin_except": "SELECT isin FROM symbol_file EXCEPT SELECT isin FROM symbols",
    "isin_intersect": "SELECT isin FROM symbol_file INTERSECT SELECT isin FROM symbols",
    "validate_symbols": "SELECT *, errors = '' AS is_valid FROM checked_file",
    "dq_duplicates": "SELECT * FROM file_values",
    "dq_batch": _report("etf_data"),
    "dq_no_data": f"""
      SELECT * FROM ({_report('(SELECT symbol_id, date, open, high, low, close, volume FROM landed QUALIFY row_number() OVER (PARTITION BY symbol_id, date ORDER BY seq DESC) = 1)')})
      UNION ALL BY NAME
      SELECT id AS symbol_id, 0 AS bars, {", ".join(f"0 AS missing_{c}" for c in [*PRICES, "volume"])},
             {", ".join(f"0 AS negative_{c}" for c in PRICES)}, 0 AS extreme_moves, 0 AS zero_volume_bars,
             'No data received' AS issues, false AS is_valid
      FROM symbols WHERE is_active AND id NOT IN (SELECT symbol_id FROM landed)""",
    "dq_not_null": " UNION ALL ".join(
        part
        for (table, source), columns in _NOT_NULL.items()
        for part in _nulls(table, source, columns)
    ),
    "dq_unique": " UNION ALL ".join(
        _repeats(t, s, c)
        for t, s, c in [
            ("symbols", "symbols", "id"),
            ("symbols", "symbols", "isin"),
            ("symbols", "symbols", "ticker"),
            ("symbols", "symbols", "name"),
            ("currency_rates", "currency_rates", "id"),
            ("etf_data", "etf_data", "id"),
            ("fifty_two_week_metrics", "metrics", "id"),
            ("decrease_thresholds", "thresholds", "id"),
            ("stg_etf_data", "staged", "id"),
            ("stg_currency_rates", "staged_fx", "id"),
            ("mart_52week_metrics", "week52", "ticker"),
        ]
    ),
    "dq_unique_composite": " UNION ALL ".join(
        _repeats(t, s, c)
        for t, s, c in [
            ("currency_rates", "currency_rates", "from_currency,to_currency,rate_date"),
            ("etf_data", "etf_data", "symbol_id,date"),
            ("fifty_two_week_metrics", "metrics", "symbol_id,calculation_date"),
            ("decrease_thresholds", "thresholds", "symbol_id,calculation_date"),
        ]
    ),
    "dq_freshness": _freshness(),
    "dq_foreign_key": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS failures FROM {s} "
        "WHERE symbol_id NOT IN (SELECT id FROM symbols)"
        for t, s in [
            ("etf_data", "etf_data"),
            ("fifty_two_week_metrics", "metrics"),
            ("decrease_thresholds", "thresholds"),
        ]
    ),
    "dq_fx_coverage": """
      SELECT native_currency, count(*) AS rows_without_rate FROM staged
      WHERE native_currency <> 'EUR' AND native_currency NOT IN (
        SELECT from_currency FROM staged_fx WHERE to_currency = 'EUR')
      GROUP BY 1""",
    "dq_late_start": """
      SELECT symbol_id, min(date) AS first_date FROM etf_data GROUP BY 1
      HAVING min(date) > DATE '1995-01-05'""",
    "range_preset": _history_cut(f"date BETWEEN {_top} - 365 AND {_top}"),
    "range_custom": _history_cut("date BETWEEN DATE '1997-03-01' AND DATE '1999-06-30'"),
    "range_calendar": _history_cut(f"date >= make_date(year({_top}) - 2, 1, 1)"),
    "range_or_recent": f"""
      SELECT ticker, date, close_eur
      FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n,
                   max(date) OVER (PARTITION BY ticker) >= {_top} - 30 AS is_recent
            FROM history)
      WHERE CASE WHEN is_recent THEN date >= {_top} - 30 ELSE n <= 100 END""",
    "row_slice": """
      WITH p AS (SELECT ticker, date, close_eur,
                   row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS position,
                   count(*) OVER (PARTITION BY ticker) AS n FROM history),
           w AS (SELECT *, least(50, n) AS width,
                   CAST(floor(0.6 * (n - 1)) AS BIGINT) AS mid FROM p),
           e AS (SELECT *, least(n - 1, greatest(0, mid - width // 2) + width) AS stop FROM w)
      SELECT ticker, date, close_eur, position FROM e
      WHERE position <= stop AND position >= CASE WHEN stop = n - 1
        THEN greatest(0, stop - width + 1) ELSE greatest(0, mid - width // 2) END""",
    "indexed_100": f"""
      SELECT ticker, date, {to("close_eur / nullif(first_value(close_eur) OVER (PARTITION BY ticker ORDER BY date), 0) * 100", 6)} AS indexed
      FROM history WHERE date BETWEEN {_top} - 730 AND {_top}""",
    "price_in_currency": f"""
      SELECT ticker, date, {to(f"close_eur / coalesce({rate_of('USD')}, 1)", 6)} AS price
      FROM history""",
    "sparkline": """
      SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS position,
             close_eur
      FROM (SELECT * FROM history QUALIFY row_number() OVER (
              PARTITION BY ticker ORDER BY date DESC) <= 30)""",
    "kpi_cards": f"""
      SELECT ticker, {pivoted("close_eur", rate_of("EUR"), rate_of("USD"))} AS price,
             daily_change_pct, coalesce(daily_change_pct >= 0, false) AS is_up
      FROM history QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""",
    "summary_in_currency": f"""
      SELECT *, printf('%+.2f%%', distance) AS distance_text,
             coalesce('£' || format('{{:,.2f}}', latest_close), '—') AS current_text
      FROM (SELECT w.ticker, w.etf_name,
              {", ".join(f"{pivoted(f'w.{c}', 'p.rate_to_eur', rate_of('GBP'))} AS {c}" for c in ("high_52week", "low_52week", "latest_close"))},
              coalesce(-w.pct_below_52w_high, CAST(0 AS DOUBLE)) AS distance
            FROM week52 w LEFT JOIN pivot_rates p ON p.currency = w.native_currency)""",
    "threshold_ladder": f"""
      SELECT l.ticker, l.pct_below, l.pct_below || '% Below High' AS label,
             {pivoted("l.threshold_price", "p.rate_to_eur", rate_of("USD"))} AS threshold_price,
             {pivoted("l.latest_close", "p.rate_to_eur", rate_of("USD"))} AS current_price
      FROM ladder l LEFT JOIN pivot_rates p ON p.currency = l.native_currency""",
    "current_price": """
      SELECT symbol_id, date, close AS price, coalesce(close_eur, close) AS price_eur,
             coalesce(nullif(close, 0), nullif(close_eur, 0), 0) AS price_or_zero,
             coalesce(nullif(close_eur, 0), nullif(close, 0), 0) AS price_eur_or_zero
      FROM newest_bar""",
    "report_52week": """
      SELECT ticker AS "Ticker", etf_name AS "ETF Name", latest_close_eur AS "Price (EUR)",
             daily_change_eur_pct AS "Daily Change %", high_52week AS "52w High",
             low_52week AS "52w Low", pct_below_52w_high AS "% Below High",
             pct_above_52w_low AS "% Above Low", latest_price_date AS "Last Updated"
      FROM week52""",
    "report_thresholds": """
      SELECT ticker AS "Ticker", pct_below AS "% Below 52w High",
             threshold_price AS "Threshold Price", latest_close AS "Current Price",
             gap_to_threshold_pct AS "Gap to Threshold %",
             CASE WHEN is_at_or_below_threshold THEN 'Signal' ELSE 'Not Yet' END
               AS "Buy Signal"
      FROM ladder""",
    "severity_bucket": """
      SELECT ticker, pct_below_52w_high,
             CASE WHEN pct_below_52w_high >= 15 THEN 'red'
                  WHEN pct_below_52w_high >= 5 THEN 'yellow'
                  WHEN pct_below_52w_high IS NOT NULL THEN 'green' END AS below_high,
             daily_change_eur_pct,
             CASE WHEN daily_change_eur_pct >= 0 THEN 'green'
                  WHEN daily_change_eur_pct < 0 THEN 'red' END AS change_sign
      FROM week52""",
    "gap_severity": """
      SELECT ticker, pct_below, gap_to_threshold_pct,
             CASE WHEN gap_to_threshold_pct >= 0 THEN 'red'
                  WHEN gap_to_threshold_pct < 0 THEN 'green' END AS gap_sign
      FROM ladder""",
    "price_pivot": "SELECT CAST(date AS TIMESTAMP) AS time, "
    + ", ".join(
        f"max(close_eur) FILTER (WHERE ticker = '{t}') AS \"{t}\"" for t in SHOWN
    )
    + " FROM history WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY date",
    "series_stats": """
      SELECT ticker, arg_max(close_eur, date) AS last_value, min(close_eur) AS min_value,
             max(close_eur) AS max_value FROM history GROUP BY ticker""",
    "threshold_reached": _reached(True),
    "threshold_reached_native": _reached(False),
    "profit_targets": f"""
      SELECT *, entry_price * (1 + profit_pct / CAST(100 AS DOUBLE)) AS target_price,
             coalesce(current_price >= entry_price * (1 + profit_pct / CAST(100 AS DOUBLE)),
                      false) AS is_reached
      FROM (SELECT symbol_id, pct_below, {latest_ratio("l.threshold_price")} AS entry_price,
                   coalesce(n.close_eur, n.close) AS current_price, profit_pct
            FROM level_rows l JOIN newest_bar n USING (symbol_id),
            (VALUES (10), (20), (50), (100)) AS t(profit_pct)
            WHERE l.threshold_price <> 0)""",
    "daily_returns": "SELECT * FROM returns",
    "volatility": f"SELECT ticker, returns, {to('volatility', 6)} AS volatility FROM vols",
    "drawdown": "SELECT * FROM falls",
    "worst_drawdown": "SELECT * FROM deepest",
    "cagr": f"""
      SELECT ticker, first_price, last_price, first_date, last_date,
             {to("years", 6)} AS years, {to("cagr", 6)} AS cagr FROM growth_rates""",
    "growth_of_amount": f"SELECT ticker, date, {to('value', 2)} AS value FROM ({_growth('EUR')})",
    "growth_of_amount_usd": f"SELECT ticker, date, {to('value', 2)} AS value FROM ({_growth('USD')})",
    "projection": _projected(
        f"""SELECT ticker, coalesce(last_value, amount_eur) AS start_value FROM ticker_amounts
            LEFT JOIN (SELECT ticker, arg_max(value, date) AS last_value
                       FROM ({_growth("EUR", "DATE '2001-10-31'")}) GROUP BY ticker) USING (ticker)""",
        "DATE '2001-10-31'", 60,
    ),
    "projection_usd": _projected(
        "SELECT ticker, amount_usd AS start_value FROM ticker_amounts", f"({_top} + 1)", 36
    ),
    "holdings_value": f"""
      SELECT holder, symbol_id, ticker, country, units,
             {to("units * latest_close", 2)} AS value_native,
             {to("units * latest_close_eur", 2)} AS value_eur,
             {to(pivoted("units * latest_close", "source_rate", "target_rate"), 2)}
               AS value_home
      FROM priced""",
    "holdings_total": f"""
      SELECT holder, country,
             {to(exact(pivoted("cost", "source_rate", "target_rate")), 2)} AS total_invested
      FROM priced GROUP BY ALL""",
    "holdings_units": f"""
      SELECT holder, symbol_id, {to("invested", 4)} AS invested, {to("price", 4)} AS price,
             coalesce(CAST(floor(invested / nullif(price, 0)) AS BIGINT), 0)
               AS units_affordable,
             {to("coalesce(floor(invested / nullif(price, 0)) * price, CAST(0 AS DOUBLE))", 4)}
               AS current_value
      FROM (SELECT holder, symbol_id, latest_close_eur / target_rate AS price,
                   {pivoted("cost", "source_rate", "target_rate")} AS invested FROM priced)""",
    "portfolio_risk": f"""
      WITH prices AS (SELECT ticker, date, close_eur AS price, 'EUR' AS home FROM history
                      UNION ALL SELECT ticker, date, close, 'USD' FROM history),
           moves AS (SELECT ticker, home, price, lag(price) OVER w AS previous
                     FROM prices WINDOW w AS (PARTITION BY ticker, home ORDER BY date)),
           v AS (SELECT ticker, home, stddev_pop((price - previous) / previous)
                        * sqrt(CAST(252 AS DOUBLE)) AS volatility
                 FROM moves WHERE previous > 0 AND price <> 0 GROUP BY ALL),
           peaks AS (SELECT ticker, home, date, price, max(price) OVER (
                       PARTITION BY ticker, home ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak
                     FROM prices WHERE price IS NOT NULL),
           d AS (SELECT ticker, home, (price - peak) / nullif(peak, 0) AS max_drawdown,
                        year(date) AS drawdown_year
                 FROM peaks WHERE (price - peak) / nullif(peak, 0) < 0
                 QUALIFY row_number() OVER (PARTITION BY ticker, home
                   ORDER BY (price - peak) / nullif(peak, 0), date) = 1),
           h AS (SELECT p.holder, p.symbol_id,
                        {pivoted("p.cost", "p.source_rate", "p.target_rate")} AS cost,
                        v.volatility, d.max_drawdown,
                        CAST(d.drawdown_year AS INTEGER) AS drawdown_year
                 FROM (SELECT *, CASE WHEN country IN ('Germany', 'France') THEN 'EUR'
                                      ELSE 'USD' END AS home FROM priced) p
                 LEFT JOIN v USING (ticker, home) LEFT JOIN d USING (ticker, home)
                 WHERE p.cost > 0)
      SELECT holder, {to(exact("cost"), 2)} AS total_invested,
             {to(f"{exact('cost * coalesce(volatility, 0)')} / {exact('cost')}", 6)}
               AS volatility,
             coalesce(min(max_drawdown), CAST(0 AS DOUBLE)) AS worst_drawdown,
             first(drawdown_year ORDER BY max_drawdown, symbol_id)
               FILTER (WHERE max_drawdown < 0) AS worst_year,
             {to(f"{exact('cost')} * CAST(0.7 AS DOUBLE)", 2)} AS stress_value
      FROM h GROUP BY holder""",
    "tax_estimate": f"""
      SELECT holder, country, {to("total_cost", 2)} AS total_cost,
             {to("total_value", 2)} AS total_value, {to("gain", 2)} AS gain,
             {to("gain * CASE country WHEN 'Australia' THEN CAST(0.5 AS DOUBLE) ELSE 1 END * CASE country WHEN 'USA' THEN CAST(0.15 AS DOUBLE) WHEN 'Australia' THEN 0.20 WHEN 'Germany' THEN 0.26375 ELSE 0.30 END", 2)} AS tax
      FROM (SELECT holder, country, total_cost, total_value,
                   greatest(CAST(0 AS DOUBLE), total_value - total_cost) AS gain
            FROM (SELECT holder, country,
                    {exact(pivoted("cost", "source_rate", "target_rate"))} AS total_cost,
                    {exact(pivoted("units * latest_close", "source_rate", "target_rate"))}
                      AS total_value
                  FROM priced GROUP BY ALL))""",
    "stream_upsert": _merge(
        "etf_data", "gated_once", ["symbol_id", "date"], _bar_values,
        ["symbol_id", "date", *_bar_values],
    ),
}


def _mentioned(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def statement(name: str) -> str:
    """Complete SQL of one query."""
    needed: list[str] = []

    def add(sql: str) -> None:
        for table in _mentioned(sql):
            if table not in needed:
                add_first = TABLES[table]
                add(add_first)
                if table not in needed:
                    needed.append(table)

    body = QUERIES[name]
    add(body)
    if not needed:
        return body
    tables = ",\n".join(f"{t} AS MATERIALIZED ({TABLES[t]})" for t in needed)
    return f"WITH {tables}\nSELECT * FROM ({body})"
