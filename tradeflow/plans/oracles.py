"""SQL that gives the same rows as the registered queries."""

from __future__ import annotations

_TRADES = """trades AS (
  SELECT CAST(value AS DECIMAL(10,4)) AS price, 'U' || user_id AS symbol,
         epoch_us(ts) // 1000 AS ts, CAST(props->>'$.k' AS INT) AS volume
  FROM events)"""

_STOCKS = """stocks AS (
  SELECT 'U' || c_custkey AS "Symbol", c_name AS "Security", c_mktsegment AS "Sector",
         'S&P500' AS "Index" FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT 'U' || c_custkey, c_name, c_mktsegment, 'NASDAQ' FROM customer WHERE c_nationkey < 12)"""

_LEAVES = """leaves AS (
  SELECT volume, CAST(sum(price) AS DOUBLE) / count(*) AS mean, count(*) AS trades
  FROM trades WHERE volume IS NOT NULL AND price IS NOT NULL GROUP BY volume)"""


def _trades(body: str) -> str:
    return f"WITH {_TRADES} {body}"


def _stocks(body: str) -> str:
    return f"WITH {_STOCKS} {body}"


_TIME = "make_timestamp(ts * 1000)"
_FLAT = _trades("SELECT price, symbol, ts, volume FROM trades")
_UNIVERSE = _stocks("SELECT * FROM stocks")


# One row per key; of rows written together the greatest wins.
_KEYED = """keyed AS (
  SELECT * FROM trades WHERE symbol IS NOT NULL AND ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol, ts
    ORDER BY price DESC NULLS LAST, volume DESC NULLS LAST) = 1)"""


def _archived(test: str) -> str:
    return (
        f"WITH {_TRADES}, {_KEYED} SELECT symbol, {_TIME} AS ts, price, volume "
        f"FROM keyed WHERE ts {test} 1705276800000"
    )


# A part's trades are archived once for each key; a key comes again from a later part
# only if the earlier one was archived before, and else the later part wins.
def _stepwise(test: str) -> str:
    return f"""WITH {_TRADES}, parts AS (
        SELECT *, coalesce(volume % 4, 0) AS part FROM trades WHERE symbol IS NOT NULL AND ts IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY symbol, ts, coalesce(volume % 4, 0)
          ORDER BY price DESC NULLS LAST, volume DESC NULLS LAST) = 1),
    timed AS (
        SELECT *, greatest(part, CASE WHEN ts < 1705276800000 - 2 * 86400000 THEN 0
          WHEN ts < 1705276800000 - 86400000 THEN 1 WHEN ts < 1705276800000 THEN 2 END) AS move FROM parts
        WHERE ts < 1705276800000)
    SELECT symbol, {_TIME} AS ts, price, volume FROM timed WHERE {test}
    QUALIFY row_number() OVER (PARTITION BY symbol, ts, move ORDER BY part DESC) = 1"""


def _picked(index: str) -> str:
    return _stocks(
        'SELECT DISTINCT "Symbol", "Security", "Symbol" || \'(\' || "Security" || \')\' AS label '
        f'FROM stocks WHERE "Index" = {index}'
    )


def _series(column: str) -> str:
    return (
        f"WITH {_TRADES}, {_KEYED} "
        f"SELECT 'U7 {column}' AS id, CAST({column} AS DOUBLE) AS value, {_TIME} AS time "
        "FROM keyed WHERE symbol = 'U7' AND ts > 0 AND ts < 1706000000000"
    )


def _predicted(requests: str, shown: str) -> str:
    """The mean of the nearest leaf; the lower one where two are as near."""
    return f"""WITH {_TRADES}, {_LEAVES}, requests AS ({requests}),
asked AS (SELECT DISTINCT volume FROM requests),
sides AS (
  SELECT a.volume, max(l.volume) FILTER (WHERE l.volume <= a.volume) AS below,
         min(l.volume) FILTER (WHERE l.volume >= a.volume) AS above
  FROM asked a, leaves l GROUP BY a.volume),
nearest AS (
  SELECT volume, CASE WHEN below IS NULL THEN above WHEN above IS NULL THEN below
    WHEN 2 * volume <= below + above THEN below ELSE above END AS leaf FROM sides)
SELECT {shown}, round(l.mean, 6) AS prediction
FROM requests r LEFT JOIN nearest n ON n.volume = r.volume LEFT JOIN leaves l ON l.volume = n.leaf"""


ORACLES: dict[str, str] = {
    "trades_flatten": _FLAT,
    "message_roundtrip": _FLAT,
    "stream_trades": _FLAT,
    "stream_documents": _FLAT,
    "event_ages": """SELECT event_id, 5000::BIGINT AS apart, true AS past
        FROM events WHERE ts IS NOT NULL
        UNION ALL SELECT event_id, NULL, NULL FROM events WHERE ts IS NULL""",
    "chart_refresh": f"WITH {_TRADES}, {_KEYED} SELECT symbol, {_TIME} AS ts, price, volume FROM keyed",
    "epoch_ms": """SELECT event_id, epoch_us(ts) // 1000 AS ms,
        (epoch_us(ts) + 500) // 1000 AS ms_rounded,
        make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms FROM events""",
    # The late row of a key, else its early row, whose price is one too high.
    **dict.fromkeys(["stream_hot_upsert", "stream_hot_arrival", "stream_live"], f"""WITH {_TRADES}, keyed AS (
        SELECT *, volume IS NOT NULL AND volume >= 50 AS late FROM trades
        WHERE symbol IS NOT NULL AND ts IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY symbol, ts
          ORDER BY late DESC, price DESC NULLS LAST, volume DESC NULLS LAST) = 1)
        SELECT symbol, {_TIME} AS ts,
        CAST(price + CASE WHEN late THEN 0 ELSE 1 END AS DECIMAL(10,4)) AS price, volume
        FROM keyed"""),
    "hot_upsert": """SELECT event_type AS symbol, date_trunc('hour', ts) AS ts,
        CAST(value AS DECIMAL(10,4)) AS price, CAST(props->>'$.k' AS INT) AS volume
        FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
          ORDER BY event_id DESC) = 1""",
    "latest_event": """SELECT user_id, event_type, value, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "archive_cold": _archived("<"),
    "archive_hot_left": _archived(">="),
    **dict.fromkeys(["archive_compacted", "archive_recompacted"], _stepwise("ts < 1705276800000")),
    "archive_table": _stepwise("ts >= 1704412800000 AND ts < 1705276800000"),
    "hot_symbols": _trades("SELECT DISTINCT symbol FROM trades"),
    "universe_union": _UNIVERSE,
    "universe_reload": _UNIVERSE,
    "universe_from_pages": _UNIVERSE,
    "universe_table_scan": _UNIVERSE,
    "stock_picker": _picked("'NASDAQ'"),
    "stock_picker_none": _picked("NULL"),
    "index_list": _stocks('SELECT DISTINCT "Index" FROM stocks'),
    "universe_counts": _stocks(
        'SELECT "Index", count(*) AS listings, count(DISTINCT "Symbol") AS stocks '
        'FROM stocks GROUP BY "Index"'
    ),
    "top_symbols": _stocks('SELECT DISTINCT "Symbol" FROM stocks ORDER BY "Symbol" LIMIT 10'),
    "subscribe_messages": _stocks(
        """SELECT '{"type":"subscribe","symbol":"' || "Symbol" || '"}' AS message
        FROM (SELECT DISTINCT "Symbol" FROM stocks ORDER BY "Symbol" LIMIT 50)"""
    ),
    "html_table_rows": """SELECT 'U' || c_custkey AS "Symbol", c_name AS "Security",
        c_mktsegment || ' & more' AS "Sector" FROM customer""",
    "series_range": """SELECT user_id AS id, value, ts AS time FROM events
        WHERE user_id IN (7, 8) AND ts > make_timestamp(1705276800000000)
        AND ts < make_timestamp(1706000000000000)""",
    "series_price": _series("price"),
    "series_volume": _series("volume"),
    "series_archive": f"""WITH {_TRADES}, {_KEYED}
        SELECT symbol AS id, CAST(price AS DOUBLE) AS value, {_TIME} AS time FROM keyed
        WHERE symbol IN ('U7', 'U8') AND ts > 1705276800000 - 10 * 86400000
        AND ts < 1705276800000 - 5 * 86400000""",
    "editor_days": f"""WITH {_TRADES}, {_KEYED}
        SELECT symbol, round(round(sum(price)::DOUBLE / count(price), 11), 6) AS mean,
               date_trunc('day', {_TIME}) AS day, max(price) AS high, min(price) AS low,
               sum(volume)::BIGINT AS volume, count(*) AS trades
        FROM keyed WHERE ts > 1705276800000 - 5 * 86400000 AND ts < 1705276800007 AND volume >= 20
        GROUP BY symbol, date_trunc('day', {_TIME})""",
    "editor_series": """SELECT event_type AS id, count(*)::DOUBLE AS value, max(ts) AS time FROM events
        WHERE ts > make_timestamp(1705276800000000) AND ts < make_timestamp(1706000000000000)
        AND user_id IN (7, 8, 9) GROUP BY event_type""",
    "trades_enriched": f"""WITH {_TRADES}, {_STOCKS}, facts AS (
        SELECT "Symbol" AS symbol, min("Security") AS security, min("Sector") AS sector,
               string_agg(DISTINCT "Index", ',' ORDER BY "Index") AS indexes
        FROM stocks GROUP BY "Symbol")
        SELECT t.*, f.security, f.sector, f.indexes
        FROM trades t LEFT JOIN facts f ON f.symbol = t.symbol""",
    "forecast_leaves": f"WITH {_TRADES}, {_LEAVES} SELECT volume, round(mean, 6) AS mean, trades FROM leaves",
    "forecast_exact": _predicted(
        "SELECT CAST(c_custkey AS INT) AS volume FROM customer", "r.volume"
    ),
    "forecast_points": _predicted(
        "SELECT unnest([10, 1200, -5])::INT AS volume", "r.volume"
    ),
    "forecast_batch": _predicted(
        "SELECT * FROM trades", "r.price, r.symbol, r.ts, r.volume"
    ),
    "forecast_saved_model": _predicted(
        "SELECT * FROM trades", "r.symbol, r.ts, r.volume"
    ),
    "forecast_fractions": """
        WITH leaves AS (
            SELECT CAST(value AS DOUBLE) AS volume, avg(CAST(props->>'k' AS INT)) AS mean FROM events
            WHERE value IS NOT NULL AND (props->>'k') IS NOT NULL GROUP BY 1
        ), asked AS (
            SELECT p_partkey, CAST(p_retailprice AS DOUBLE) / 10 AS volume FROM part
        ), below AS (
            SELECT p_partkey, a.volume, l.volume AS low, l.mean AS low_mean
            FROM asked a ASOF LEFT JOIN leaves l ON a.volume >= l.volume
        ), sided AS (
            SELECT b.*, l.volume AS high, l.mean AS high_mean
            FROM below b ASOF LEFT JOIN leaves l ON b.volume <= l.volume
        )
        SELECT p_partkey, volume, round(round(CASE WHEN low IS NULL THEN high_mean
            WHEN high IS NULL OR volume - low <= high - volume THEN low_mean ELSE high_mean END, 11), 6) AS prediction
        FROM sided""",
    "forecast_lag1": _trades(
        """SELECT price, symbol, ts, volume, lag(price) OVER (PARTITION BY symbol
        ORDER BY ts NULLS FIRST, price NULLS FIRST, volume NULLS FIRST) AS price_lag1 FROM trades"""
    ),
    "csv_training_scan": _trades("SELECT volume, CAST(price AS DOUBLE) AS price FROM trades"),
}
ORACLES["stream_enriched"] = ORACLES["trades_enriched"]
ORACLES["stream_lag1"] = ORACLES["forecast_lag1"]
